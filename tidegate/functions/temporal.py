"""Time helpers: durations, bounds and their text forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_crossed(start: Column, end: Column) -> Column:
    """Number of second boundaries between two instants (not elapsed time)."""
    return F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))


def utc_text(instant: Column) -> Column:
    """Millisecond text form with the UTC mark, as file connectors take it."""
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def shifted(base: Column, amount: Column, unit: str) -> Column:
    """``base`` moved by a number of DAYS, HOURS, MINS, SECS or milliseconds."""
    if unit == "MILLISECONDS":
        return base + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), (amount / F.lit(1000)).cast("decimal(18,6)")
        )
    places = {"DAYS": 0, "HOURS": 1, "MINS": 2, "SECS": 3}
    parts = [F.lit(0)] * 4
    parts[places[unit]] = amount
    return base + F.make_dt_interval(*parts)


def sortable_bound(text: Column) -> Column:
    """A timestamp text in a fixed-width form with seven fraction digits.

    Comparing these forms as text keeps the seventh digit, which a Spark
    timestamp cannot hold.  Texts that are no timestamp give NULL, and so do
    texts with an offset: they must be turned into UTC by whoever supplies them.
    """
    plain = F.regexp_replace(F.replace(F.trim(text), F.lit("T"), F.lit(" ")), "Z$", "")
    whole = F.split_part(plain, F.lit("."), F.lit(1))
    fraction = F.split_part(plain, F.lit("."), F.lit(2))
    stamp = F.date_format(whole.try_cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")
    digits = F.concat(stamp, F.lit("."), F.rpad(F.left(fraction, F.lit(7)), 7, "0"))
    return F.when(~F.rlike(plain, F.lit(":[0-9.]+[+-][0-9]")), digits)


def bound_instant(text: str) -> Column:
    """A bound as a zone-less timestamp literal, for pushed-down predicates."""
    return F.lit(text).cast("timestamp_ntz")
