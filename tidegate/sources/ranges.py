"""Range-partitioned extraction on a named column.

A JDBC source is read through one query per range.  A file source is already
splittable, so its rows are only labelled with the range they belong to: no
shuffle is added.

Ranges of equal width serve keys without gaps.  ``depth_cuts`` finds ranges of
about equal row counts from a quantile sketch of the rows inside the window that
is loaded, so history outside it does not shift them, and gives every value that
fills a range by itself a range of its own.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH = date(1970, 1, 1)


def as_number(df: DataFrame, column: str) -> Column:
    """The range column as an integer: days for dates and timestamps."""
    if df.schema[column].dataType.typeName() in ("date", "timestamp", "timestamp_ntz"):
        return F.unix_date(F.col(column).cast("date")).cast("bigint")
    return F.col(column).cast("bigint")


def column_limits(df: DataFrame, column: str) -> tuple[int, int] | None:
    """Smallest and largest number of the range column, or None for an empty source."""
    number = as_number(df, column)
    row = df.agg(F.min(number).alias("lo"), F.max(number).alias("hi")).first()
    return None if row.lo is None else (row.lo, row.hi)


def range_width(lo: int, hi: int, slices: int) -> int:
    """Width of equal ranges covering lo..hi in at most ``slices`` pieces."""
    return max(1, -(-(hi - lo + 1) // slices))


def range_number(column: Column, lo: int, width: int) -> Column:
    """Zero-based number of the range a value falls in.

    The remainder goes first: what is left divides evenly, so the quotient is exact although
    the division is in doubles.
    """
    above = column.cast("bigint") - F.lit(lo)
    return F.round((above - F.pmod(above, F.lit(width))) / F.lit(width)).cast("int")


def label_ranges(df: DataFrame, column: str, slices: int) -> DataFrame:
    """The rows with ``_range_id``; NULL keys go to a range of their own (-1)."""
    limits = column_limits(df, column)
    if limits is None:
        return df.withColumn("_range_id", F.lit(None).cast("int"))
    lo, hi = limits
    number = range_number(as_number(df, column), lo, range_width(lo, hi, slices))
    return df.withColumn("_range_id", F.coalesce(number, F.lit(-1)))


def _literal(number: int, is_date: bool) -> str:
    return f"'{EPOCH + timedelta(days=number)}'" if is_date else str(number)


def range_predicates(
    column: str, lo: int, hi: int, slices: int, is_date: bool = False
) -> list[str]:
    """Source-side predicates that split lo..hi; open ends, NULLs in the first."""
    width = range_width(lo, hi, slices)
    cuts = [
        _literal(lo + width * i, is_date) for i in range(1, slices) if lo + width * i <= hi
    ]
    if not cuts:
        return ["1 = 1"]
    first = [f"({column} < {cuts[0]} OR {column} IS NULL)"]
    middle = [f"({column} >= {a} AND {column} < {b})" for a, b in zip(cuts, cuts[1:])]
    return first + middle + [f"({column} >= {cuts[-1]})"]


SKETCH_ACCURACY = 100  # rank error of a cut: the mean range's rows divided by this
INTEGERS = ("byte", "short", "integer", "long")


@dataclass(frozen=True)
class Cut:
    """A border between two ranges, before or after a value of the range column.

    ``number`` counts whole numbers, days or microseconds, ``text`` is the value as
    a source takes it in a predicate.
    """

    number: int
    after: bool
    text: str


def _kind(df: DataFrame, column: str) -> str:
    kind = df.schema[column].dataType.typeName()
    if kind in INTEGERS or kind == "decimal" and df.schema[column].dataType.scale == 0:
        return "number"
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return kind
    raise ValueError(f"{column} is of type {kind}; ranges need whole numbers, dates or timestamps")


def _range_number(kind: str, column: str) -> Column:
    if kind == "number":
        return F.col(column).cast("bigint")
    if kind == "date":
        return F.unix_date(column).cast("bigint")
    return F.unix_micros(F.col(column).cast("timestamp"))


def _text(kind: str, number: int) -> str:
    if kind == "number":
        return str(number)
    if kind == "date":
        return f"'{EPOCH + timedelta(days=number)}'"
    stamp = datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=number)
    return f"'{stamp.strftime('%Y-%m-%d %H:%M:%S.%f')}'"


def depth_cuts(df: DataFrame, column: str, slices: int) -> list[Cut]:
    """Borders of about ``slices`` ranges with like numbers of rows; rows of ``df`` only.

    One pass over the range column.  A value that takes several quantiles has at least
    the rows of one range; it gets a range of its own, so the values beside it are not
    drawn into a large range.  There are at most twice as many ranges as asked for.
    """
    kind = _kind(df, column)
    if slices < 2:
        return []
    parts = 2 * slices
    steps = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    sketch = F.percentile_approx(_range_number(kind, column), steps, SKETCH_ACCURACY * parts)
    found = df.agg(sketch.alias("cuts")).first().cuts
    if not found:
        return []
    # a value at two neighbouring half-steps or more has half a range's rows or more
    heavy = {a for a, b in zip(found, found[1:]) if a == b}
    light = {value for value in found[1::2] if value not in heavy}
    borders = {(value, True) for value in light | heavy} | {(value, False) for value in heavy}
    order = sorted(borders, key=lambda b: (b[0], b[1]))
    return [Cut(number, after, _text(kind, number)) for number, after in order]


def label_cuts(df: DataFrame, column: str, cuts: list[Cut]) -> DataFrame:
    """The rows with ``_range_id`` from 0; NULL keys go to a range of their own (-1)."""
    number = _range_number(_kind(df, column), column)
    passed = [F.when(number > c.number if c.after else number >= c.number, 1).otherwise(0) for c in cuts]
    place = sum(passed, F.lit(0))
    return df.withColumn("_range_id", F.when(number.isNull(), -1).otherwise(place))


def cut_predicates(column: str, cuts: list[Cut], window: str | None = None) -> list[str]:
    """Source-side predicates of the ranges between the cuts, each inside the window.

    NULLs are read with the first range.
    """
    inside = f"({window}) AND " if window else ""
    lowest = [f"{column} {'<=' if cuts[0].after else '<'} {cuts[0].text}"] if cuts else []
    if not cuts:
        return [f"({window})" if window else "1 = 1"]
    out = [f"{inside}({lowest[0]} OR {column} IS NULL)"]
    for a, b in zip(cuts, cuts[1:]):
        low, high = (">" if a.after else ">="), ("<=" if b.after else "<")
        out.append(f"{inside}({column} {low} {a.text} AND {column} {high} {b.text})")
    out.append(f"{inside}({column} {'>' if cuts[-1].after else '>='} {cuts[-1].text})")
    return out


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    partition_column: str | None = None,
    slices: int | None = None,
    where: str | None = None,
) -> DataFrame:
    """A JDBC table, split at run time into ranges of like size when a column is named.

    ``where`` is the window; the source evaluates it, also while the cuts are looked up,
    and every range's predicate carries it.  The look-up moves the range column only.
    """
    relation = f"(SELECT * FROM {table} WHERE {where}) src" if where else table
    if partition_column is None:
        return spark.read.jdbc(url, relation, properties=properties)
    inside = spark.read.jdbc(url, relation, properties=properties).select(partition_column)
    cuts = depth_cuts(inside, partition_column, slices or spark.sparkContext.defaultParallelism)
    predicates = cut_predicates(partition_column, cuts, where)
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
