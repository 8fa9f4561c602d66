"""JSON helpers on text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bracketed(text: Column) -> Column:
    """The text parsed as the only element of an array.

    Parsers stop after the first value; inside brackets anything that follows it
    breaks the parse or becomes a second element.
    """
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))


def opens_with(text: Column, mark: str) -> Column:
    return F.startswith(F.ltrim(text, F.lit("\t\n\r ")), F.lit(mark))


def _is_one(text: Column, mark: str) -> Column:
    elements = F.try_variant_get(bracketed(text), "$", "array<variant>")
    return F.coalesce(opens_with(text, mark) & (F.size(elements) == 1), F.lit(False))


def is_json_array(text: Column) -> Column:
    """True for one complete JSON array; false for NULL and anything else."""
    return _is_one(text, "[")


def is_json_object(text: Column) -> Column:
    """True for one complete JSON object; false for NULL and anything else."""
    return _is_one(text, "{")


def kind_of(value: Column) -> Column:
    """Type name of a variant; NULL when the value is absent."""
    return F.when(value.isNotNull(), F.schema_of_variant(value))


def with_key(text: Column, key: str, value: Column) -> Column:
    """The JSON object with one key set or replaced; other values keep their types."""
    entries = F.from_json(text, "map<string,variant>")
    kept = F.map_filter(entries, lambda name, _: name != key)
    return F.to_json(F.map_concat(kept, F.create_map(F.lit(key), value.cast("variant"))))
