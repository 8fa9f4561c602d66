"""Running sums and XORs along ordered groups of any length.

A group is cut where the range partitioning of the whole table cuts it, so one that holds a
third of all rows is worked on by a third of the tasks. What lies before a part of a group is
found from the parts' totals, of which a group has at most as many as there are tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.shared import tasks, written

PART, PLACE = "_part", "_place"


def spread(df: DataFrame, group: str, order: list[str], keep: list[str]) -> DataFrame:
    """The columns ``group`` and ``keep`` with the number of a row's part and its place there,
    rising along ``order`` (nulls first) within a group."""
    ranged = df.repartitionByRange(tasks(df), group, *order).sortWithinPartitions(group, *order)
    return written(
        ranged.select(group, *keep, F.spark_partition_id().alias(PART), F.monotonically_increasing_id().alias(PLACE)),
        "spread",
    )


def part_totals(rows: DataFrame, group: str, totals: dict[str, Column], backward: bool = False) -> DataFrame:
    """``totals`` of every part of a group and, named ``before_*``, of the parts before it
    (after it if ``backward``; null for the first)."""
    parts = rows.groupBy(group, PART).agg(*[c.alias(n) for n, c in totals.items()])
    order = F.desc(PART) if backward else F.asc(PART)
    window = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = [_over(name, window).alias(f"before_{name}") for name in totals]
    return parts.select("*", *before)


def _over(name: str, window) -> Column:
    return (F.bit_xor(name) if name.startswith("xor") else F.sum(name)).over(window)


def running(rows: DataFrame, parts: DataFrame, group: str, values: dict[str, str], backward: bool = False,
            how: str = "inner") -> DataFrame:
    """Rows joined with their part's columns; for every total in ``values`` (name to column)
    ``run_*`` is the total of its column up to and including the row."""
    window = Window.partitionBy(group, PART).orderBy(F.desc(PLACE) if backward else F.asc(PLACE))
    window = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = rows.join(parts, [group, PART], how)
    made = []
    for name, column in values.items():
        before = F.coalesce(f"before_{name}", F.lit(0).cast("long"))
        if name.startswith("xor"):
            made.append(F.bit_xor(column).over(window).bitwiseXOR(before).alias(f"run_{name}"))
        else:
            made.append((F.sum(column).over(window) + before).alias(f"run_{name}"))
    return joined.select("*", *made)
