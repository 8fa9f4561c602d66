"""Mixing sources to target weights by systematic sampling.

Sources share a budget by weight, and none beyond a multiple of its size: with sources in
the order of size per weight, the level is where the budget left fits the weights left. The
documents of a source all have the same expected number of copies, target by size. Laid out
in a fixed order, document k covers the stretch from (k - 1) to k times that number; shifted
by one random offset, it is taken once for each whole number its stretch crosses.

The order is by size, so that a source's taken words come close to its target. Positions are
counted over range partitions (sizes split a hot source), so no source is in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.shared import col, tasks, written

WEIGHTS = (3.0, 1.0, 2.0)  # by source in code-point order, repeating
SHARE = 1.5  # of all sizes
MOST = 2.0  # times a source's size
SEED = 7


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; 0 for null."""
    gaps = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.size(F.filter(F.split(gaps, " "), lambda w: w != "")).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """``source``, ``source_size`` with ``target``: one row per source in and out."""
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(order) - 1) % len(WEIGHTS) + 1)
    weighed = sizes.withColumn("weight", weight)
    most = MOST * F.col("source_size")
    everything = Window.partitionBy()
    level = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    after = level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = SHARE * F.sum("source_size").over(everything) - F.coalesce(F.sum(most).over(before), F.lit(0.0))
    height = left / F.sum("weight").over(after)
    # the first source whose most lies above the level sets it for itself and all later ones
    marked = weighed.withColumn("height", F.when(most >= height * F.col("weight"), height))
    first = F.first("height", ignorenulls=True).over(
        level.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    capped = F.when(first.isNull(), most).otherwise(F.least(most, first * F.col("weight")))
    return marked.select("source", "source_size", capped.cast("double").alias("target"))


def positions(rows: DataFrame) -> DataFrame:
    """``rows`` (``source``, ``size``, ``doc_id``, ``tie``) with ``place``: the row's number from 1
    within its source, by size, id and tie."""
    order = [F.col("source").isNull(), F.col("source"), F.col("size"), F.col("doc_id"), F.col("tie")]
    n = tasks(rows)
    sorted_rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    numbered = written(sorted_rows.withColumn("row", F.monotonically_increasing_id()), "numbered")
    numbered = numbered.withColumn("part", F.shiftrightunsigned("row", 33))
    starts = numbered.groupBy("source", "part").agg(
        F.min("row").alias("first"), F.count(F.lit(1)).alias("n")
    )
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(
        F.col("source").alias("_source"), F.col("part").alias("_part"),
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1).alias("shift"),
    )
    joined = numbered.join(
        starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("part") == F.col("_part"))
    )
    return joined.withColumn("place", F.col("row") + F.col("shift")).drop("_source", "_part", "shift", "row", "part")


def offset(seed: int, source: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the source alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("\x00null"))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(2**48))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``size``, ``source``, ``source_size``, ``target``,
    ``tie``, ``copies``, ``taken``.

    ``copies`` is how often the mix takes the document, ``taken`` its words times that. A null
    source is a source of its own, after all others; a null or empty text has size 0; repeated
    rows are documents of their own; an empty table gives no rows. Runs agree.
    """
    rows = docs.select(
        col(doc_id).alias("doc_id"), col(source).alias("source"), word_count(col(text)).alias("size"),
        F.xxhash64(F.coalesce(col(text), F.lit(""))).alias("tie"),
    )
    placed = positions(rows)
    sizes = placed.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = targets(sizes).withColumnRenamed("source", "_source")
    held = placed.join(goal, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    shift = offset(seed, F.col("source"))
    copies = F.floor(F.col("place") * each + shift) - F.floor((F.col("place") - 1) * each + shift)
    return held.withColumn("copies", copies.cast("long")).select(
        "doc_id", "size", "source", "source_size", "target", "tie", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    source: str = "source", seed: int = SEED) -> DataFrame:
    """The documents the mix takes, each as often as it takes it, with the columns of ``docs``."""
    names = docs.columns
    plain = docs.select(*[col(c).alias(f"c{i}") for i, c in enumerate(names)])
    own = {c: f"c{names.index(c)}" for c in (doc_id, text, source)}
    taken = mix(plain, own[doc_id], own[text], own[source], seed)
    # rows alike in id, source and text are one row here, which stands for all their copies
    taken = (
        taken.groupBy(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("tie").alias("_t"))
        .agg(F.sum("copies").alias("_n"))
        .where(F.col("_n") > 0)
    )
    keyed = plain.withColumn("_x", F.xxhash64(F.coalesce(F.col(own[text]), F.lit(""))))
    found = keyed.join(
        taken,
        F.col(own[doc_id]).eqNullSafe(F.col("_d"))
        & F.col(own[source]).eqNullSafe(F.col("_s"))
        & (F.col("_x") == F.col("_t")),
    ).dropDuplicates(["_d", "_s", "_t"])
    repeated = found.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    return repeated.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
