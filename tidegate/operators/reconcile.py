"""Comparing tables: content, schema, key contiguity, profiles."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidegate.operators.bronze import path_exists, qualified, remove_folders
from tidegate.sources.files import discover, store_uri

LANES = (0, 16, 32, 48)
PART_BITS = 16  # tables are compared in so many bits' worth of parts


def _fingerprint_parts(row_hash: Column) -> dict[str, Column]:
    """Order-free summary of 64-bit row hashes.

    XOR alone loses pairs of equal rows.  The hashes are therefore also summed,
    in four lanes of 16 bits that cannot overflow for 2^47 rows and need no
    decimal arithmetic.
    """
    parts = {"xor": F.bit_xor(row_hash)}
    for shift in LANES:
        lane = F.shiftrightunsigned(row_hash, shift).bitwiseAND(0xFFFF)
        parts[f"lane{shift}"] = F.sum(lane)
    return parts


def _row_hash(columns: list[str]) -> Column:
    """A row's hash; each column goes with its null flag, because a hash passes over NULLs."""
    return F.xxhash64(*[part for c in columns for part in (F.col(c), F.col(c).isNull())])


def content_fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row that is equal for two tables with the same rows in any order."""
    parts = _fingerprint_parts(_row_hash(columns))
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), *[e.alias(name) for name, e in parts.items()]
    )


def content_reconcile(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Counts and checksum comparison of two tables, in one aggregate over both."""
    row_hash = _row_hash(columns).alias("_hash")
    both = left.select(F.lit("L").alias("_side"), row_hash).unionByName(
        right.select(F.lit("R").alias("_side"), row_hash)
    )
    summary = {}
    for side in ("L", "R"):
        mine = F.when(F.col("_side") == side, F.col("_hash"))
        for name, part in _fingerprint_parts(mine).items():
            summary[f"{side}_{name}"] = part
    equal = F.lit(True)
    for name in ("xor", *[f"lane{shift}" for shift in LANES]):
        equal = equal & F.col(f"L_{name}").eqNullSafe(F.col(f"R_{name}"))
    totals = both.agg(
        F.count(F.when(F.col("_side") == "L", 1)).alias("left_count"),
        F.count(F.when(F.col("_side") == "R", 1)).alias("right_count"),
        *[part.alias(name) for name, part in summary.items()],
    )
    same_count = F.col("left_count") == F.col("right_count")
    return totals.select(
        "left_count",
        "right_count",
        same_count.alias("counts_equal"),
        (same_count & equal).alias("checksum_equal"),
    )


def _parted(df: DataFrame, columns: list[str], side: int) -> DataFrame:
    """The columns with the row's hash, the part of the table it falls in, and its side."""
    row_hash = _row_hash(columns)
    return df.select(
        *columns, row_hash.alias("_hash"), F.shiftrightunsigned(row_hash, 64 - PART_BITS).alias("_part"),
        F.lit(side).alias("_copy"),
    )


def differing_parts(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Parts of the hash range in which the two tables do not hold the same rows.

    Only digests are shuffled, at most one row per part and task.
    """
    both = _parted(left, columns, 1).unionByName(_parted(right, columns, -1))
    signed = [
        F.sum(F.shiftrightunsigned("_hash", shift).bitwiseAND(0xFFFF) * F.col("_copy")).alias(f"lane{shift}")
        for shift in LANES
    ]
    digests = both.groupBy("_part").agg(
        F.sum("_copy").alias("rows"), F.bit_xor("_hash").alias("xor"), *signed
    )
    off = F.lit(False)
    for name in ("rows", "xor", *[f"lane{shift}" for shift in LANES]):
        off = off | (F.col(name) != 0)
    return digests.where(off).select("_part")


def data_drift(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that occur more often on one side, and how many more times.

    The tables are first compared by digests of parts of the hash range; rows are moved
    only from parts that differ, of which there are at most 2^PART_BITS numbers to
    broadcast.  For equal tables nothing but digests is shuffled, and the second pass ends
    at the scan.  Both directions come from one grouping, with copies summed before the
    shuffle, so a row repeated many times does not pile up anywhere.
    """
    parts = F.broadcast(differing_parts(left, right, columns))
    both = _parted(left, columns, 1).unionByName(_parted(right, columns, -1))
    moved = both.join(parts, "_part", "left_semi")
    surplus = moved.groupBy(*columns).agg(F.sum("_copy").alias("_surplus"))
    return surplus.where(F.col("_surplus") != 0).select(
        *columns,
        F.when(F.col("_surplus") > 0, "LEFT").otherwise("RIGHT").alias("only_in"),
        F.abs("_surplus").alias("copies"),
    )


def schema_rows(df: DataFrame) -> DataFrame:
    """One row per column: name, type, place, and whether values are missing.

    Lake files declare every column nullable, so it is measured in one pass.
    """
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(field.name).alias(field.name) for field in df.schema.fields],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.lit(place).alias("ordinal"),
                (F.col("_rows") > F.col(field.name)).alias("has_nulls"),
            )
            for place, field in enumerate(df.schema.fields, start=1)
        ]
    )
    return counted.select(F.inline(rows))


FOOTERS = "column_name string, row_count long, known_rows long, nulls long"


def footer_nulls(spark: SparkSession, path: str) -> DataFrame:
    """Per top-level column of the Parquet files below a folder: rows of the files that have
    it, rows in row groups that state its nulls, and the nulls stated.

    Tasks list the folder and read footers; no data page is read.  A column with parts of
    its own (array, struct, map) has no rows of known nulls.
    """
    files = discover(spark, path, "*.parquet").where("length > 0").select("path")

    def read(batches):
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            for name in batch["path"]:
                store, place = fs.FileSystem.from_uri(store_uri(name))
                with store.open_input_file(place) as file:
                    footer = pq.ParquetFile(file).metadata
                found = {}
                for i in range(footer.num_columns):
                    whole = footer.schema.column(i).path
                    found.setdefault(whole.partition(".")[0], [footer.num_rows, 0, 0])
                    if "." in whole or footer.schema.column(i).max_repetition_level:
                        continue
                    for group in range(footer.num_row_groups):
                        chunk = footer.row_group(group).column(i)
                        if chunk.statistics is not None and chunk.statistics.has_null_count:
                            found[whole][1] += footer.row_group(group).num_rows
                            found[whole][2] += chunk.statistics.null_count
                rows = [(column, *counts) for column, counts in found.items()]
                rows.append((None, footer.num_rows, 0, 0))
                yield pd.DataFrame(rows, columns=["column_name", "row_count", "known_rows", "nulls"])

    width = 4 * spark.sparkContext.defaultParallelism
    read_in_tasks = files.repartition(width, "path").mapInPandas(read, FOOTERS)
    return read_in_tasks.groupBy("column_name").agg(
        *[F.sum(name).alias(name) for name in ("row_count", "known_rows", "nulls")]
    )


def schema_rows_of_files(spark: SparkSession, path: str) -> DataFrame:
    """What ``schema_rows`` says of the Parquet table in a folder, from its files' footers.

    Columns whose nulls the footers do not state (nested ones, columns of the folder names,
    files written without statistics) are measured by a scan of those columns alone.
    """
    table = spark.read.option("mergeSchema", "true").parquet(path)
    stated = {row.column_name: row for row in footer_nulls(spark, path).collect()}  # a row per column
    total = stated.pop(None).row_count if None in stated else 0
    missing, open_columns = {}, []
    for name in table.columns:
        row = stated.get(name)
        if row is None or row.known_rows < row.row_count:
            open_columns.append(name)
        else:
            missing[name] = row.nulls > 0 or row.row_count < total
    if open_columns:
        measured = table.select(*open_columns).agg(
            F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{name}`")).alias(name) for name in open_columns]
        ).first()
        missing |= {name: measured["_rows"] > measured[name] for name in open_columns}
    rows = [
        (field.name, field.dataType.simpleString(), place, missing[field.name])
        for place, field in enumerate(table.schema.fields, start=1)
    ]
    return spark.createDataFrame(rows, "column_name string, data_type string, ordinal int, has_nulls boolean")


def drift_of_schemas(one: DataFrame, other: DataFrame) -> DataFrame:
    """Rows of two column descriptions found on one side only."""
    return one.exceptAll(other).withColumn("only_in", F.lit("LEFT")).unionByName(
        other.exceptAll(one).withColumn("only_in", F.lit("RIGHT"))
    )


def schema_drift(left: DataFrame, right: DataFrame) -> DataFrame:
    """Column descriptions found on one side only; none when the schemas agree."""
    return drift_of_schemas(schema_rows(left), schema_rows(right))


def schema_drift_of_files(spark: SparkSession, left: str, right: str) -> DataFrame:
    """The same for two Parquet folders, without reading their data."""
    return drift_of_schemas(schema_rows_of_files(spark, left), schema_rows_of_files(spark, right))


def contiguity(df: DataFrame, column: str, target: int | None = None) -> DataFrame:
    """Whether ids run from 1 without gaps, and whether they exceed a target."""
    totals = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.max(column), F.lit(0)).cast("bigint").alias("max_id"),
    )
    over = F.col("row_count") > F.lit(target) if target is not None else F.lit(False)
    return totals.select(
        "row_count",
        "max_id",
        (F.col("row_count") == F.col("max_id")).alias("is_contiguous"),
        over.alias("exceeds_target"),
    )


def table_profile(tables: dict[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """Row count and watermark range of each table, one row per table."""
    result = None
    for name, (df, column) in tables.items():
        low, high = (
            (F.min(column), F.max(column)) if column else (F.lit(None), F.lit(None))
        )
        row = df.agg(
            F.count(F.lit(1)).alias("row_count"),
            low.cast("timestamp_ntz").alias("min_value"),
            high.cast("timestamp_ntz").alias("max_value"),
        ).select(F.lit(name).alias("table_name"), "row_count", "min_value", "max_value")
        result = row if result is None else result.unionByName(row)
    return result


def partition_profile(df: DataFrame, date_column: str) -> DataFrame:
    """Rows and date range of each calendar month."""
    day = F.col(date_column).cast("date")
    return df.groupBy((F.year(day) * 100 + F.month(day)).alias("partition_month")).agg(
        F.min(day).alias("min_date"), F.max(day).alias("max_date"),
        F.count(F.lit(1)).alias("row_count"),
    )


def resumable_copy(source: DataFrame, copied: DataFrame, key: str) -> DataFrame:
    """Source rows an interrupted copy has not reached: ids above the target's last."""
    last = copied.agg(F.max(key)).first()[0]
    return source if last is None else source.where(F.col(key) > F.lit(last))


def range_ledger(df: DataFrame, place: Column, columns: list[str]) -> DataFrame:
    """Rows and checksums of each range."""
    return df.groupBy(place.alias("_range")).agg(
        F.count(F.lit(1)).alias("row_count"),
        *[part.alias(name) for name, part in _fingerprint_parts(_row_hash(columns)).items()],
    )


def _range_of(key: str, width: int) -> Column:
    """Number of the fixed range of ``width`` ids; NULL ids are a range of their own."""
    number = F.col(key).cast("bigint")
    return ((number - F.pmod(number, F.lit(width))) / F.lit(width)).cast("bigint").alias("_range")


def open_ranges(
    source: DataFrame, copied: DataFrame, key: str, width: int, kept_in: str | None = None
) -> DataFrame:
    """Ranges whose rows differ between source and copy: ``_range`` and the rows on either side.

    Holes, half-written ranges and changed or surplus rows all show; only ledgers are shuffled.
    The copy's rows belong to the range that column ``kept_in`` names, if it is given.
    """
    columns, place = source.columns, _range_of(key, width)
    sides = [
        range_ledger(df, where, columns).withColumn("_side", F.lit(side))
        for df, where, side in (
            (source, place, "S"), (copied, F.col(kept_in) if kept_in else place, "C")
        )
    ]
    both = sides[0].unionByName(sides[1])
    digest = F.struct("row_count", "xor", *[f"lane{shift}" for shift in LANES])
    mine = lambda side, value: F.max(F.when(F.col("_side") == side, value))
    met = both.groupBy("_range").agg(
        mine("S", digest).alias("_source"), mine("C", digest).alias("_copy"),
        F.coalesce(mine("S", F.col("row_count")), F.lit(0)).alias("source_rows"),
        F.coalesce(mine("C", F.col("row_count")), F.lit(0)).alias("copied_rows"),
    )
    return met.where(~F.col("_source").eqNullSafe(F.col("_copy"))).select("_range", "source_rows", "copied_rows")


def complete_copy(source: DataFrame, target: str, key: str, width: int) -> DataFrame:
    """Bring a copy that is kept by id range (folders ``_range=``) to the source's rows.

    Ranges that agree are neither read again nor written; each other one is written anew as
    a whole in place of what lies there, so nothing is there twice however often this runs.
    Ranges the source does not have are removed by tasks.  Returns the ranges that were open.
    """
    spark = source.sparkSession
    schema = StructType([*source.schema.fields, StructField("_range", LongType())])
    if path_exists(spark, target):
        there = spark.read.schema(schema).parquet(target)
    else:
        there = spark.createDataFrame([], schema)
    todo = open_ranges(source, there, key, width, "_range").checkpoint()
    wanted = source.withColumn("_range", _range_of(key, width)).join(
        todo.where("source_rows > 0").select(F.col("_range").alias("_open")),
        F.col("_range").eqNullSafe(F.col("_open")), "left_semi",
    )
    writer = wanted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("_range").parquet(target)
    name = F.coalesce(F.col("_range").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    surplus = todo.where("source_rows = 0").select(
        F.concat(F.lit(qualified(spark, target) + "/_range="), name).alias("path")
    )
    remove_folders(surplus).count()
    return todo
