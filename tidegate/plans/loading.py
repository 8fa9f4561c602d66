"""Registered queries over table loads and appended tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegate.operators import bronze
from tidegate.operators.lineage import stamp_lineage
from tidegate.operators.reconcile import complete_copy, content_reconcile, contiguity, resumable_copy
from tidegate.plans import frames
from tidegate.plans.ingest import LoadCycle
from tidegate.plans.store import ControlStore
from tidegate.schemas import AUDIT, CONFIG, CONNECTIONS, RUN_REQUEST, STATE
from tidegate.session import local_frame, work_folder
from tidegate.sources import ranges
from tidegate.sources.tables import upper_bound, window_rows

QUERIES, SQL = {}, {}

INSTANT = "2026-01-31T23:59:59.123Z"
_STAMP = "TIMESTAMP '2026-01-31 23:59:59.123' AS _ingestion_timestamp"


def full_load(spark, folder):
    return stamp_lineage(frames.table(spark, folder, "part"), "B1", "R1", INSTANT)


SQL["full_load"] = f"""
SELECT *, 'B1' AS _batch_id, 'R1' AS _pipeline_run_id, {_STAMP} FROM part"""


def lineage_stamp(spark, folder):
    return stamp_lineage(frames.table(spark, folder, "documents"), "B1", "R1", INSTANT, True)


SQL["lineage_stamp"] = f"""
SELECT *, 'B1' AS _batch_id, 'R1' AS _pipeline_run_id, {_STAMP},
  DATE '2026-01-31' AS _ingestion_date FROM documents"""

LOW, HIGH = "1997-03-01T00:00:00.000", "1999-08-15T00:00:00.000"


def incremental_window(spark, folder):
    return window_rows(frames.table(spark, folder, "lineitem"), "l_shipdate", LOW, HIGH)


SQL["incremental_window"] = f"""
SELECT * FROM lineitem
WHERE l_shipdate > TIMESTAMP '{LOW}' AND l_shipdate <= TIMESTAMP '{HIGH}'"""


def source_upper_bound(spark, folder):
    parts = [
        upper_bound(frames.table(spark, folder, name), column).withColumn("name", F.lit(name))
        for name, column in (
            ("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"),
        )
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


SQL["source_upper_bound"] = """
SELECT max(o_orderdate) AS upper_bound, 'orders' AS name FROM orders
UNION ALL SELECT max(l_shipdate), 'lineitem' FROM lineitem
UNION ALL SELECT max(ts), 'events' FROM events"""


def range_partition_extract(spark, folder):
    rows = ranges.label_ranges(frames.table(spark, folder, "lineitem"), "l_orderkey", 8)
    return rows.groupBy("_range_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("l_orderkey").alias("first_key"),
        F.max("l_orderkey").alias("last_key"),
    )


SQL["range_partition_extract"] = """
WITH limits AS (SELECT min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM lineitem)
SELECT CAST((l_orderkey - lo) // ((hi - lo + 8) // 8) AS INTEGER) AS _range_id,
  count(*) AS row_count, min(l_orderkey) AS first_key, max(l_orderkey) AS last_key
FROM lineitem, limits GROUP BY 1"""

SLICES = 8


def range_window_extract(spark, folder):
    """Ranges inside a window over a column where one value has a third of the rows.

    One row per kind of range: rows, values outside their range's borders, and whether the
    largest range of several values has at most twice the mean of all ranges.
    """
    key = F.when(F.col("l_orderkey") % 3 == 0, 77).otherwise(F.col("l_orderkey") * F.col("l_orderkey"))
    lines = frames.table(spark, folder, "lineitem").withColumn("k", key)
    rows = window_rows(lines, "l_shipdate", LOW, HIGH)
    labelled = ranges.label_cuts(rows, "k", ranges.depth_cuts(rows, "k", SLICES))
    each = labelled.groupBy("_range_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("k").alias("first"), F.max("k").alias("last"),
    )
    alone = (F.col("first") == F.col("last")) & (F.col("first") == 77)
    total = rows.count()
    return each.groupBy(alone.alias("one_value")).agg(
        F.sum("n").alias("row_count"),
        (F.max("n") * SLICES <= 2 * F.lit(total)).alias("within_twice_the_mean"),
    )


SQL["range_window_extract"] = f"""
SELECT l_orderkey % 3 = 0 AS one_value, count(*) AS row_count, l_orderkey % 3 <> 0 AS within_twice_the_mean
FROM lineitem WHERE l_shipdate > TIMESTAMP '{LOW}' AND l_shipdate <= TIMESTAMP '{HIGH}' GROUP BY ALL"""

# Executions of one order table: two committed in one batch, one failed later.
EXECUTIONS = {"F": ("B1", "run:F"), "O": ("B1", "run:O"), "P": ("B2", "run:P")}


def _append_orders(spark, folder):
    """Append the orders as three executions; returns the table and the counts."""
    target = work_folder(spark, "orders")
    orders = frames.table(spark, folder, "orders")
    counts = {}
    for status, (batch, run) in EXECUTIONS.items():
        rows = orders.where(F.col("o_orderstatus") == status)
        stamped = stamp_lineage(rows, batch, run, INSTANT)
        counts[run] = bronze.append_execution(stamped, target)
    return target, counts


def _audit_of_orders(spark):
    return local_frame(
        spark,
        [
            ("B1", "run:F", "SUCCESS"), ("B1", "run:O", "SUCCESS"), ("B2", "run:P", "FAILED"),
            ("B2", "run:F", "SUCCESS"),
        ],
        StructType([f for f in AUDIT if f.name in ("batch_id", "pipeline_run_id", "status")]),
    )


def _per_execution(df):
    return df.groupBy("_batch_id", "_pipeline_run_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("o_orderkey").alias("key_sum")
    )


_EXECUTION_SQL = """
SELECT CASE o_orderstatus WHEN 'P' THEN 'B2' ELSE 'B1' END AS _batch_id,
  'run:' || o_orderstatus AS _pipeline_run_id, count(*) AS row_count,
  CAST(sum(o_orderkey) AS BIGINT) AS key_sum{more}
FROM orders {where} GROUP BY o_orderstatus"""


def bronze_append(spark, folder):
    target, counts = _append_orders(spark, folder)
    reported = F.lit(None).cast("bigint")
    for run, count in counts.items():
        reported = F.when(F.col("_pipeline_run_id") == run, F.lit(count)).otherwise(reported)
    return _per_execution(bronze.read_bronze(spark, target)).withColumn(
        "reported_count", reported.cast("bigint")
    )


SQL["bronze_append"] = _EXECUTION_SQL.format(more=", count(*) AS reported_count", where="")


def committed_read(spark, folder):
    target, _ = _append_orders(spark, folder)
    rows = bronze.read_committed(bronze.read_bronze(spark, target), _audit_of_orders(spark))
    return rows.drop("_ingestion_timestamp")


SQL["committed_read"] = """
SELECT *, 'B1' AS _batch_id, 'run:' || o_orderstatus AS _pipeline_run_id
FROM orders WHERE o_orderstatus IN ('F', 'O')"""


def compensating_delete(spark, folder):
    target, _ = _append_orders(spark, folder)
    removed = bronze.delete_execution(spark, target, *EXECUTIONS["O"])
    again = bronze.delete_execution(spark, target, *EXECUTIONS["O"])
    return _per_execution(bronze.read_bronze(spark, target)).withColumns(
        {"removed": F.lit(removed).cast("bigint"), "removed_again": F.lit(again).cast("bigint")}
    )


SQL["compensating_delete"] = _EXECUTION_SQL.format(
    more=""",
  (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS removed,
  CAST(0 AS BIGINT) AS removed_again""",
    where="WHERE o_orderstatus <> 'O'",
)


def orphan_executions(spark, folder):
    target, _ = _append_orders(spark, folder)
    return bronze.orphan_executions(bronze.read_bronze(spark, target), _audit_of_orders(spark))


SQL["orphan_executions"] = """
SELECT 'B2' AS _batch_id, 'run:P' AS _pipeline_run_id, count(*) AS row_count
FROM orders WHERE o_orderstatus = 'P'"""


def nested_append(spark, folder):
    """Array columns pass through the append unchanged."""
    target = work_folder(spark, "vectors")
    vectors = frames.table(spark, folder, "embeddings")
    bronze.append_execution(stamp_lineage(vectors, "B1", "R1", INSTANT), target)
    return bronze.read_bronze(spark, target).select(
        "vec_id", "label", F.size("embedding").cast("bigint").alias("dimensions"),
        F.aggregate(
            "embedding", F.lit(0.0), lambda total, x: total + x.cast("double")
        ).alias("total"),
    )


SQL["nested_append"] = """
SELECT vec_id, label, CAST(len(embedding) AS BIGINT) AS dimensions,
  list_reduce(list_transform(embedding, lambda x: CAST(x AS DOUBLE)), lambda a, b: a + b) AS total
FROM embeddings"""


def resumed_copy(spark, folder):
    """A copy that stopped at the middle id and was resumed."""
    target = work_folder(spark, "copy")
    source = frames.table(spark, folder, "orders").withColumn("id", F.col("o_orderkey") + 1)
    half = source.agg(F.floor(F.avg("id"))).first()[0]
    source.where(F.col("id") <= half).write.parquet(target)
    rest = resumable_copy(source, spark.read.parquet(target), "id")
    rest.write.mode("append").parquet(target)
    copied = spark.read.parquet(target)
    # both checks give one row for the same table
    checked = content_reconcile(source, copied, source.columns)
    ids = contiguity(copied, "id")
    return checked.withColumn("row_count", F.col("right_count")).join(ids, "row_count")


SQL["resumed_copy"] = """
SELECT count(*) AS row_count, count(*) AS left_count, count(*) AS right_count,
  true AS counts_equal, true AS checksum_equal, max(o_orderkey) + 1 AS max_id,
  count(*) = max(o_orderkey) + 1 AS is_contiguous, false AS exceeds_target FROM orders"""


RANGE = 500


def completed_copy(spark, folder):
    """A copy by id range with a hole in the middle, a half-written range, doubled rows and a
    range too many, brought to the source's rows; what was open then, and that nothing is now."""
    target = work_folder(spark, "ranges")
    source = frames.table(spark, folder, "orders").withColumn("id", F.col("o_orderkey") + 1)
    place = F.expr(f"id div {RANGE}")
    copy = source.withColumn("_range", place)
    half = (F.col("_range") == 2) & (F.col("id") % 2 == 0)
    broken = copy.where(~F.col("_range").isin(1, 2) | half).unionByName(copy.where(F.col("_range") == 0))
    extra = copy.where(F.col("_range") == 1).withColumn("_range", F.lit(1_000_000).cast("long"))
    extra = extra.withColumn("id", F.col("id") + 1_000_000 * RANGE)
    broken.unionByName(extra).write.partitionBy("_range").parquet(target)
    opened = complete_copy(source, target, "id", RANGE)
    copied = spark.read.parquet(target).select(*source.columns)
    checked = content_reconcile(source, copied, source.columns)
    result = checked.first()
    return opened.select(
        F.col("_range").alias("range_id"), "source_rows", "copied_rows",
        F.lit(result.counts_equal).alias("counts_equal"), F.lit(result.checksum_equal).alias("checksum_equal"),
    )


SQL["completed_copy"] = f"""
WITH each AS (SELECT (o_orderkey + 1) // {RANGE} AS r, count(*) AS n,
  count(CASE WHEN (o_orderkey + 1) % 2 = 0 THEN 1 END) AS even FROM orders GROUP BY 1)
SELECT CASE k WHEN 3 THEN 1000000 ELSE r END AS range_id, CASE k WHEN 3 THEN 0 ELSE n END AS source_rows,
  CASE k WHEN 0 THEN 2 * n WHEN 1 THEN 0 WHEN 2 THEN even ELSE n END AS copied_rows,
  true AS counts_equal, true AS checksum_equal
FROM each JOIN (VALUES (0, 0), (1, 1), (2, 2), (3, 1)) v(k, p) ON p = r"""


def load_cycle(spark, folder):
    """Three runs of one incremental object: load, nothing new, backfill."""
    root = work_folder(spark, "cycle")
    store = ControlStore(spark, root)
    configs = local_frame(
        spark,
        [(1, "SHOP", "src", "sales", "orders", None, "DATABASE", None, None, None, None, "lake",
          "sales", "orders", "INCREMENTAL", "o_orderdate", True)],
        CONFIG,
    )
    connections = local_frame(
        spark, [("src", "SQL_SERVER", "{}"), ("lake", "LAKEHOUSE", "{}")], CONNECTIONS
    )
    first = local_frame(
        spark, [(1, "o_orderdate", "1998-01-01T00:00:00", None, None, None)], STATE
    )
    store.commit(0, local_frame(spark, [], AUDIT), first)
    orders = frames.table(spark, folder, "orders")
    for step, request in enumerate(
        [(1, "REGULAR", "", ""), (1, "REGULAR", "", ""),
         (1, "BACKFILL", "1995-06-01T00:00:00", "1996-06-01T00:00:00")]
    ):
        cycle = LoadCycle(
            spark, store, configs, connections, f"{root}/lake", lambda row: orders, "", f"B{step}"
        )
        cycle.run(local_frame(spark, [request], RUN_REQUEST))
    loaded = bronze.read_committed(
        bronze.read_bronze(spark, f"{root}/lake/sales/orders"), store.audit()
    )
    rows = loaded.groupBy(F.col("_batch_id").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("stored_rows"), F.sum("o_orderkey").alias("key_sum")
    )
    return (
        store.audit()
        .select("batch_id", "run_type", "status", "processing_lower_bound",
                "processing_upper_bound", "source_row_count", "target_row_count")
        .join(rows, "batch_id", "left")
    )


SQL["load_cycle"] = """
WITH top AS (SELECT strftime(max(o_orderdate), '%Y-%m-%dT%H:%M:%S.%f') AS high FROM orders),
taken AS (
  SELECT CASE WHEN o_orderdate > TIMESTAMP '1998-01-01' THEN 'B0' ELSE 'B2' END AS batch_id,
    count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders
  WHERE o_orderdate > TIMESTAMP '1998-01-01'
    OR (o_orderdate > TIMESTAMP '1995-06-01' AND o_orderdate <= TIMESTAMP '1996-06-01')
  GROUP BY 1)
SELECT r.batch_id, run_type, status, low AS processing_lower_bound,
  coalesce(upper, high) AS processing_upper_bound, coalesce(n, 0) AS source_row_count,
  coalesce(n, 0) AS target_row_count, n AS stored_rows, key_sum
FROM (SELECT 'B0' AS batch_id, 'REGULAR' AS run_type, 'SUCCESS' AS status,
    '1998-01-01T00:00:00' AS low, NULL AS upper
  UNION ALL SELECT 'B1', 'REGULAR', 'SKIPPED', (SELECT high FROM top), NULL
  UNION ALL SELECT 'B2', 'BACKFILL', 'SUCCESS', '1995-06-01T00:00:00', '1996-06-01T00:00:00') r,
  top LEFT JOIN taken t ON t.batch_id = r.batch_id"""

for _query in (
    full_load, lineage_stamp, incremental_window, source_upper_bound, range_partition_extract,
    range_window_extract, bronze_append, committed_read, compensating_delete, orphan_executions, nested_append,
    resumed_copy, completed_copy, load_cycle,
):
    QUERIES[_query.__name__] = _query
QUERIES["resumable_copy"] = QUERIES.pop("resumed_copy")
SQL["resumable_copy"] = SQL.pop("resumed_copy")
