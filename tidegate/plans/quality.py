"""Registered queries comparing and profiling tables, and small value rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.functions import temporal, text
from tidegate.operators import landing, positions, reconcile, sales
from tidegate.plans import frames
from tidegate.session import work_folder

QUERIES, SQL = {}, {}

LINE = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def _drifted(lines):
    """A copy with changed, lost and repeated rows."""
    changed = F.when(F.col("l_discount") == 0.05, "X").otherwise(F.col("l_linestatus"))
    kept = lines.where(F.col("l_returnflag").isin("A", "N") | (F.col("l_tax") > 0))
    repeated = lines.where(F.col("l_tax") == 0.08)
    return kept.withColumn("l_linestatus", changed).unionByName(repeated)


_DRIFTED = f"""
drifted AS (
  SELECT * REPLACE (CASE WHEN l_discount = 0.05 THEN 'X' ELSE l_linestatus END AS l_linestatus)
  FROM lineitem WHERE l_returnflag IN ('A', 'N') OR l_tax > 0
  UNION ALL SELECT * FROM lineitem WHERE l_tax = 0.08),
drift AS (
  SELECT *, 'LEFT' AS only_in FROM (SELECT * FROM lineitem EXCEPT ALL SELECT * FROM drifted)
  UNION ALL
  SELECT *, 'RIGHT' FROM (SELECT * FROM drifted EXCEPT ALL SELECT * FROM lineitem))"""


def content_reconcile(spark, folder):
    lines = frames.table(spark, folder, "lineitem")
    spread = lines.repartition(16, "l_partkey")
    same = reconcile.content_reconcile(lines, spread, LINE)
    other = reconcile.content_reconcile(lines, _drifted(lines), LINE)
    keys, flag = ["l_orderkey", "l_linenumber"], F.col("l_linestatus")
    none = F.lit(None).cast("string")
    moved = reconcile.content_reconcile(
        lines.select(*keys, none.alias("a"), flag.alias("b")),
        lines.select(*keys, flag.alias("a"), none.alias("b")),
        [*keys, "a", "b"],
    )
    return (
        same.withColumn("pair", F.lit("copy"))
        .unionByName(other.withColumn("pair", F.lit("drifted")))
        .unionByName(moved.withColumn("pair", F.lit("nulls moved")))
    )


SQL["content_reconcile"] = f"""
WITH {_DRIFTED.strip()}
SELECT 'copy' AS pair, count(*) AS left_count, count(*) AS right_count, true AS counts_equal,
  true AS checksum_equal FROM lineitem
UNION ALL
SELECT 'nulls moved', count(*), count(*), true, false FROM lineitem
UNION ALL
SELECT 'drifted', l, r, l = r, (SELECT count(*) FROM drift) = 0
FROM (SELECT (SELECT count(*) FROM lineitem) AS l, (SELECT count(*) FROM drifted) AS r)"""


def data_drift(spark, folder):
    lines = frames.table(spark, folder, "lineitem")
    return reconcile.data_drift(lines, _drifted(lines), LINE)


SQL["data_drift"] = f"""
WITH {_DRIFTED.strip()}
SELECT {', '.join(LINE)}, only_in, count(*) AS copies FROM drift GROUP BY ALL"""


def schema_drift(spark, folder):
    orders = frames.table(spark, folder, "orders")
    changed = orders.select(
        "o_orderkey",
        F.col("o_custkey").cast("int").alias("o_custkey"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_orderdate",
        "o_totalprice",
        F.lit("new").alias("o_comment"),
    )
    copy = work_folder(spark, "changed-orders")
    changed.write.parquet(copy)
    return reconcile.schema_drift_of_files(spark, f"{folder}/orders.parquet", copy)


SQL["schema_drift"] = """
WITH same AS (SELECT count(*) > count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) AS missing,
  count(*) > count(o_orderkey) AS none FROM orders)
SELECT column_name, data_type, ordinal, has_nulls, only_in FROM same, LATERAL (VALUES
  ('o_custkey', 'bigint', 2, none, 'LEFT'), ('o_custkey', 'int', 2, none, 'RIGHT'),
  ('o_orderstatus', 'string', 3, none, 'LEFT'), ('o_orderstatus', 'string', 3, missing, 'RIGHT'),
  ('o_totalprice', 'double', 4, none, 'LEFT'), ('o_orderdate', 'timestamp_ntz', 4, none, 'RIGHT'),
  ('o_orderdate', 'timestamp_ntz', 5, none, 'LEFT'), ('o_totalprice', 'double', 5, none, 'RIGHT'),
  ('o_orderpriority', 'string', 6, none, 'LEFT'), ('o_comment', 'string', 6, none, 'RIGHT'))
  v(column_name, data_type, ordinal, has_nulls, only_in)
WHERE NOT (column_name = 'o_orderstatus' AND NOT missing)"""


def contiguity_check(spark, folder):
    orders = frames.table(spark, folder, "orders").select((F.col("o_orderkey") + 1).alias("id"))
    lines = frames.table(spark, folder, "lineitem").select((F.col("l_orderkey") + 1).alias("id"))
    return (
        reconcile.contiguity(orders, "id", 10_000).withColumn("name", F.lit("orders"))
        .unionByName(
            reconcile.contiguity(lines, "id").withColumn("name", F.lit("lineitem"))
        )
    )


SQL["contiguity_check"] = """
SELECT 'orders' AS name, count(*) AS row_count, max(o_orderkey) + 1 AS max_id,
  count(*) = max(o_orderkey) + 1 AS is_contiguous, count(*) > 10000 AS exceeds_target FROM orders
UNION ALL SELECT 'lineitem', count(*), max(l_orderkey) + 1, count(*) = max(l_orderkey) + 1, false
FROM lineitem"""


def table_profile(spark, folder):
    named = lambda name: frames.table(spark, folder, name)
    return reconcile.table_profile(
        {
            "orders": (named("orders"), "o_orderdate"),
            "lineitem": (named("lineitem"), "l_shipdate"),
            "events": (named("events"), "ts"),
            "part": (named("part"), None),
        }
    )


SQL["table_profile"] = """
SELECT 'orders' AS table_name, count(*) AS row_count, min(o_orderdate) AS min_value,
  max(o_orderdate) AS max_value FROM orders
UNION ALL SELECT 'lineitem', count(*), min(l_shipdate), max(l_shipdate) FROM lineitem
UNION ALL SELECT 'events', count(*), min(ts), max(ts) FROM events
UNION ALL SELECT 'part', count(*), CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP) FROM part"""


def partition_profile(spark, folder):
    return reconcile.partition_profile(frames.table(spark, folder, "lineitem"), "l_shipdate")


SQL["partition_profile"] = """
SELECT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS partition_month,
  CAST(min(l_shipdate) AS DATE) AS min_date, CAST(max(l_shipdate) AS DATE) AS max_date,
  count(*) AS row_count
FROM lineitem GROUP BY 1"""


def order_totals(spark, folder):
    orders = frames.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 80).otherwise(40)
        .cast("decimal(12,2)").alias("shipping_amount"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("discount_amount"),
        F.lit(0).cast("decimal(14,2)").alias("order_total"),
    )
    lines = frames.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        sales.line_amount(F.col("l_quantity"), F.col("l_extendedprice")).alias("line_amount"),
    )
    return sales.order_totals(orders, lines)


SQL["order_totals"] = """
SELECT o_orderkey AS order_id, shipping AS shipping_amount, discount AS discount_amount,
  CAST(CASE WHEN items IS NULL THEN 0 ELSE greatest(0, items + shipping - discount) END
    AS DECIMAL(14,2)) AS order_total
FROM (SELECT o_orderkey,
    CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 80 ELSE 40 END AS DECIMAL(12,2)) AS shipping,
    CAST(o_totalprice AS DECIMAL(12,2)) AS discount FROM orders)
LEFT JOIN (SELECT l_orderkey,
    sum(CAST(l_quantity AS DECIMAL(10,0)) * CAST(l_extendedprice AS DECIMAL(12,2))) AS items
  FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey"""


def conditional_pivot(spark, folder):
    lines = frames.table(spark, folder, "lineitem")
    return sales.conditional_pivot(
        lines, ["l_orderkey"], "l_linenumber", "l_partkey", list(range(1, 8)), "part_"
    )


SQL["conditional_pivot"] = """
SELECT l_orderkey, max(CASE WHEN l_linenumber = 1 THEN l_partkey END) AS part_1,
  max(CASE WHEN l_linenumber = 2 THEN l_partkey END) AS part_2,
  max(CASE WHEN l_linenumber = 3 THEN l_partkey END) AS part_3,
  max(CASE WHEN l_linenumber = 4 THEN l_partkey END) AS part_4,
  max(CASE WHEN l_linenumber = 5 THEN l_partkey END) AS part_5,
  max(CASE WHEN l_linenumber = 6 THEN l_partkey END) AS part_6,
  max(CASE WHEN l_linenumber = 7 THEN l_partkey END) AS part_7
FROM lineitem GROUP BY l_orderkey"""


def positional_join(spark, folder):
    orders = frames.table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    customers = frames.table(spark, folder, "customer").select("c_custkey", "c_name")
    return positions.positional_join(
        orders, ["o_orderdate", "o_orderkey"], customers, ["c_name"], ["c_custkey"]
    )


SQL["positional_join"] = """
SELECT o_orderkey, o_orderdate, child_position, c_custkey FROM (
  SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey)
    AS child_position FROM orders) o
JOIN (SELECT c_custkey, row_number() OVER (ORDER BY c_name) AS place FROM customer) c
  ON place = (child_position - 1) % (SELECT count(*) FROM customer) + 1"""


def padded_keys(spark, folder):
    key = F.col("event_id")
    return frames.table(spark, folder, "events").select(
        "event_id",
        text.padded_key("ITEM", key, 6).alias("item_key"),
        text.padded_key("", key * 7919, 4).alias("tail_key"),
        text.fixed_payload("ROW-", key, 20, 512).alias("payload"),
    )


SQL["padded_keys"] = """
SELECT event_id, 'ITEM' || right('000000' || event_id, 6) AS item_key,
  right('0000' || (event_id * 7919), 4) AS tail_key,
  rpad('ROW-' || lpad(CAST(event_id AS VARCHAR), 20, '0') || '-', 512, 'X') AS payload
FROM events"""


def derived_dates(spark, folder):
    key, base = F.col("event_id"), F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    whole = lambda n: F.pmod(key, F.lit(n)).cast("int")
    day = temporal.shifted(base, whole(365), "DAYS")
    return frames.table(spark, folder, "events").select(
        "event_id",
        day.alias("day"),
        temporal.shifted(day, whole(96), "HOURS").alias("hour"),
        temporal.shifted(day, whole(1440), "MINS").alias("minute"),
        temporal.shifted(
            temporal.shifted(day, whole(86400), "SECS"), whole(1000), "MILLISECONDS"
        ).alias("instant"),
        temporal.utc_text(temporal.shifted(day, whole(1000), "MILLISECONDS")).alias("utc_text"),
    )


SQL["derived_dates"] = """
SELECT event_id, day, day + to_hours(event_id % 96) AS hour,
  day + to_minutes(event_id % 1440) AS minute,
  day + to_seconds(event_id % 86400) + to_milliseconds(event_id % 1000) AS instant,
  strftime(day + to_milliseconds(event_id % 1000), '%Y-%m-%dT%H:%M:%S.%gZ') AS utc_text
FROM (SELECT event_id,
  TIMESTAMP '2026-01-01' + to_days(CAST(event_id % 365 AS INTEGER)) AS day FROM events)"""

# fixed values: order states by the remainder of the order number
_STATES = ["COMPLETED", "SHIPPED", "PROCESSING", "PAID", "PENDING", "CANCELLED"]


def case_buckets(spark, folder):
    state = text.bucket_label(F.col("o_orderkey"), _STATES)
    return (
        frames.table(spark, folder, "orders")
        .groupBy(state.alias("order_state"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


SQL["case_buckets"] = (
    "SELECT CASE o_orderkey % 6 "
    + " ".join(f"WHEN {place} THEN '{name}'" for place, name in enumerate(_STATES))
    + " END AS order_state, count(*) AS row_count FROM orders GROUP BY 1"
)


def error_text(spark, folder):
    """Cut messages: one error, two errors, and a list of duplicates."""
    message, other = F.col("text"), F.concat(F.col("source"), F.lit(": "), F.col("text"))
    return frames.table(spark, folder, "documents").select(
        "doc_id",
        text.audit_message(message).alias("message"),
        text.paired_message("load", message, "cleanup", other).alias("paired"),
        text.duplicate_list(message).alias("listed"),
    )


SQL["error_text"] = """
SELECT doc_id, left(text, 4000) AS message,
  'load: ' || left(text, 1500) || ' | cleanup: ' || left(source || ': ' || text, 1500) AS paired,
  CASE WHEN length(text) > 1800 THEN left(text, 1800) || ' ...' ELSE text END AS listed
FROM documents"""


def landing_path_check(spark, folder):
    key, user = F.col("event_id"), F.col("user_id")
    config, batch, run = user.cast("string"), F.date_format("ts", "yyyyMMdd"), key.cast("string")
    good = F.concat(
        F.lit("/landing//feed/ingestion_date="), F.date_format("ts", "yyyy-MM-dd"),
        F.lit("/ingestion_config_id="), config, F.lit("/batch_id="), batch,
        F.lit("/pipeline_run_id="), run, F.lit("/"),
    )
    shape = F.pmod(key, F.lit(6))
    path = (
        F.when(shape == 1, F.concat(good, F.lit("part")))
        .when(shape == 2, F.replace(good, F.lit("ingestion_date="), F.lit("day=")))
        .when(shape == 3, F.concat(F.lit("landing/.."), good))
        .when(shape == 4, F.concat(F.lit("batch_id="), batch, F.lit("/pipeline_run_id="), run))
        .when(shape == 5, F.replace(good, F.lit("batch_id="), F.lit("batch_id=0")))
        .otherwise(good)
    )
    return frames.table(spark, folder, "events").select(
        "event_id",
        F.size(text.path_segments(path)).cast("bigint").alias("segments"),
        landing.is_own_leaf(path, config, batch, run).alias("is_leaf"),
        text.as_folder(path).alias("as_folder"),
    )


SQL["landing_path_check"] = """
SELECT event_id, CASE event_id % 6 WHEN 1 THEN 7 WHEN 3 THEN 8 WHEN 4 THEN 2 ELSE 6 END::BIGINT
    AS segments,
  event_id % 6 = 0 AS is_leaf,
  CASE event_id % 6 WHEN 1 THEN good || 'part/' WHEN 2 THEN replace(good, 'ingestion_date=', 'day=')
    WHEN 3 THEN 'landing/..' || good WHEN 4 THEN 'batch_id=' || batch || '/pipeline_run_id='
      || event_id || '/'
    WHEN 5 THEN replace(good, 'batch_id=', 'batch_id=0') ELSE good END AS as_folder
FROM (SELECT event_id, strftime(ts, '%Y%m%d') AS batch,
    '/landing//feed/ingestion_date=' || strftime(ts, '%Y-%m-%d') || '/ingestion_config_id='
    || user_id || '/batch_id=' || strftime(ts, '%Y%m%d') || '/pipeline_run_id=' || event_id || '/'
    AS good FROM events)"""

for _query in (
    content_reconcile, data_drift, schema_drift, contiguity_check, table_profile,
    partition_profile, order_totals, conditional_pivot, positional_join, padded_keys,
    derived_dates, case_buckets, error_text, landing_path_check,
):
    QUERIES[_query.__name__] = _query
