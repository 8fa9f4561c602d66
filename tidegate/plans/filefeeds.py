"""Registered queries over file feeds written from the test tables."""

from __future__ import annotations

import json
import time

from pyspark.sql import functions as F

from tidegate.functions.temporal import utc_text
from tidegate.operators import bronze, landing, reconcile, requests
from tidegate.operators import configs as config_ops
from tidegate.operators.lineage import stamp_file_lineage, stamp_lineage
from tidegate.plans import frames, monitoring
from tidegate.plans.frames_sql import AUDIT, with_tables
from tidegate.plans.ingest import LoadCycle
from tidegate.plans.loading import INSTANT
from tidegate.plans.store import ControlStore
from tidegate.schemas import AUDIT as AUDIT_ROWS
from tidegate.schemas import CONFIG, CONNECTIONS, STATE
from tidegate.session import local_frame, work_folder
from tidegate.sources.files import (
    discover,
    modified_window,
    relative_to,
    rows_in_modified_window,
)
from tidegate.sources.readers import reader_for
from tidegate.streaming import feed, rollup

QUERIES, SQL = {}, {}

OPTIONS = json.loads(frames.FILE_OPTIONS)
AREAS, SLOTS = 3, 12


def _page_feed(spark, folder):
    """Pages as delimited files in nested folders, beside files of another kind.

    The areas are written one after the other, so their files differ in time. The page's
    source goes as base64: a field of a delimited line holds no line ends.
    """
    root = work_folder(spark, "feed")
    pages = frames.table(spark, folder, "pages").select(
        "page_id", "url", F.translate(F.base64(F.encode("html", "UTF-8")), "\r\n", "").alias("html")
    )
    slotted = pages.withColumn("slot", F.col("page_id") % SLOTS)
    for area in range(AREAS):
        writer = slotted.where(F.col("page_id") % AREAS == area).write.partitionBy("slot")
        writer = writer.option("header", "true").option("quote", '"').option("escape", "\\")
        writer.csv(f"{root}/area={area}")
    pages.select(F.to_json(F.struct("*")).alias("value")).write.text(f"{root}/notes")
    return root


def _second_area(spark, root):
    """The window that starts exactly at the second area's first file and ends
    exactly at the third area's first, which is outside."""
    first_file = (
        discover(spark, root, "part-*.csv")
        .groupBy(F.regexp_extract("path", r"area=(\d+)/", 1).alias("area"))
        .agg(utc_text(F.min("modified_time")).alias("bound"))
    )
    bounds = {row.area: row.bound for row in first_file.collect()}
    return bounds["1"], bounds["2"]


def file_discovery(spark, folder):
    """Feed files by area and slot, one area of empty files, and the hidden marker files."""
    root = _page_feed(spark, folder)
    nothing = frames.table(spark, folder, "pages").select("url").where("url IS NULL AND url > ''")
    nothing.coalesce(1).write.csv(f"{root}/area={AREAS}/slot=0")
    found = discover(spark, root, "part-*.csv").unionByName(discover(spark, root, "_SUCC[A-F]S{S,}"))
    part = lambda name: F.regexp_extract("path", rf"{name}=(\d+)/", 1).try_cast("bigint")
    hidden = F.regexp_like("path", F.lit("/_[^/]*$"))
    return found.groupBy(part("area").alias("area"), part("slot").alias("slot"), hidden.alias("hidden")).agg(
        (F.min("length") > 0).alias("has_bytes")
    )


SQL["file_discovery"] = f"""
SELECT DISTINCT page_id % {AREAS} AS area, page_id % {SLOTS} AS slot, false AS hidden, true AS has_bytes
FROM pages
UNION ALL SELECT DISTINCT page_id % {AREAS}, NULL, true, false FROM pages
UNION ALL VALUES ({AREAS}, 0, false, false), ({AREAS}, 0, true, false), (NULL, NULL, true, false)"""


def file_window(spark, folder):
    root = _page_feed(spark, folder)
    rows = reader_for("delimited_text")(spark, root, OPTIONS)
    return rows_in_modified_window(rows, *_second_area(spark, root)).select(
        "page_id", "url", "html"
    )


SQL["file_window"] = f"""
SELECT CAST(page_id AS VARCHAR) AS page_id, url, base64(encode(html)) AS html
FROM pages WHERE page_id % {AREAS} = 1"""


def _customer_files(spark, folder):
    root = work_folder(spark, "customers")
    rows = frames.table(spark, folder, "customer").select(
        "c_custkey",
        F.concat(F.lit('say "hi", '), F.col("c_name")).alias("c_name"),
        "c_nationkey",
        "c_mktsegment",
        F.col("c_mktsegment").alias("segment"),
    )
    writer = rows.write.partitionBy("segment").option("header", "true")
    writer.option("quote", '"').option("escape", "\\").csv(root)
    return root


def delimited_read(spark, folder):
    return reader_for("DELIMITED_TEXT")(spark, _customer_files(spark, folder), OPTIONS)


SQL["delimited_read"] = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, 'say "hi", ' || c_name AS c_name,
  CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer"""


def file_lineage(spark, folder):
    root = _customer_files(spark, folder)
    rows = reader_for("DELIMITED_TEXT")(spark, root, OPTIONS)
    stamped = stamp_lineage(
        stamp_file_lineage(rows, root, "/outbound/feed"), "B1", "R1", INSTANT, with_date=True
    )
    path, name = F.col("_source_file_path"), F.col("_source_file_name")
    return stamped.select(
        "c_custkey",
        "_batch_id",
        "_pipeline_run_id",
        "_ingestion_date",
        F.regexp_replace(path, r"[^/]+$", "").alias("source_folder"),
        (F.substring_index(path, "/", -1) == name).alias("name_matches"),
        F.endswith(name, F.lit(".csv")).alias("is_csv"),
    )


SQL["file_lineage"] = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, 'B1' AS _batch_id, 'R1' AS _pipeline_run_id,
  DATE '2026-01-31' AS _ingestion_date,
  '/outbound/feed/segment=' || c_mktsegment || '/' AS source_folder, true AS name_matches,
  true AS is_csv FROM customer"""


def landing_manifest(spark, folder):
    """Land the files of a window, check them, and read the landed copies."""
    root = _page_feed(spark, folder)
    leaf = landing.landing_leaf(work_folder(spark, "landing"), "2026-01-31", 1, "B1", "R1")
    window = _second_area(spark, root)
    found = modified_window(discover(spark, root, "part-*.csv"), *window)
    manifest = landing.land_files(spark, found, root, leaf).checkpoint()
    gate = landing.landing_gate(manifest, landing.landed_files(spark, leaf)).select(
        F.lit("gate").alias("check_name"),
        ((F.col("outcome") == "PROCESS") & (F.col("bytes_read") == F.col("bytes_written"))).alias(
            "passed"
        ),
        F.lit(None).cast("bigint").alias("row_count"),
    )
    copies = discover(spark, leaf).select(
        relative_to(F.col("path"), leaf).alias("relative_path"), "length"
    )
    differing = reconcile.data_drift(
        manifest.select("relative_path", F.col("written").alias("length")), copies,
        ["relative_path", "length"],
    ).agg(
        F.lit("copies").alias("check_name"),
        (F.count(F.lit(1)) == 0).alias("passed"),
        F.lit(None).cast("bigint").alias("row_count"),
    )
    landed = reader_for("DELIMITED_TEXT")(spark, leaf, OPTIONS).agg(
        F.lit("rows").alias("check_name"),
        (F.count(F.lit(1)) > 0).alias("passed"),
        F.count(F.lit(1)).alias("row_count"),
    )
    return gate.unionByName(differing).unionByName(landed)


SQL["landing_manifest"] = f"""
SELECT 'gate' AS check_name, true AS passed, CAST(NULL AS BIGINT) AS row_count
UNION ALL SELECT 'copies', true, NULL
UNION ALL SELECT 'rows', true, count(*)
FROM pages WHERE page_id % {AREAS} = 1"""


def landing_gate(spark, folder):
    """File counts per run, from the audit facts: equal, none, or one lost."""
    runs = frames.audit(spark, folder).select(
        "pipeline_run_id",
        F.coalesce("source_row_count", F.lit(0)).alias("files_read"),
        F.when(F.col("status") == "FAILED", F.coalesce("source_row_count", F.lit(0)) - 1)
        .otherwise(F.coalesce("source_row_count", F.lit(0)))
        .alias("files_written"),
    )
    return landing.gate_outcome(runs)


SQL["landing_gate"] = with_tables(
    AUDIT,
    body="""
SELECT pipeline_run_id, n AS files_read, n - CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END
    AS files_written,
  CASE WHEN status = 'FAILED' THEN 'FAILED' WHEN n = 0 THEN 'SKIPPED' ELSE 'PROCESS' END AS outcome,
  CASE WHEN status = 'FAILED' THEN 'LANDING_FILE_COUNT_MISMATCH' END AS error_code
FROM (SELECT *, coalesce(source_row_count, 0) AS n FROM audit)""",
)


def landed_gate(spark, folder):
    """The gate over landed areas of the page feed: whole, with a file lost, and without files."""
    root = _page_feed(spark, folder)
    found = discover(spark, root, "part-*.csv")
    outcomes = []
    for area in range(AREAS):
        leaf = landing.landing_leaf(work_folder(spark, "landing"), "2026-01-31", area, "B1", "R1")
        listed = found.where(F.contains("path", F.lit(f"/area={area}/")))
        if area == AREAS - 1:
            listed = listed.where(F.col("length") < 0)
        manifest = landing.land_files(spark, listed, root, leaf).checkpoint()
        if area == 1:
            lost = manifest.agg(F.min("relative_path")).first()[0]
            bronze.remove_folder(spark, f"{leaf}/{lost}")
        gate = landing.landing_gate(manifest, landing.landed_files(spark, leaf))
        outcomes.append(
            gate.select(
                F.lit(area).alias("area"), (F.col("files_read") - F.col("files_written")).alias("lost"),
                "outcome", "error_code",
            )
        )
    return outcomes[0].unionByName(outcomes[1]).unionByName(outcomes[2])


SQL["landed_gate"] = f"""
SELECT area, CAST(area = 1 AS BIGINT) AS lost,
  CASE area WHEN 0 THEN 'PROCESS' WHEN 1 THEN 'FAILED' ELSE 'SKIPPED' END AS outcome,
  CASE area WHEN 1 THEN 'LANDING_FILE_COUNT_MISMATCH' END AS error_code
FROM (SELECT DISTINCT CAST(page_id % {AREAS} AS INTEGER) AS area FROM pages)"""


def stream_file_feed(spark, folder):
    """The page feed taken as a stream, twice: the second run finds nothing new."""
    root, target = _page_feed(spark, folder), work_folder(spark, "streamed")
    checkpoint = work_folder(spark, "stream-state")
    schema = reader_for("DELIMITED_TEXT")(spark, root, OPTIONS).schema
    for _ in range(2):
        feed.load_available_files(
            spark, root, schema, OPTIONS, "/outbound/pages", target, checkpoint, "pages"
        )
    return bronze.read_bronze(spark, target).select(
        "page_id", "url", "html", F.regexp_replace("_source_file_path", r"[^/]+$", "").alias("folder")
    )


SQL["stream_file_feed"] = f"""
SELECT CAST(page_id AS VARCHAR) AS page_id, url, base64(encode(html)) AS html,
  '/outbound/pages/area=' || (page_id % {AREAS}) || '/slot=' || (page_id % {SLOTS}) || '/' AS folder
FROM pages"""


def stream_audit_rollup(spark, folder):
    arrivals, table = work_folder(spark, "arrivals"), work_folder(spark, "hourly")
    facts = frames.audit(spark, folder).select("source_system", "status", "start_time")
    facts.write.parquet(arrivals)
    incoming = spark.readStream.schema(facts.schema).parquet(arrivals)
    rollup.write_updates(incoming, table, work_folder(spark, "stream-state"))
    return rollup.current_counts(spark.read.parquet(table))


SQL["stream_audit_rollup"] = with_tables(
    AUDIT,
    body="""
SELECT date_trunc('hour', start_time) AS hour_start,
  lower(coalesce(nullif(trim(source_system), ''), 'UNKNOWN')) AS source_name,
  count(*) AS object_count,
  CAST(sum(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS failed_count
FROM audit GROUP BY 1, 2""",
)

ARRIVALS = 7


def stream_source_batch(spark, folder):
    """Source × batch figures of audit rows that come in several arrivals, some of them very late.

    Every seventh row of each batch comes last, long after all batches have been seen. An arrival
    is written by all tasks that read it, and the stream is resumed to take it as one micro-batch.
    """
    arrivals, table = work_folder(spark, "arrivals"), work_folder(spark, "batches")
    state = work_folder(spark, "stream-state")
    facts = frames.audit(spark, folder)
    wave = F.coalesce(F.pmod(F.col("ingestion_log_id"), F.lit(ARRIVALS)), F.lit(0))
    for number in range(ARRIVALS):
        facts.where(wave == number).write.mode("append").parquet(arrivals)
        incoming = spark.readStream.schema(facts.schema).parquet(arrivals)
        rollup.write_batches(incoming, table, state, fold_after=3)
    return rollup.current_batches(spark, table)


SQL["stream_source_batch"] = monitoring.SQL["monitor_source_batch"]


def run_all(spark, folder):
    """Eight objects twice: everything loads, then only the full loads repeat."""
    outcome, _ = run_all_twice(spark, folder)
    return outcome


def run_all_twice(spark, folder):
    """The audit of two run-all batches, and the seconds of the second one."""
    root = work_folder(spark, "run-all")
    feed_root = _page_feed(spark, folder)
    store = ControlStore(spark, f"{root}/control")
    # object, source table, strategy, watermark
    tables = [
        ("orders", "orders", "INCREMENTAL", "o_orderdate"),
        ("lines", "lineitem", "INCREMENTAL", "l_shipdate"),
        ("clicks", "events", "INCREMENTAL", "ts"),
        ("orders_again", "orders", "INCREMENTAL", "o_orderdate"),
        ("lines_again", "lineitem", "INCREMENTAL", "l_shipdate"),
        ("customers", "customer", "FULL", None),
    ]
    rows = [
        (n, "SHOP", "db", source, name, None, "DATABASE", None, None, None, None, "lake", "shop",
         name, strategy, watermark, True)
        for n, (name, source, strategy, watermark) in enumerate(tables, start=1)
    ] + [
        (n, "CARRIER", "ftp", None, name, feed_root, "FILE", "DELIMITED_TEXT", frames.FILE_OPTIONS,
         None, f"landing/{name}", "lake", "carrier", name, strategy, watermark, True)
        for n, (name, strategy, watermark) in enumerate(
            [("pages", "FULL", None), ("new_pages", "INCREMENTAL", "last_modified_time")], start=7
        )
    ]
    configs = local_frame(spark, rows, CONFIG)
    connections = local_frame(
        spark, [("db", "SQL_SERVER", "{}"), ("ftp", "SFTP", "{}"), ("lake", "LAKEHOUSE", "{}")],
        CONNECTIONS,
    )
    none = local_frame(spark, [], STATE)
    first = config_ops.missing_state(configs, none).select(
        *[
            F.col(f.name) if f.name in ("ingestion_config_id", "watermark_field",
                                        "last_watermark_value")
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in STATE
        ]
    )
    store.commit(0, local_frame(spark, [], AUDIT_ROWS), first)
    seconds = 0.0
    for batch in ("B1", "B2"):
        cycle = LoadCycle(
            spark, store, configs, connections, f"{root}/lake",
            lambda row: frames.table(spark, folder, row.source_schema), "", batch,
        )
        start = time.perf_counter()
        cycle.run(requests.resolve_scope(configs))
        seconds = time.perf_counter() - start
    audit = store.audit().select(
        "batch_id", "source_object", "status", "error_code", "source_row_count", "target_row_count"
    )
    return audit, seconds


SQL["run_all"] = """
WITH loaded AS (
  SELECT 'orders' AS source_object, true AS moving, count(*) AS n FROM orders
  UNION ALL SELECT 'lines', true, count(*) FROM lineitem
  UNION ALL SELECT 'clicks', true, count(*) FROM events
  UNION ALL SELECT 'orders_again', true, count(*) FROM orders
  UNION ALL SELECT 'lines_again', true, count(*) FROM lineitem
  UNION ALL SELECT 'customers', false, count(*) FROM customer
  UNION ALL SELECT 'pages', false, count(*) FROM pages
  UNION ALL SELECT 'new_pages', true, count(*) FROM pages)
SELECT 'B1' AS batch_id, source_object, 'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS error_code,
  n AS source_row_count, n AS target_row_count FROM loaded
UNION ALL
SELECT 'B2', source_object, CASE WHEN moving THEN 'SKIPPED' ELSE 'SUCCESS' END, NULL,
  CASE WHEN moving THEN 0 ELSE n END, CASE WHEN moving THEN 0 ELSE n END FROM loaded"""

for _query in (
    file_discovery, file_window, delimited_read, file_lineage, landing_manifest, landing_gate,
    landed_gate, stream_file_feed, stream_audit_rollup, stream_source_batch, run_all,
):
    QUERIES[_query.__name__] = _query
