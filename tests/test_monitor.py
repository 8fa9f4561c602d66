"""Monitoring views."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidegate.functions.text import source_entity, source_name
from tidegate.operators import monitor

AUDIT = (
    "ingestion_log_id bigint, source_system string, batch_id string, status string,"
    " source_row_count bigint, target_row_count bigint, start_time timestamp_ntz,"
    " end_time timestamp_ntz"
)
T0 = datetime(2026, 1, 1)


def fact(n, source, batch, status, minute, rows=None):
    return (n, source, batch, status, rows, rows, T0, T0 + timedelta(minutes=minute))


def test_latest_batches(frame):
    """Two sources; the older batch's failures do not count as the latest."""
    rows = [fact(0, "SHOP", "A", "FAILED", 1)]
    rows += [fact(1, "SHOP", "B", "SUCCESS", 5, 32)]
    rows += [fact(n, "shop ", "B", "SKIPPED", 4) for n in range(2, 7)]
    rows += [fact(7, "CARRIER", "C", "SUCCESS", 2), fact(8, " CARRIER", "C", "SKIPPED", 3)]
    latest = monitor.latest_source(frame(AUDIT, *rows)).orderBy("source_system").collect()
    carrier, shop = latest
    assert (carrier.object_count, carrier.success_count, carrier.skipped_count) == (2, 1, 1)
    assert (shop.source_system, shop.batch_id, shop.object_count) == ("SHOP", "B", 6)
    assert (shop.success_count, shop.skipped_count, shop.source_rows) == (1, 5, 32)
    assert shop.source_status == "SUCCESS"
    figures = monitor.kpis(monitor.latest_source(frame(AUDIT, *rows))).first()
    assert (figures.source_systems, figures.failed_sources, figures.objects) == (2, 0, 8)


def test_kpis_of_nothing(frame):
    row = monitor.kpis(monitor.latest_source(frame(AUDIT))).first()
    assert tuple(row) == (0, 0, 0, None, 0, 0, 0)


def test_equal_end_times_go_to_the_later_batch(frame):
    rows = [fact(n, "S", batch, "SUCCESS", 3) for n, batch in enumerate(["B2", "B10", "B1"])]
    assert monitor.latest_source(frame(AUDIT, *rows)).first().batch_id == "B2"


def test_status_precedence(frame):
    order = ["SKIPPED", "SUCCESS", "WARN", "CANCELLED", "FAILED"]
    rows = [
        fact(10 * top + n, "S", f"B{top}", status, 1)
        for top in range(5)
        for n, status in enumerate(order[: top + 1])
    ]
    got = monitor.source_batch(frame(AUDIT, *rows)).orderBy("batch_id").collect()
    assert [r.source_status for r in got] == order
    # warnings and cancellations count as objects only
    assert (got[4].object_count, got[4].success_count + got[4].failed_count
            + got[4].skipped_count) == (5, 3)


def test_names(frame):
    rows = frame(
        "s string, o string", (None, "t"), ("", "t"), ("  ", "t"), ("dbo", "t"), ("dbo", None)
    )
    got = rows.select(source_entity(F.col("s"), F.col("o")), source_name(F.col("s"))).collect()
    assert [r[0] for r in got] == ["t", "t", "t", "dbo.t", "dbo."]
    assert [r[1] for r in got] == ["UNKNOWN", "UNKNOWN", "UNKNOWN", "dbo", "dbo"]


def test_selection_filters_all_history(frame):
    history = frame("source_system string, n int", ("SHOP", 1), ("shop", 2), ("OTHER", 3))
    chosen = frame("source_system string", ("Shop",), (None,))
    assert sorted(r.n for r in monitor.history_of(history, chosen).collect()) == [1, 2]


def test_previous_value_with_a_dominant_key(frame):
    """One key holds most rows and many spans stay empty; brute force agrees."""
    rng = random.Random(5)
    rows = [
        (rng.choice([1, 1, 1, 1, 2, 3]), order, rng.choice([None, "a", "b", "c"]))
        for order in sorted(rng.sample(range(10_000), 300))
    ]
    df = frame("k int, o bigint, v string", *rows)
    got = {
        (r.k, r.o): r.before
        for r in monitor.previous_in_order(df, "k", "o", "v", "before", span=37).collect()
    }
    last, expected = {}, {}
    for key, order, value in rows:
        expected[key, order] = last.get(key)
        last[key] = value
    assert got == expected


def test_chain(frame):
    rows = [
        (1, 1, "SUCCESS", "REGULAR", "INCREMENTAL", "a", "b"),
        (2, 1, "SUCCESS", "BACKFILL", "INCREMENTAL", "x", "y"),
        (3, 1, "SKIPPED", "REGULAR", "INCREMENTAL", "b", "b"),
        (4, 1, "SUCCESS", "REGULAR", "INCREMENTAL", "b", "c"),
        (5, 1, "SUCCESS", "REGULAR", "INCREMENTAL", "d", "e"),
        (6, 2, "SUCCESS", "REGULAR", "INCREMENTAL", "q", "r"),
    ]
    audit = frame(
        "ingestion_log_id bigint, ingestion_config_id int, status string, run_type string,"
        " load_strategy string, processing_lower_bound string, processing_upper_bound string",
        *rows,
    )
    got = monitor.watermark_chain(audit, span=2).orderBy("ingestion_log_id").collect()
    assert [(r.ingestion_log_id, r.is_linked) for r in got] == [
        (1, True), (4, True), (5, False), (6, True),
    ]


def test_batch_sums_combine_before_their_only_shuffle(frame, plan):
    text = plan(monitor.source_batch(frame(AUDIT, fact(1, "S", "B", "SUCCESS", 1))))
    assert "SortAggregate" not in text and "Python" not in text
    assert text.count("Exchange hashpartitioning") == 1


def test_latest_batches_read_the_audit_once(spark, frame, folder, plan):
    """Plans alike for queries and views; brute force agrees over many spellings."""
    rng = random.Random(3)
    rows = [
        fact(n, rng.choice(["S", "s ", " T", "t", None, ""]), f"B{rng.randrange(6)}",
             rng.choice(["SUCCESS", "FAILED"]), rng.randrange(5), 1)
        for n in range(80)
    ]
    frame(AUDIT, *rows).write.parquet(folder + "/a")
    latest = monitor.latest_source(spark.read.parquet(folder + "/a"))
    assert plan(latest).count("FileScan") == 1
    by_name = {}
    for _, source, batch, status, count, _, _, end in rows:
        name = (source or "").strip() or "UNKNOWN"
        by_name.setdefault(name.lower(), []).append((end, batch, name, status))
    expected = set()
    for found in by_name.values():
        ends = {}
        for end, batch, *_ in found:
            ends[batch] = max(end, ends.get(batch, end))
        last = max(ends, key=lambda b: (ends[b], b))
        own = [f for f in found if f[1] == last]
        failed = sum(f[3] == "FAILED" for f in own)
        expected.add((min(f[2] for f in found), last, len(own), failed, ends[last]))
    got = {(r.source_system, r.batch_id, r.object_count, r.failed_count, r.batch_end_time)
           for r in latest.collect()}
    assert got == expected


def test_report_views_follow_the_table(spark, frame, folder):
    path = folder + "/audit"
    names = [f.split()[0] for f in AUDIT.split(", ")]
    more = (
        "*, 1 AS ingestion_config_id, 'R' AS pipeline_run_id, 'dbo' AS source_schema,"
        " 't' AS source_object, 'REGULAR' AS run_type, 'FULL' AS load_strategy,"
        " 1L AS duration_seconds, '' AS error_code, '' AS error_message"
    )
    spark.sql(f"CREATE TABLE audit_rows USING parquet LOCATION '{path}' AS SELECT {more} FROM"
              " (SELECT * FROM {df})", df=frame(AUDIT, fact(1, "S", "A", "SUCCESS", 1)))
    configs = frame(
        "ingestion_config_id int, source_system string, source_schema string,"
        " source_object string, load_strategy string"
    )
    state = frame("ingestion_config_id int, watermark_field string, last_watermark_value string")
    monitor.register_views(spark.table("audit_rows"), configs, state)
    latest = lambda: [(r.batch_id, r.source_status) for r in
                      spark.table("v_monitor_latest_source").collect()]
    assert latest() == [("A", "SUCCESS")]
    frame(AUDIT, fact(2, "s", "B", "FAILED", 9)).selectExpr(*more.split(", ")).write.insertInto(
        "audit_rows"
    )
    assert latest() == [("B", "FAILED")]
    assert spark.table("v_monitor_object_history").count() == 2
    assert spark.table("v_pipeline_watermarks").count() == 0
    assert names[0] == "ingestion_log_id"
    spark.sql("DROP TABLE audit_rows")
