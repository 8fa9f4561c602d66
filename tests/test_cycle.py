"""Whole load cycles, their failures, and the streaming forms."""

import os
import time

import pytest
from pyspark.sql import functions as F

from tidegate.errors import LoadError
from tidegate.functions.text import MESSAGE_LIMIT
from tidegate.operators import bronze, monitor
from tidegate.operators.requests import resolve_scope
from tidegate.plans.filefeeds import OPTIONS
from tidegate.plans.frames import FILE_OPTIONS
from tidegate.plans.ingest import LoadCycle
from tidegate.plans.store import ControlStore
from tidegate.schemas import AUDIT, CONFIG, CONNECTIONS, RUN_REQUEST, STATE
from tidegate.session import local_frame
from tidegate.streaming import feed, rollup


@pytest.fixture
def cycle(spark, folder):
    """Builds cycles over one store; file sources live below ``folder``/in."""
    store = ControlStore(spark, folder + "/control")
    configs = local_frame(
        spark,
        [
            (1, "SHOP", "db", "dbo", "rows", None, "DATABASE", None, None, None, None, "lake",
             "shop", "rows", "INCREMENTAL", "at", True),
            (2, "SHOP", "db", "dbo", "all", None, "DATABASE", None, None, None, None, "lake",
             "shop", "all", "FULL", None, True),
            (3, "CARRIER", "ftp", None, "moves", "/in/moves", "FILE", "DELIMITED_TEXT",
             FILE_OPTIONS.replace("part-", "move_"), None, "landing/moves", "lake", "ship", "moves",
             "INCREMENTAL", "last_modified_time", True),
            (4, "CARRIER", "ftp", None, "odd", "/in/odd", "FILE", "PARQUET", "{}", None, "landing",
             "lake", "ship", "odd", "FULL", None, True),
            (5, "CARRIER", "ftp", None, "idle", "/in/idle", "FILE", "DELIMITED_TEXT", FILE_OPTIONS,
             None, "landing", "lake", "ship", "idle", "FULL", None, False),
        ],
        CONFIG,
    )
    connections = local_frame(
        spark, [("db", "SQL_SERVER", "{}"), ("ftp", "SFTP", "{}"), ("lake", "LAKEHOUSE", "{}")],
        CONNECTIONS,
    )
    first = local_frame(
        spark,
        [(1, "at", "1900-01-01T00:00:00Z", None, None, None),
         (3, "last_modified_time", "1900-01-01T00:00:00Z", None, None, None)],
        STATE,
    )
    store.commit(0, local_frame(spark, [], AUDIT), first)
    source = spark.sql(
        "SELECT id, timestamp_ntz'2026-01-01' + make_interval(0,0,0,CAST(id AS INT)) AS at"
        " FROM range(5)"
    )

    def make(batch, open_table=lambda row: source):
        return LoadCycle(
            spark, store, configs, connections, folder + "/lake", open_table, folder, batch
        )

    return make


def run(spark, cycle, *ids, kind="REGULAR", low="", high=""):
    wanted = local_frame(spark, [(n, kind, low, high) for n in ids], RUN_REQUEST)
    cycle.run(wanted)
    rows = cycle.store.audit().where(f"batch_id = '{cycle.batch_id}'").collect()
    return {r.ingestion_config_id: r for r in rows}


def move_file(folder, name, lines):
    path = f"{folder}/in/moves/2026/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as file:
        file.write("move_id,qty\n" + "".join(f"{line}\n" for line in lines))


def test_a_batch_of_all_kinds(spark, folder, cycle):
    move_file(folder, "move_1.csv", ["m1,5", "m2,6"])
    move_file(folder, "ignored.txt", ["m9,9"])
    time.sleep(0.01)
    made = cycle("B1")
    got = run(spark, made, 1, 2, 3, 4, 5, 99)
    assert {n: (r.status, r.error_code, r.target_row_count) for n, r in got.items()} == {
        1: ("SUCCESS", None, 5),
        2: ("SUCCESS", None, 5),
        3: ("SUCCESS", None, 2),
        4: ("FAILED", "UNSUPPORTED_FILE_FORMAT", 0),
        5: ("SKIPPED", None, 0),
        99: ("FAILED", "CONFIG_NOT_FOUND", 0),
    }
    state = {r.ingestion_config_id: r.last_watermark_value for r in made.store.state().collect()}
    assert state[1] == got[1].processing_upper_bound == "2026-01-05T00:00:00.000000"
    assert state[3] == got[3].processing_upper_bound
    moves = bronze.read_committed(
        bronze.read_bronze(spark, folder + "/lake/ship/moves"), made.store.audit()
    ).collect()
    assert {r._source_file_path for r in moves} == {"/in/moves/2026/move_1.csv"}
    assert got[3].landing_path.endswith(f"pipeline_run_id={got[3].pipeline_run_id}")
    # nothing new: the table is skipped, the feed finds no file, the full load repeats
    again = run(spark, cycle("B2"), 1, 2, 3)
    assert {n: (r.status, r.target_row_count) for n, r in again.items()} == {
        1: ("SKIPPED", 0), 2: ("SUCCESS", 5), 3: ("SKIPPED", 0),
    }
    after = {r.ingestion_config_id: r.last_watermark_value for r in made.store.state().collect()}
    assert after == state
    assert bronze.read_bronze(spark, folder + "/lake/shop/all").count() == 10


def test_backfill_appends_without_advancing(spark, folder, cycle):
    made = cycle("B1")
    got = run(spark, made, 1, kind="BACKFILL", low="2026-01-01T00:00:00", high="2026-01-03")
    assert (got[1].status, got[1].target_row_count) == ("SUCCESS", 2)
    assert made.store.state().where("ingestion_config_id = 1").first().last_watermark_value == (
        "1900-01-01T00:00:00Z"
    )


def test_scope_feeds_a_cycle(spark, cycle):
    made = cycle("B1")
    made.run(resolve_scope(made.configs, "shop"))
    assert sorted(r.ingestion_config_id for r in made.store.audit().collect()) == [1, 2]


def test_failed_load_leaves_an_audit_and_no_rows(spark, folder, cycle):
    bad = spark.range(3).selectExpr("id", "assert_true(id < 2, 'broken row') AS x")
    got = run(spark, cycle("B1", lambda row: bad), 2)
    assert (got[2].status, got[2].error_code) == ("FAILED", "LOAD_FAILED")
    assert "broken row" in got[2].error_message and len(got[2].error_message) <= MESSAGE_LIMIT
    assert not bronze.path_exists(
        spark, bronze.execution_folder(spark, folder + "/lake/shop/all", "B1",
                                       got[2].pipeline_run_id)
    )


def test_mixed_headers_are_named_in_the_audit(spark, folder, cycle):
    move_file(folder, "move_1.csv", ["m1,5"])
    with open(f"{folder}/in/moves/2026/move_2.csv", "w") as file:
        file.write("qty,move_id\n7,m7\n")
    got = run(spark, cycle("B1"), 3)
    assert (got[3].status, got[3].error_code) == ("FAILED", "HEADER_MISMATCH")


def test_the_later_of_two_cycles_loses_its_rows(spark, folder, cycle):
    """A second cycle loads and publishes between the first one's load and its end."""
    move_file(folder, "move_1.csv", ["m1,5"])
    first, second = cycle("B1"), cycle("B2")
    publish = first._publish

    def overtaken(facts):
        assert {r.status for r in run(spark, second, 1, 3).values()} == {"SUCCESS"}
        return publish(facts)

    first._publish = overtaken
    rows = run(spark, first, 1, 2, 3)
    assert {n: (r.status, r.error_code) for n, r in rows.items()} == {
        1: ("FAILED", "WATERMARK_CONFLICT"),
        2: ("SUCCESS", None),
        3: ("FAILED", "WATERMARK_CONFLICT"),
    }
    for number in (1, 3):
        row = rows[number]
        table = f"{folder}/lake/{row.target_schema}/{row.target_table}"
        left = bronze.read_bronze(spark, table).select("_batch_id").distinct().collect()
        assert [r[0] for r in left] == ["B2"]
        assert not row.landing_path or not os.path.exists(row.landing_path)


def test_a_version_taken_meanwhile_is_judged_again(spark, cycle):
    first, second = cycle("B1"), cycle("B2")
    commit, taken = first.store.commit, []

    def overtaken(base, audit_rows, state):
        if not taken:
            taken.append(base)
            run(spark, second, 2)
        return commit(base, audit_rows, state)

    first.store.commit = overtaken
    assert run(spark, first, 2)[2].status == "SUCCESS"
    assert first.store.version() == 3 and first.store.audit().count() == 2


def test_one_broken_source_does_not_stop_the_others(spark, cycle):
    good = spark.sql("SELECT 1 AS id, timestamp_ntz'2026-01-01' AS at")

    def open_table(row):
        if row.source_object == "rows":
            raise OSError("source is down")
        return good

    got = run(spark, cycle("B1", open_table), 1, 2)
    assert (got[1].status, got[1].error_code) == ("FAILED", "SOURCE_QUERY_FAILED")
    assert "source is down" in got[1].error_message
    assert got[2].status == "SUCCESS"


def test_run_scope(spark, cycle):
    made = cycle("B1")
    for text, code in (("{}", "51010"), ('[{"config_id":1}]', "51012")):
        with pytest.raises(LoadError) as caught:
            made.run_scope(text)
        assert caught.value.code == code
    with pytest.raises(LoadError) as caught:
        made.run_scope('[{"config_id":1,"run_type":"REGULAR"}]', "SHOP")
    assert caught.value.code == "AMBIGUOUS_RUN_SCOPE"
    with pytest.raises(LoadError):
        made.run_scope(page_size=0)
    assert made.store.audit().count() == 0
    made.run_scope(source_system="SHOP", page_size=1)
    assert made.store.version() == 3  # the first state and one version per page
    assert {r.status for r in made.store.audit().collect()} == {"SUCCESS"}


def test_recovery_removes_only_confirmed_conflicts(spark, folder, cycle):
    made = cycle("B1")
    run(spark, made, 2)
    done = made.store.audit().first()
    lost = {**done.asDict(), "pipeline_run_id": "lost", "status": "FAILED",
            "error_code": "WATERMARK_CONFLICT"}
    made.store.commit(made.store.version(), local_frame(spark, [lost], AUDIT), made.store.state())
    table = folder + "/lake/shop/all"
    rows = bronze.read_bronze(spark, table).drop("_pipeline_run_id")
    for name in ("lost", "unknown"):
        bronze.append_execution(rows.selectExpr("*", f"'{name}' AS _pipeline_run_id"), table)
    uncertain = spark.createDataFrame(
        [(2, "B1", name, "DATABASE", "shop", "all", None)
         for name in (done.pipeline_run_id, "lost", "unknown")],
        "ingestion_config_id int, batch_id string, pipeline_run_id string,"
        " ingestion_pattern string, target_schema string, target_table string,"
        " landing_path string",
    )
    got = {r.pipeline_run_id: r.final_error for r in made.recover(uncertain).collect()}
    assert got == {
        done.pipeline_run_id: "FINALIZE_RESPONSE_FAILED_COMMITTED",
        "lost": "WATERMARK_CONFLICT",
        "unknown": "FINALIZE_OUTCOME_UNCONFIRMED",
    }
    left = bronze.read_bronze(spark, table).select("_pipeline_run_id").distinct().collect()
    assert {r[0] for r in left} == {done.pipeline_run_id, "unknown"}


def test_committed_read_prunes_by_the_audit(spark, folder, cycle, plan):
    made = cycle("B1")
    run(spark, made, 2)
    rows = bronze.read_committed(
        bronze.read_bronze(spark, folder + "/lake/shop/all"), made.store.audit()
    )
    assert "dynamicpruning" in plan(rows) and rows.count() == 5


def test_stream_takes_each_file_once(spark, folder):
    move_file(folder, "move_1.csv", ["m1,5"])
    options = {**OPTIONS, "file_name_pattern": "move_*.csv"}

    def load():
        feed.load_available_files(
            spark, folder + "/in", rows.schema, options, "/out", folder + "/t", folder + "/c", "f"
        )

    rows = spark.createDataFrame([], "move_id string, qty string")
    load()
    load()
    move_file(folder, "move_2.csv", ["m2,6", "m3,7"])
    load()
    got = bronze.read_bronze(spark, folder + "/t").collect()
    assert sorted((r.move_id, r._batch_id) for r in got) == [
        ("m1", "f-0"), ("m2", "f-1"), ("m3", "f-1"),
    ]


def test_hourly_counts_over_two_arrivals(spark, folder):
    schema = "source_system string, status string, start_time timestamp_ntz"
    arrivals = folder + "/arrivals"

    def arrive(*rows):
        made = spark.createDataFrame(list(rows), "a string, b string, c string")
        made.selectExpr(
            "a AS source_system", "b AS status", "CAST(c AS timestamp_ntz) AS start_time"
        ).write.mode("append").parquet(arrivals)
        incoming = spark.readStream.schema(schema).parquet(arrivals)
        rollup.write_updates(incoming, folder + "/t", folder + "/c")

    arrive(("S", "FAILED", "2026-01-01 10:05:00"), ("s ", "SUCCESS", "2026-01-01 10:59:00"))
    arrive(("S", "SUCCESS", "2026-01-01 10:30:00"), (None, "SUCCESS", "2026-01-01 11:00:00"))
    arrive(("S", "SUCCESS", "2026-01-02 10:00:00"))
    arrive(("S", "FAILED", "2026-01-01 11:30:00"))  # a day late
    got = rollup.current_counts(spark.read.parquet(folder + "/t")).orderBy("hour_start", "source_name").collect()
    assert [(r.source_name, r.object_count, r.failed_count) for r in got] == [
        ("s", 3, 1), ("s", 1, 1), ("unknown", 1, 0), ("s", 1, 0),
    ]


def test_a_config_requested_twice_is_refused(spark, cycle):
    made = cycle("B1")
    with pytest.raises(LoadError) as caught:
        run(spark, made, 1, 1)
    assert caught.value.code == "51013" and made.store.audit().count() == 0


def test_a_missing_source_connection_is_named(spark, cycle):
    made = cycle("B1")
    made.connections = made.connections.where("connection_ref <> 'db'")
    got = run(spark, made, 2)
    assert (got[2].status, got[2].error_code) == ("FAILED", "CONNECTION_NOT_FOUND")


def test_a_failed_load_does_not_fix_the_types_of_its_table(spark, folder, cycle):
    bad = spark.range(3).selectExpr("'text' AS id", "assert_true(id < 2, 'broken row') AS x")
    assert run(spark, cycle("B1", lambda row: bad), 2)[2].status == "FAILED"
    assert run(spark, cycle("B2"), 2)[2].status == "SUCCESS"


def test_the_stored_audit_feeds_the_monitors(spark, cycle):
    made = cycle("B1")
    run(spark, made, 1, 2)
    run(spark, cycle("B2"), 2)
    ids = [r.ingestion_log_id for r in made.store.audit().orderBy("log_timestamp", "end_time").collect()]
    assert ids == [1, 2, 3]
    assert [r.batch_id for r in monitor.recent_audits(made.store.audit(), 1).collect()] == ["B2"]
    assert [r.is_linked for r in monitor.watermark_chain(made.store.audit()).collect()] == [True]
    monitor.register_views(made.store.audit(), made.configs, made.store.state())
    counts = [spark.table(f"v_{name}").count() for name in (
        "monitor_source_batch", "monitor_latest_source", "monitor_object_history",
        "pipeline_watermarks")]
    assert counts == [2, 1, 3, 2]


def test_an_object_is_timed_on_its_own(spark, cycle):
    made = cycle("B1", lambda row: spark.range(1).selectExpr(
        "id", "java_method('java.lang.Thread', 'sleep', 2000L) AS x"))
    made.objects_at_once = 1
    finish, order = made._finish, []
    made._finish = lambda *plan: order.append(time.time()) or finish(*plan)
    rows = run(spark, made, 2, 4)
    assert rows[4].duration_seconds <= 1 and len(order) == 2


def test_live_batches_take_late_rows_and_keep_few_files(spark, folder):
    from tidegate.operators import monitor

    schema = "source_system string, batch_id string, status string, source_row_count long, target_row_count long, start_time timestamp_ntz, end_time timestamp_ntz"
    rows = spark.range(240).selectExpr(
        "concat(if(id % 2 = 0, 'Shop', ' shop '), id % 3) AS source_system", "concat('B', id % 20) AS batch_id",
        "if(id % 17 = 0, 'FAILED', if(id % 5 = 0, 'SKIPPED', 'SUCCESS')) AS status", "id AS source_row_count",
        "if(id % 4 = 0, null, id) AS target_row_count",
        "timestamp_ntz '2026-01-01' + make_interval(0, 0, 0, 0, id) AS start_time",
        "timestamp_ntz '2026-01-02' + make_interval(0, 0, 0, 0, id) AS end_time",
    )
    seen = None
    for arrival in range(8):  # the first batch's last rows come at the very end
        part = rows.where(F.col("batch_id") == "B0") if arrival == 7 else rows.where(
            (F.col("batch_id") != "B0") & (F.col("source_row_count") % 7 == arrival))
        part.coalesce(1).write.mode("append").parquet(folder + "/in")
        incoming = spark.readStream.schema(schema).parquet(folder + "/in")
        rollup.write_batches(incoming, folder + "/t", folder + "/c", fold_after=3)
        seen = part if seen is None else seen.unionByName(part)
        names = monitor.SUMMARY
        got = rollup.current_batches(spark, folder + "/t").select(*names)
        expected = monitor.source_batch(seen).select(*names)
        assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
        assert len(os.listdir(folder + "/t")) <= 4


def test_arrivals_are_written_and_taken_by_many_tasks(spark, folder, monkeypatch):
    from tidegate.plans import filefeeds

    spark.range(0, 700, 1, 4).selectExpr(
        "nullif(id, 13) AS event_id", "timestamp_ntz '2026-01-01' + make_interval(0, 0, 0, 0, id % 9) AS ts",
        "id % 10 AS user_id", "if(id % 6 = 0, 'error', 'click') AS event_type", "CAST(id % 50 AS double) AS value",
        "concat('{\"k\": ', id % 30, '}') AS props",
    ).write.parquet(folder + "/events.parquet")
    monkeypatch.setattr(filefeeds, "work_folder", lambda spark, label: f"{folder}/{label}")
    wide = {"spark.sql.files.openCostInBytes": "128m", "spark.sql.shuffle.partitions": "40"}  # a task per file
    before = {name: spark.conf.get(name) for name in wide}
    for name, value in wide.items():
        spark.conf.set(name, value)
    try:
        got = filefeeds.stream_source_batch(spark, folder).select(*monitor.SUMMARY).collect()
    finally:
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
        for name, value in before.items():
            spark.conf.set(name, value)
    expected = monitor.source_batch(filefeeds.frames.audit(spark, folder)).select(*monitor.SUMMARY).collect()
    assert sorted(map(str, got)) == sorted(map(str, expected)) and sum(r.object_count for r in got) == 700
    files = [name for name in os.listdir(folder + "/arrivals") if name.endswith(".parquet")]
    assert len(files) == 4 * filefeeds.ARRIVALS
    taken = [name for name in os.listdir(folder + "/stream-state/commits") if name.isdigit()]
    assert len(taken) == filefeeds.ARRIVALS
    kept = [name for name in os.listdir(folder + "/stream-state/state/0") if name.isdigit()]
    assert len(kept) == min(40, spark.sparkContext.defaultParallelism)
