"""Appends, execution-scoped deletes, committed reads and landing."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tidegate.errors import LoadError
from tidegate.operators import bronze, landing
from tidegate.operators.routing import check_file_options
from tidegate.operators.lineage import stamp_file_lineage, stamp_lineage
from tidegate.sources.files import discover
from tidegate.sources.readers import (
    EXTENDED_READERS, is_header_mismatch, named_read_failure, read_delimited, reader_for,
)

NOW = "2026-03-01T23:59:59.999Z"
OPTIONS = {"delimiter": ",", "has_header": True, "encoding": "UTF-8", "quote": '"', "escape": "\\"}


def load(spark, table, batch, run, rows, extra=None):
    df = spark.range(rows)
    if extra:
        df = df.withColumn(extra, F.lit("x"))
    return bronze.append_execution(stamp_lineage(df, batch, run, NOW), table)


def runs(spark, table):
    counts = bronze.read_bronze(spark, table).groupBy("_batch_id", "_pipeline_run_id").count()
    return {(r[0], r[1]): r[2] for r in counts.collect()}


def test_ids_stay_text_and_counts_are_observed(spark, folder):
    table = folder + "/t"
    assert load(spark, table, "0012", "1e5", 7) == 7
    assert load(spark, table, "0012", "2", 0) == 0
    assert runs(spark, table) == {("0012", "1e5"): 7}


def test_new_columns_are_merged(spark, folder):
    table = folder + "/t"
    load(spark, table, "B", "1", 2)
    load(spark, table, "B", "2", 3, extra="note")
    merged = bronze.read_bronze(spark, table)
    assert merged.where("note IS NULL").count() == 2 and merged.count() == 5


def test_incompatible_types_are_refused_before_the_write(spark, folder):
    table = folder + "/t"
    load(spark, table, "B", "1", 2)
    text = spark.range(2).select(F.col("id").cast("string"))
    with pytest.raises(LoadError) as caught:
        bronze.append_execution(stamp_lineage(text, "B", "2", NOW), table)
    assert caught.value.code == "INCOMPATIBLE_SCHEMA"
    assert runs(spark, table) == {("B", "1"): 2}


def test_missing_values_and_case_make_no_new_column(spark, folder):
    table = folder + "/t"
    for run, text in (("1", "array(1) AS Items"), ("2", "array(2, NULL) AS items")):
        df = spark.range(1).selectExpr("id", text)
        bronze.append_execution(stamp_lineage(df, "B", run, NOW), table)
    got = bronze.read_bronze(spark, table).orderBy("_pipeline_run_id").collect()
    assert [r[1] for r in got] == [[1], [2, None]]


def test_reading_opens_no_footers(spark, folder):
    table = folder + "/t"
    load(spark, table, "B", "1", 2)
    leaf = bronze.execution_folder(spark, table, "B", "1")
    names = [n for n in os.listdir(leaf) if n.endswith(".parquet")]
    with open(f"{leaf}/{names[0]}", "wb") as file:
        file.write(b"not parquet")
    assert bronze.read_bronze(spark, table).columns == [
        "id", "_ingestion_timestamp", "_batch_id", "_pipeline_run_id",
    ]


def test_tables_written_by_other_means_are_merged(spark, folder):
    table = folder + "/t"
    for run, df in (("1", spark.range(2)), ("2", spark.range(3).withColumn("x", F.lit("é")))):
        df.write.parquet(f"{table}/_batch_id=007/_pipeline_run_id={run}")
    assert runs(spark, table) == {("007", "1"): 2, ("007", "2"): 3}
    with pytest.raises(Exception, match="CANNOT_MERGE_SCHEMAS"):
        spark.range(1).selectExpr("CAST(id AS string) AS id").write.parquet(
            f"{table}/_batch_id=007/_pipeline_run_id=3"
        )
        bronze.read_bronze(spark, table)


def test_delete_touches_one_execution_and_can_be_repeated(spark, folder):
    table = folder + "/t"
    load(spark, table, "B:1", "run a", 3)
    load(spark, table, "B:1", "run b", 4)
    load(spark, table, "B:2", "run a", 5)
    assert bronze.delete_execution(spark, table, "B:1", "run a") == 3
    assert runs(spark, table) == {("B:1", "run b"): 4, ("B:2", "run a"): 5}
    assert bronze.delete_execution(spark, table, "B:1", "run a") == 0
    assert bronze.delete_execution(spark, folder + "/absent", "B", "r") == 0


@pytest.mark.parametrize("bad", ["", "  ", None, ".", "..", "a/b", "a\\b"])
def test_unsafe_ids_are_refused(spark, folder, bad):
    with pytest.raises(ValueError):
        bronze.delete_execution(spark, folder, bad, "r")
    with pytest.raises(ValueError):
        bronze.delete_execution(spark, folder, "b", bad)


def test_rows_without_success_audit_stay_invisible(spark, folder, frame):
    table = folder + "/t"
    load(spark, table, "B", "good", 3)
    load(spark, table, "B", "lost", 4)
    audit = frame(
        "batch_id string, pipeline_run_id string, status string",
        ("B", "good", "SUCCESS"), ("C", "lost", "SUCCESS"), ("B", "lost", "FAILED"),
    )
    rows = bronze.read_bronze(spark, table)
    assert bronze.read_committed(rows, audit).count() == 3
    orphans = bronze.orphan_executions(rows, audit).collect()
    assert [tuple(r) for r in orphans] == [("B", "lost", 4)]


def test_execution_filter_reads_one_folder(spark, folder, plan):
    table = folder + "/t"
    load(spark, table, "B", "1", 3)
    load(spark, table, "B", "2", 3)
    one = bronze.read_bronze(spark, table).where("_batch_id = 'B' AND _pipeline_run_id = '1'")
    assert "PartitionFilters: [isnotnull(_batch_id" in plan(one)
    assert one.count() == 3 and len(one.inputFiles()) > 0


def test_one_instant_per_execution(spark):
    rows = stamp_lineage(spark.range(3), "B", "R", NOW, with_date=True)
    assert rows.select("_ingestion_timestamp").distinct().count() == 1
    row = rows.first()
    assert str(row._ingestion_date) == "2026-03-01"
    assert row._ingestion_timestamp.isoformat() == "2026-03-01T23:59:59.999000"


# --- files -------------------------------------------------------------------


def write(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as file:
        file.write("\n".join(lines) + "\n")


def test_delimited_text(spark, folder):
    write(folder + "/in/2026/a.csv", "id,note", '007,"say \\"hi\\", x"', "2,")
    rows = read_delimited(spark, folder + "/in", OPTIONS).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("007", 'say "hi", x'), ("2", None)]
    bare = read_delimited(spark, folder + "/in", {**OPTIONS, "has_header": False})
    assert bare.columns == ["_c0", "_c1"] and bare.count() == 3


def test_files_with_other_headers_stop_the_read(spark, folder):
    write(folder + "/in/a.csv", "id,note", "1,x")
    write(folder + "/in/b.csv", "note,id", "y,2")
    with pytest.raises(Exception) as caught:
        read_delimited(spark, folder + "/in", OPTIONS).collect()
    assert is_header_mismatch(caught.value)


@pytest.mark.parametrize(
    "change",
    [{"delimiter": ""}, {"delimiter": None}, {"has_header": "true"}, {"encoding": " "},
     {"quote": "''"}, {"escape": ""}, {"quote": None}],
)
def test_every_reader_option_is_required(spark, folder, change):
    with pytest.raises(ValueError):
        read_delimited(spark, folder, {**OPTIONS, **change})


def test_reader_registry(spark, folder):
    assert reader_for(" delimited_text ") is read_delimited
    for name in ("PARQUET", "json", "", None):
        with pytest.raises(LoadError) as caught:
            reader_for(name)
        assert caught.value.code == "UNSUPPORTED_FILE_FORMAT"
    spark.range(3).write.parquet(folder + "/p")
    spark.range(3).write.json(folder + "/j")
    assert reader_for("PARQUET", EXTENDED_READERS)(spark, folder + "/p", {}).count() == 3
    rows = reader_for("JSON", EXTENDED_READERS)(spark, folder + "/j", {})
    assert rows.dtypes == [("id", "string")]


def test_options_must_be_an_object(frame):
    texts = [None, "", "[]", "{", '"x"', '{"quote":5,"has_header":true,"more":"y"}']
    rows = check_file_options(
        frame("ingestion_pattern string, source_options string", *[("FILE", t) for t in texts])
    ).collect()
    assert [r.file_option_error for r in rows] == ["INVALID_SOURCE_OPTIONS"] * 5 + [None]
    assert rows[5].file_options.quote is None and rows[5].file_options.has_header is True
    assert rows[5].file_members["more"] == "y"


@pytest.mark.parametrize("line", ["3,4,5", "3"])
def test_malformed_lines_stop_the_read(spark, folder, line):
    write(folder + "/in/a.csv", "a,b", "1,2", line)
    with pytest.raises(Exception) as caught:
        read_delimited(spark, folder + "/in", OPTIONS).collect()
    assert named_read_failure(caught.value).code == "MALFORMED_ROWS"


def test_parquet_files_of_different_columns_are_merged(spark, folder):
    spark.sql("SELECT 1 AS a").write.parquet(folder + "/p/x")
    spark.sql("SELECT 2 AS b").write.parquet(folder + "/p/y")
    rows = reader_for("PARQUET", EXTENDED_READERS)(spark, folder + "/p", {})
    assert sorted(rows.columns) == ["a", "b"] and rows.count() == 2


def test_file_lineage_names_the_source(spark, folder):
    root = folder + "/landing/leaf"
    write(root + "/2026/10/move+ment 1.csv", "id", "1")
    rows = read_delimited(spark, root, OPTIONS)
    row = stamp_file_lineage(rows, root, "/outbound/moves").first()
    assert row._source_file_path == "/outbound/moves/2026/10/move+ment 1.csv"
    assert row._source_file_name == "move+ment 1.csv"


def test_landing_copies_bytes_and_hierarchy(spark, folder):
    source = folder + "/outbound"
    contents = {"a.csv": b"x" * 10, "deep/er/b 1%.csv": bytes(range(256)) * 100, "empty.csv": b""}
    for name, data in contents.items():
        os.makedirs(os.path.dirname(f"{source}/{name}"), exist_ok=True)
        with open(f"{source}/{name}", "wb") as file:
            file.write(data)
    leaf = landing.landing_leaf(folder + "/land", "2026-01-01", 7, "B", "R")
    found = discover(spark, source, "*.csv")
    manifest = landing.land_files(spark, found, source, leaf).checkpoint()
    rows = {r.relative_path: r for r in manifest.collect()}
    assert set(rows) == set(contents)
    for name, data in contents.items():
        with open(f"{leaf}/{name}", "rb") as file:
            assert file.read() == data
        assert rows[name].sha256 == hashlib.sha256(data).hexdigest()
        assert rows[name].written == rows[name].length == len(data)
    gate = lambda: landing.landing_gate(manifest, landing.landed_files(spark, leaf)).first()
    assert (gate().outcome, gate().error_code, gate().files_read) == ("PROCESS", None, 3)
    with open(f"{leaf}/a.csv", "wb") as file:  # cut short after the copy
        file.write(b"x")
    assert gate().outcome == "FAILED"
    os.remove(f"{leaf}/a.csv")
    assert (gate().outcome, gate().files_written) == ("FAILED", 2)


def test_gate_tests_counts_before_no_data(frame):
    rows = frame("files_read bigint, files_written bigint", (0, 0), (2, 1), (0, 1), (3, 3))
    got = [(r.outcome, r.error_code) for r in landing.gate_outcome(rows).collect()]
    mismatch = ("FAILED", "LANDING_FILE_COUNT_MISMATCH")
    assert got == [("SKIPPED", None), mismatch, mismatch, ("PROCESS", None)]


def test_landing_delete_accepts_only_the_exact_leaf(spark, folder):
    leaf = landing.landing_leaf(folder + "/land/feed", "2026-01-01", 7, "B", "R")
    other = landing.landing_leaf(folder + "/land/feed", "2026-01-01", 7, "B", "R2")
    write(leaf + "/a.csv", "x")
    write(other + "/a.csv", "x")
    for path in (leaf + "/x", os.path.dirname(leaf), "", "/", folder,
                 leaf.replace("ingestion_date=", "day="), leaf.replace("feed", "..")):
        with pytest.raises(ValueError):
            landing.delete_landing(spark, path, 7, "B", "R")
    with pytest.raises(ValueError):
        landing.delete_landing(spark, leaf, 8, "B", "R")
    assert os.path.exists(leaf)
    landing.delete_landing(spark, leaf + "/", 7, "B", "R")
    landing.delete_landing(spark, leaf, 7, "B", "R")
    assert not os.path.exists(leaf) and os.path.exists(other)


def test_committed_read_does_not_shuffle_rows(spark, folder, plan):
    table = folder + "/t"
    for n in range(12):
        rows = spark.range(n + 1).selectExpr("id", "'x' AS wide")
        bronze.append_execution(stamp_lineage(rows, f"B{n % 3}", f"run {n}", NOW), table)
    # an audit far too large to broadcast by itself
    audit = spark.range(300_000).selectExpr(
        "concat('B', id % 3) AS batch_id", "concat('run ', id) AS pipeline_run_id",
        "if(id % 4 = 1, 'FAILED', 'SUCCESS') AS status",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        expected = sum(n + 1 for n in range(12) if n % 4 != 1)
        for at_once in (bronze.BROADCAST_EXECUTIONS, 2):
            rows = bronze.read_committed(bronze.read_bronze(spark, table), audit, at_once)
            text = plan(rows)
            assert rows.count() == expected
            assert "SortMergeJoin" not in text and "dynamicpruning" in text.lower()
            assert "Exchange hashpartitioning" not in text
            assert text.count("FileScan parquet") >= (1 if at_once > 2 else 9)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    none = bronze.read_committed(bronze.read_bronze(spark, table), audit.where("status = 'LOST'"))
    assert none.count() == 0


def test_executions_are_removed_in_tasks(spark, folder, plan):
    table, odd = folder + "/t", "run:a=1 {x}%?"
    for batch, run in (("B1", "r1"), ("B1", odd), ("B:2", "r1"), ("B3", "kept")):
        bronze.append_execution(stamp_lineage(spark.range(5), batch, run, NOW), table)
    at = bronze.qualified(spark, table)
    os.makedirs(f"{table}/_batch_id=B4/_pipeline_run_id=half")
    with open(f"{table}/_batch_id=B4/_pipeline_run_id=half/part-0.parquet", "w") as file:
        file.write("not complete")
    lost = spark.createDataFrame(
        [(at, "B1", "r1"), (at, "B1", "r1"), (at, "B1", odd), (at, "B:2", "r1"), (at, "B9", "r1"), (at, "B4", "half"),
         (at, "..", "r1"), (at + "-none", "B1", "r1")],
        "target string, batch_id string, pipeline_run_id string",
    )
    frame = bronze.delete_executions(lost)
    assert "MapInPandas" in plan(frame)
    got = {(r.target[len(at):], r.batch_id, r.pipeline_run_id): (r.outcome, r.rows_before) for r in frame.collect()}
    done, noop = "BRONZE_CLEANUP_DONE", "BRONZE_CLEANUP_NOOP"
    assert got == {
        ("", "B1", "r1"): (done, 5), ("", "B1", odd): (done, 5), ("", "B:2", "r1"): (done, 5), ("", "B9", "r1"): (noop, 0),
        ("", "B4", "half"): (done, 0), ("", "..", "r1"): ("BRONZE_CLEANUP_FAILED", None), ("-none", "B1", "r1"): (noop, 0),
    }
    left = bronze.read_bronze(spark, table).select("_batch_id", "_pipeline_run_id").distinct().collect()
    assert [tuple(r) for r in left] == [("B3", "kept")]
    assert {r.outcome for r in bronze.delete_executions(lost.where("batch_id <> '..'")).collect()} == {noop}
