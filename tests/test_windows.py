"""Bounds, windows and file times."""

import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegate.functions.temporal import seconds_crossed, sortable_bound, utc_text
from tidegate.operators.windows import plan_windows
from tidegate.sources.files import (
    discover, list_folders, modified_window, relative_to, rows_in_modified_window,
)
from tidegate.sources.ranges import range_number
from tidegate.sources.tables import upper_bound, window_rows


def test_seven_digit_window(frame):
    """LOW is exclusive and HIGH inclusive down to the seventh digit of text."""
    day = "2026-10-08T10:00:00."
    rows = frame(
        "id int, at string",
        *[(n, day + f) for n, f in enumerate(["1234567", "1234568", "1234569", "1240001"], 1)],
    )
    at = sortable_bound(F.col("at"))
    low, high = (sortable_bound(F.lit(day + f)) for f in ("1234567", "1240001"))
    assert [r.id for r in rows.where((at > low) & (at <= high)).collect()] == [2, 3, 4]
    window = window_rows(rows, "at", day + "1234567", upper_bound(rows, "at").first().upper_bound)
    assert [r.id for r in window.collect()] == [2, 3, 4]


def test_sortable_form(frame):
    rows = frame(
        "t string", ("2026-01-02T03:04:05Z",), ("2026-01-02 03:04:05.1",), ("token",), (None,),
        ("2026-02-30T00:00:00",), ("2026-01-02T03:04:05+02:00",), ("2026-01-02",),
        ("2026-01-02T03:04:05.123-0700",),
    )
    assert [r[0] for r in rows.select(sortable_bound(F.col("t"))).collect()] == [
        "2026-01-02 03:04:05.0000000", "2026-01-02 03:04:05.1000000", None, None, None, None,
        "2026-01-02 00:00:00.0000000", None,
    ]


days = st.integers(0, 40).map(lambda n: f"2026-01-{n % 28 + 1:02d}T00:00:00")


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cuts=st.lists(days, min_size=3, max_size=3))
def test_adjacent_windows_lose_and_repeat_nothing(spark, cuts):
    low, middle, high = sorted(cuts)
    rows = spark.range(0, 40).select(
        "id",
        (F.lit("2026-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=F.col("id").cast("int")))
        .alias("at"),
    )
    ids = lambda df: [r.id for r in df.orderBy("id").collect()]
    whole = ids(window_rows(rows, "at", low, high))
    assert whole == ids(window_rows(rows, "at", low, middle)) + ids(
        window_rows(rows, "at", middle, high)
    )
    files = rows.withColumnRenamed("at", "modified_time")
    whole = ids(modified_window(files, low, high))
    assert whole == ids(modified_window(files, low, middle)) + ids(
        modified_window(files, middle, high)
    )


def test_window_reaches_the_scan(spark, folder, plan):
    spark.range(10).select(
        "id", F.lit("2026-01-01").cast("timestamp_ntz").alias("at")
    ).write.parquet(folder + "/t")
    rows = window_rows(spark.read.parquet(folder + "/t"), "at", "2025-01-01", "2026-01-01")
    text = plan(rows.select("id"))
    assert "GreaterThan(at" in text and "LessThanOrEqual(at" in text
    assert rows.count() == 10


def test_upper_bound_of_an_empty_table(frame):
    assert upper_bound(frame("at timestamp_ntz"), "at").first().upper_bound is None


def test_seconds_count_boundaries_not_elapsed_time(frame):
    rows = frame("a string, b string", ("2026-01-01 00:00:00.9", "2026-01-01 00:00:01.1"),
                 ("2026-01-01 00:00:00.1", "2026-01-01 00:00:00.9"),
                 ("2026-01-01 00:00:02", "2026-01-01 00:00:01.9"))
    at = lambda n: F.col(n).cast("timestamp_ntz")
    assert [r[0] for r in rows.select(seconds_crossed(at("a"), at("b"))).collect()] == [1, 0, -1]


def test_utc_text(frame):
    rows = frame("a string", ("2026-09-27 10:30:00.1239",))
    assert rows.select(utc_text(F.col("a").cast("timestamp_ntz"))).first()[0] == (
        "2026-09-27T10:30:00.123Z"
    )


CONFIG = ("ingestion_config_id int, ingestion_pattern string, load_strategy string,"
          " watermark_field string")
STATE = "ingestion_config_id int, watermark_field string, last_watermark_value string"
ASKED = "config_id int, run_type string, lower_bound string, upper_bound string"
START = "2026-05-01T00:00:00.000Z"


@pytest.mark.parametrize(
    "config, stored, asked, source, expected",
    [
        # table sources
        (("DATABASE", "INCREMENTAL", "u"), ("u", "2026-01-01"), ("REGULAR", "", ""), "2026-02-01",
         ("PROCESS", None, True)),
        (("DATABASE", "INCREMENTAL", "u"), ("u", "2026-02-01T00:00:00Z"), ("REGULAR", "", ""),
         "2026-02-01T00:00:00.000", ("SKIPPED", None, False)),
        (("DATABASE", "INCREMENTAL", "u"), ("u", "2026-02-02"), ("REGULAR", "", ""), "2026-02-01",
         ("FAILED", "INVALID_PROCESSING_BOUNDARY", False)),
        (("DATABASE", "INCREMENTAL", "u"), ("u", "2026-02-02"), ("REGULAR", "", ""), None,
         ("SKIPPED", None, False)),
        (("DATABASE", "INCREMENTAL", "u"), ("u", "2026-01-01"), ("BACKFILL", "2025-01-01",
         "2025-02-01"), "2026-02-01", ("PROCESS", None, False)),
        (("DATABASE", "INCREMENTAL", "u"), ("u", "2026-01-01"), ("BACKFILL", "2025-01-01",
         "2025-01-01"), "2026-02-01", ("FAILED", "INVALID_PROCESSING_BOUNDARY", False)),
        (("DATABASE", "INCREMENTAL", "u"), ("other", "2026-01-01"), ("REGULAR", "", ""),
         "2026-02-01", ("FAILED", "STATE_NOT_FOUND", False)),
        (("DATABASE", "INCREMENTAL", "u"), ("u", "2026-10-08T10:00:00.1234567"),
         ("REGULAR", "", ""), "2026-10-08T10:00:00.1234568", ("PROCESS", None, True)),
        (("DATABASE", "FULL", None), ("u", "2026-01-01"), ("REGULAR", "", ""), None,
         ("PROCESS", None, False)),
        # file sources end at the run start; equal bounds are an error there
        (("FILE", "INCREMENTAL", "last_modified_time"), ("last_modified_time", "2026-01-01"),
         ("regular", "", ""), None, ("PROCESS", None, True)),
        (("FILE", "INCREMENTAL", "last_modified_time"), ("last_modified_time", START),
         ("REGULAR", "", ""), None, ("FAILED", "INVALID_PROCESSING_BOUNDARY", False)),
        (("FILE", "INCREMENTAL", "last_modified_time"), ("x", START), ("REGULAR", "", ""), None,
         ("FAILED", "STATE_NOT_FOUND", False)),
        # the field is checked before the state is looked up
        (("FILE", "INCREMENTAL", "file_name"), ("x", START), ("REGULAR", "", ""), None,
         ("FAILED", "UNSUPPORTED_FILE_WATERMARK", False)),
    ],
)
def test_window_classes(frame, config, stored, asked, source, expected):
    row = plan_windows(
        frame(ASKED, (1, *asked)),
        frame(CONFIG, (1, *config)),
        frame(STATE, (1, *stored)),
        frame("config_id int, source_upper_bound string", (1, source)),
        START,
    ).first()
    assert (row.window_class, row.window_error, row.may_advance) == expected


def test_bound_texts_pass_through_unchanged(frame):
    row = plan_windows(
        frame(ASKED, (1, "REGULAR", "", "")),
        frame(CONFIG, (1, "DATABASE", "INCREMENTAL", "u")),
        frame(STATE, (1, "u", "2026-10-08T10:00:00.1234567Z")),
        frame("config_id int, source_upper_bound string", (1, "2026-10-08 10:00:00.9")),
        START,
    ).first()
    assert row.processing_lower_bound == "2026-10-08T10:00:00.1234567Z"
    assert row.processing_upper_bound == "2026-10-08 10:00:00.9"


def test_file_at_the_lower_bound_is_taken(spark, folder):
    deep = os.path.join(folder, "2026", "09")
    os.makedirs(deep)
    for name, second in (("a.csv", 99), ("b.csv", 100), ("c.csv", 150), ("d.csv", 200)):
        path = os.path.join(deep, name)
        with open(path, "w") as file:
            file.write(f"id\n{name}\n")
        os.utime(path, (second, second))
    low, high = "1970-01-01T00:01:40.000Z", "1970-01-01T00:03:20.000Z"
    found = modified_window(discover(spark, folder, "*.csv"), low, high)
    assert sorted(r.path[-5:] for r in found.collect()) == ["b.csv", "c.csv"]
    rows = spark.read.option("header", "true").option("recursiveFileLookup", "true").csv(folder)
    taken = rows_in_modified_window(rows, low, high)
    assert sorted(r.id for r in taken.collect()) == ["b.csv", "c.csv"]
    assert discover(spark, folder, "c*").count() == 1


def test_empty_hidden_and_oddly_named_files_are_found(spark, folder):
    names = ["a.csv", "empty.csv", "_held.csv", ".dot.csv", "deep/er/b 1%2F.csv", "run=x%3Ay/é#?.csv",
             "_tmp/c.csv", "notes.txt"]
    for name in names:
        os.makedirs(os.path.dirname(os.path.join(folder, name)), exist_ok=True)
        with open(os.path.join(folder, name), "w") as file:
            file.write("" if name == "empty.csv" else "x")
    os.makedirs(os.path.join(folder, "bare"))
    def found(*args, **more):
        rows = discover(spark, folder, *args, **more)
        return {r.p: r.length for r in rows.select(relative_to(F.col("path"), folder).alias("p"), "length").collect()}
    plain = {"a.csv": 1, "empty.csv": 0, "deep/er/b 1%2F.csv": 1, "run=x%3Ay/é#?.csv": 1}
    assert found("*.csv") == plain
    assert found() == plain | {"notes.txt": 1}
    assert found("_*") == {"_held.csv": 1} and found(".*") == {".dot.csv": 1}
    assert found("*", hidden=True) == dict.fromkeys(names, 1) | {"empty.csv": 0}
    assert found("{a,empty}.c[r-t]v") == {"a.csv": 1, "empty.csv": 0}
    assert found("[!a]*.t?t") == {"notes.txt": 1} and found("a.cs") == {}
    one = discover(spark, os.path.join(folder, "a.csv"), "*.csv").first()
    assert one.path.endswith("/a.csv") and one.length == 1
    assert discover(spark, os.path.join(folder, "bare")).count() == 0
    with pytest.raises(Exception, match="bare2"):
        discover(spark, os.path.join(folder, "bare2"))


def test_walk_lists_in_tasks(spark, folder, plan):
    for i in range(3):
        os.makedirs(os.path.join(folder, f"d{i}"))
        with open(os.path.join(folder, f"d{i}", "x.csv"), "w") as file:
            file.write("x")
    level = spark.createDataFrame([(f"d{i}",) for i in range(3)], "place string")
    listed = list_folders(level.repartition(3), "file:" + folder, False)
    text = plan(listed)
    assert "MapInPandas" in text and "InMemoryFileIndex" not in text and "binaryFile" not in text
    assert sorted(r.place for r in listed.collect()) == ["d0/x.csv", "d1/x.csv", "d2/x.csv"]
    assert "binaryFile" not in plan(discover(spark, folder))


def test_relative_path(frame):
    rows = frame("p string", ("file:/lake/land/2026/a.csv",), ("s3://b/lake/land/a.csv",),
                 ("file:/lake/land/x/lake/land/a.csv",), ("file:/lake/land/q?1.csv",))
    got = [r[0] for r in rows.select(relative_to(F.col("p"), "/lake/land/")).collect()]
    # a folder that repeats the root's name stays in the path, and so does a question mark
    assert got == ["2026/a.csv", "a.csv", "x/lake/land/a.csv", "q?1.csv"]


def test_range_labels_at_large_keys(spark):
    lo, width = 10**18, 10**17 + 7
    keys = [lo, lo + width - 1, lo + width, lo + 7 * width - 1, lo + 7 * width, lo + 8 * width - 1]
    rows = spark.createDataFrame([(k,) for k in keys], "k long")
    got = [r[0] for r in rows.select(range_number(F.col("k"), lo, width)).collect()]
    assert got == [(k - lo) // width for k in keys]
