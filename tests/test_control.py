"""Contracts, routes, options, ranges, paging and seeding."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tidegate.errors import LoadError
from tidegate.functions import documents, text
from tidegate.operators import configs, contracts, routing
from tidegate.schemas import AUDIT, CONFIG, STATE
from tidegate.session import local_frame
from tidegate.sources import ranges

GOOD = dict(
    ingestion_config_id=1, source_system="S", source_conn_ref="C", source_schema="dbo",
    source_object="o", ingestion_pattern="DATABASE", target_conn_ref="L", target_schema="t",
    target_table="t", load_strategy="FULL", is_active=True,
)
FILE = dict(
    GOOD, ingestion_pattern="FILE", source_schema=None, file_format="DELIMITED_TEXT",
    source_path="/in/", landing_path="landing/", source_options="{}",
)


def config(**change):
    return {field.name: None for field in CONFIG} | GOOD | change


def broken(spark, row):
    df = local_frame(spark, [row], CONFIG)
    rows = contracts.contract_violations(
        df, contracts.config_rules(), "config", F.col("ingestion_config_id")
    )
    return {r.rule for r in rows.collect()}


@pytest.mark.parametrize(
    "change, rules",
    [
        ({}, set()),
        (FILE, set()),
        ({"ingestion_pattern": "database", "load_strategy": "full"}, set()),
        ({"ingestion_pattern": "API", "source_schema": None}, set()),
        ({"ingestion_pattern": "STREAM"}, {"pattern", "file_format", "source_path", "source_schema"}),
        ({"source_object": "\t\n\r "}, {"required_text"}),
        ({"target_table": ""}, {"required_text"}),
        ({"source_schema": None}, {"source_schema"}),
        ({"file_format": "JSON"}, {"file_format"}),
        ({**FILE, "file_format": None}, {"file_format"}),
        ({**FILE, "file_format": "XML"}, {"file_format"}),
        ({**FILE, "source_path": " \t"}, {"source_path"}),
        ({**FILE, "landing_path": None}, {"landing_path"}),
        ({**FILE, "landing_path": "  "}, {"landing_path"}),
        ({"copy_options": "[]"}, {"copy_options_json"}),
        ({"source_options": "{} {}"}, {"source_options_json"}),
        ({"load_strategy": "MERGE"}, {"strategy", "watermark"}),
        ({"load_strategy": "INCREMENTAL"}, {"watermark"}),
        ({"load_strategy": "INCREMENTAL", "watermark_field": "u"}, set()),
        ({"load_strategy": "INCREMENTAL", "watermark_field": " "}, {"watermark"}),
        ({"watermark_field": "u"}, {"watermark"}),
    ],
)
def test_config_rules(spark, change, rules):
    assert broken(spark, config(**change)) == rules


def test_json_root_kind(frame):
    rows = frame(
        "t string", ("{}",), (' {"a":[1]} ',), ("[]",), ("{} x",), ("{},{}",), ("{",), ("1",),
        (None,), ('"{}"',), ('{"a":1,"a":2}',),
    )
    got = [r[0] for r in rows.select(documents.is_json_object(F.col("t"))).collect()]
    assert got == [True, True, False, False, False, False, False, False, False, True]


def test_set_key_keeps_other_types(frame):
    rows = frame("t string", ('{"a":1,"b":{"c":[2.5]}}',))
    got = rows.select(documents.with_key(F.col("t"), "a", F.lit("x"))).first()[0]
    assert sorted(got[1:-1].split(",", 1)) == ['"a":"x"', '"b":{"c":[2.5]}'] or got in (
        '{"b":{"c":[2.5]},"a":"x"}', '{"a":"x","b":{"c":[2.5]}}'
    )


def test_unique_keys_ignore_case_and_match_missing(frame):
    rows = frame(
        "a string, b string", ("Shop", None), ("SHOP ", None), ("shop", "x"), ("other", None)
    )
    got = contracts.unique_violations(rows, ["a", "b"], "t", "k").collect()
    assert [(r.row_key, r.row_count) for r in got] == [("shop|<null>", 2)]


def test_references(frame):
    child = frame("id int, ref string", (1, "x"), (2, "y"), (3, None))
    parent = frame("name string", ("x",))
    got = contracts.reference_violations(child, "ref", parent, "name", "fk", F.col("id"))
    assert [tuple(r) for r in got.collect()] == [("2", "fk", "y")]


@pytest.mark.parametrize(
    "options, expected",
    [
        (None, ("NONE", None, 0, None)),
        ("{}", ("NONE", None, 0, None)),
        ('{"partition_option":"none"}', ("NONE", None, 0, None)),
        ('{"partition_option":"DYNAMIC_RANGE","partition_column":"id"}',
         ("DYNAMIC_RANGE", "id", 0, None)),
        ('{"partition_option":"DYNAMIC_RANGE","partition_column":"id","parallel_copies":8}',
         ("DYNAMIC_RANGE", "id", 8, None)),
        ('{"partition_option":"NONE","parallel_copies":null}', ("NONE", None, 0, None)),
        ('{"partition_option":"DYNAMIC_RANGE"}', None),
        ('{"partition_option":"DYNAMIC_RANGE","partition_column":" "}', None),
        ('{"partition_option":"PHYSICAL_PARTITIONS"}', None),
        ('{"parallel_copies":0}', None),
        ('{"parallel_copies":-1}', None),
        ('{"parallel_copies":1.5}', None),
        ('{"parallel_copies":"4"}', None),
        ("[]", None),
        ("", None),
    ],
)
def test_copy_options(frame, options, expected):
    row = routing.check_copy_options(frame("copy_options string", (options,))).first()
    got = (row.partition_option, row.partition_column, row.parallel_copies, row.copy_error)
    assert got == (expected or (None, None, None, "INVALID_COPY_OPTIONS"))


@pytest.mark.parametrize(
    "pattern, form, kind, strategy, route, error",
    [
        ("DATABASE", None, "sql_server", "full", "SQL_SERVER|FULL", None),
        ("DATABASE", None, "SQL_SERVER", "INCREMENTAL", "SQL_SERVER|INCREMENTAL", None),
        ("DATABASE", None, "SFTP", "FULL", None, "UNSUPPORTED_DATABASE_ROUTE"),
        ("FILE", "delimited_text", "SFTP", "INCREMENTAL", "SFTP|INCREMENTAL", None),
        ("FILE", "PARQUET", "SQL_SERVER", "FULL", None, "UNSUPPORTED_FILE_FORMAT"),
        ("FILE", None, "SFTP", "FULL", None, "UNSUPPORTED_FILE_FORMAT"),
        ("FILE", "DELIMITED_TEXT", "LAKEHOUSE", "FULL", None, "UNSUPPORTED_FILE_ROUTE"),
        ("API", None, "SFTP", "FULL", None, None),
    ],
)
def test_routes(frame, pattern, form, kind, strategy, route, error):
    rows = frame(
        "ingestion_pattern string, file_format string, source_connection_type string,"
        " load_strategy string",
        (pattern, form, kind, strategy),
    )
    row = routing.route_objects(rows).first()
    assert (row.route, row.route_error) == (route, error)


def covered(predicates, low, high):
    """How many predicates hold for each value, NULL included."""
    import duckdb

    con = duckdb.connect()
    values = [*range(low - 2, high + 3), None]
    return [
        sum(
            bool(con.execute(f"SELECT {p} FROM (SELECT ?::BIGINT AS k)", [v]).fetchall()[0][0])
            for p in predicates
        )
        for v in values
    ]


@pytest.mark.parametrize("low, high, slices", [(0, 100, 8), (5, 5, 4), (-7, 2, 3), (1, 9, 100)])
def test_ranges_cover_every_value_once(low, high, slices):
    predicates = ranges.range_predicates("k", low, high, slices)
    assert len(predicates) <= slices
    assert set(covered(predicates, low, high)) == {1}


def test_date_ranges():
    days = [(d.toordinal() - ranges.EPOCH.toordinal()) for d in
            (ranges.date(2026, 1, 1), ranges.date(2026, 12, 31))]
    predicates = ranges.range_predicates("d", *days, 2, is_date=True)
    assert predicates == ["(d < '2026-07-03' OR d IS NULL)", "(d >= '2026-07-03')"]


def test_range_labels_add_no_shuffle(spark, plan):
    rows = ranges.label_ranges(spark.range(1, 101), "id", 4)
    assert "Exchange" not in plan(rows)
    assert [r["count"] for r in rows.groupBy("_range_id").count().collect()] == [25] * 4
    assert ranges.label_ranges(spark.range(0), "id", 4).count() == 0


def cut_rows(spark, kind):
    """A column where one value has a third of the rows and a tail is long; some are NULL."""
    keys = [5] * 500 + [k * k for k in range(900)] + [10**12] * 90
    stamp = {"k long": lambda k: k, "k date": lambda k: ranges.date(2000, 1, 1) + ranges.timedelta(days=k % 9999),
             "k timestamp_ntz": lambda k: ranges.datetime(2000, 1, 1) + ranges.timedelta(microseconds=k)}[kind]
    return [(stamp(k), k % 10) for k in keys] + [(None, 1)] * 20


@pytest.mark.parametrize("kind", ["k long", "k date", "k timestamp_ntz"])
def test_depth_cuts_are_even_inside_the_window(spark, kind):
    rows = cut_rows(spark, kind)
    df = spark.createDataFrame(rows, f"{kind}, w int")
    inside = df.where("w > 2 AND w <= 9")
    cuts = ranges.depth_cuts(inside, "k", 8)
    counts = {r._range_id: r["count"] for r in ranges.label_cuts(inside, "k", cuts).groupBy("_range_id").count().collect()}
    wanted = [r for r in rows if 2 < r[1] <= 9]
    assert sum(counts.values()) == len(wanted)
    own = {v for v in {r[0] for r in wanted} if sum(r[0] == v for r in wanted) > len(wanted) / 8}
    assert own and sorted(n for n in counts.values() if n * 8 > 2 * len(wanted)) == sorted(
        n for v in own if (n := sum(r[0] == v for r in wanted)) * 8 > 2 * len(wanted)
    )
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t (k {kind[2:].replace('_ntz', '')}, w INT)")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    predicates = ranges.cut_predicates("k", cuts, "w > 2 AND w <= 9")
    assert len(predicates) <= 2 * 8 and all("w > 2 AND w <= 9" in p for p in predicates)
    hits = " + ".join(f"coalesce(CAST({p} AS INT), 0)" for p in predicates)
    got = con.execute(f"SELECT w > 2, {hits} AS n, count(*) FROM t GROUP BY ALL").fetchall()
    assert {(inside, n) for inside, n, _ in got} == {(True, 1), (False, 0)}


def test_cuts_of_little(spark):
    empty = spark.createDataFrame([], "k long")
    assert ranges.depth_cuts(empty, "k", 8) == [] and ranges.cut_predicates("k", []) == ["1 = 1"]
    assert ranges.cut_predicates("k", [], "w > 1") == ["(w > 1)"]
    same = spark.createDataFrame([(3,)] * 9, "k long")
    cuts = ranges.depth_cuts(same, "k", 4)
    assert [r._range_id for r in ranges.label_cuts(same, "k", cuts).distinct().collect() if r.k == 3] == [1]
    assert ranges.cut_predicates("k", cuts)[1] == "(k >= 3 AND k <= 3)"
    with pytest.raises(ValueError, match="whole numbers"):
        ranges.depth_cuts(spark.createDataFrame([("1",)], "k string"), "k", 4)


def test_sketch_reads_the_column_and_the_window_only(spark, folder, plan):
    spark.range(100).selectExpr("id AS k", "id AS w", "'x' AS wide").write.parquet(folder + "/t")
    rows = spark.read.parquet(folder + "/t").where("w > 50")
    text = plan(rows.select("k").agg({"k": "max"}))
    assert "wide" not in text and "GreaterThan(w,50)" in text
    assert "Exchange" not in plan(ranges.label_cuts(rows, "k", ranges.depth_cuts(rows, "k", 4)))


def test_pages(frame):
    scope = frame("config_id int", *[(n,) for n in (5, 3, 9, 1, 7)])
    page = lambda n: [r.config_id for r in configs.config_page(scope, n, 2).collect()]
    assert [page(0), page(1), page(2), page(3)] == [[1, 3], [5, 7], [9], []]
    assert tuple(configs.page_count(scope, 2).first()) == (5, 3)
    for size in (0, 5001, -1):
        with pytest.raises(LoadError) as caught:
            configs.page_count(scope, size)
        assert caught.value.code == "INVALID_CONFIG_PAGE_SIZE"


def test_seeding(spark):
    current = local_frame(
        spark,
        [config(ingestion_config_id=4, source_object="kept"),
         config(ingestion_config_id=7, source_object="old", source_schema=None),
         config(ingestion_config_id=9, source_system="bench", source_object="b")],
        CONFIG,
    )
    seed = local_frame(
        spark,
        [config(source_system="s ", source_object="OLD", source_schema=None, target_table="new"),
         config(source_object="z"), config(source_object="a"),
         config(source_system="BENCH", source_object="b", target_table="new")],
        CONFIG,
    ).drop("ingestion_config_id")
    after = configs.upsert_configs(current, seed, "BENCH").orderBy("ingestion_config_id").collect()
    assert [(r.ingestion_config_id, r.source_object, r.target_table, r.change) for r in after] == [
        (4, "kept", "t", "KEPT"), (7, "old", "new", "UPDATED"), (9, "b", "t", "KEPT"),
        (10, "a", "t", "ADDED"), (11, "z", "t", "ADDED"),
    ]


def test_doubled_spellings_are_refused_by_name(spark):
    current = local_frame(spark, [config(ingestion_config_id=1, source_object="orders")], CONFIG)
    spell = lambda *names: local_frame(spark, [config(source_object=n) for n in names], CONFIG).drop("ingestion_config_id")
    for seed, named in ((spell("Orders", "ORDERS", "y"), "s.dbo.orders"), (spell("x", "X ", "orders"), "s.dbo.x")):
        with pytest.raises(LoadError, match=named) as caught:
            configs.upsert_configs(current, seed)
        assert caught.value.code == "AMBIGUOUS_SEED"
    twice = local_frame(spark, [config(ingestion_config_id=i, source_object=n) for i, n in ((1, "a"), (2, "A"))], CONFIG)
    with pytest.raises(LoadError, match="s.dbo.a"):
        configs.upsert_configs(twice, spell("b"))
    refs = spark.createDataFrame([("C1", "X", "{}"), ("c1", "Y", "{}")], "connection_ref string, connection_type string, connection_settings string")
    with pytest.raises(LoadError, match="c1"):
        configs.upsert_connections(refs.limit(0), refs)


def test_seeding_keeps_time_stamps(spark):
    current = local_frame(
        spark, [config(ingestion_config_id=i, source_object=n) for i, n in ((1, "kept"), (2, "old"))], CONFIG
    ).withColumns({"created_at": F.lit("2026-01-01").cast("timestamp_ntz"), "updated_at": F.lit("2026-01-02").cast("timestamp_ntz")})
    seed = local_frame(spark, [config(source_object=n) for n in ("OLD", "new")], CONFIG).drop("ingestion_config_id")
    after = configs.upsert_configs(current, seed, now=F.lit("2026-03-03").cast("timestamp_ntz"))
    got = [(r.source_object, str(r.created_at)[:10], str(r.updated_at)[:10]) for r in after.orderBy("ingestion_config_id").collect()]
    assert got == [
        ("kept", "2026-01-01", "2026-01-02"), ("old", "2026-01-01", "2026-03-03"), ("new", "2026-03-03", "2026-03-03"),
    ]


def test_state_is_only_added(spark):
    rows = [
        config(ingestion_config_id=n, load_strategy=s, watermark_field=f, ingestion_pattern=p)
        for n, s, f, p in [(1, "INCREMENTAL", "u", "DATABASE"), (2, "INCREMENTAL", "m", "FILE"),
                           (3, "FULL", None, "DATABASE"), (4, "INCREMENTAL", "t", "API")]
    ]
    state = local_frame(spark, [(1, "u", "x", None, None, None)], STATE)
    got = configs.missing_state(local_frame(spark, rows, CONFIG), state).collect()
    assert [tuple(r) for r in got] == [(2, "m", "1900-01-01T00:00:00Z")]


def test_audit_rules(spark):
    assert "log_timestamp" not in AUDIT.fieldNames()
    rules = contracts.audit_rules()
    assert set(rules) == {
        "counts", "duration", "load_strategy", "required_text", "run_type", "status", "time",
    }


def test_message_cuts(frame):
    rows = frame("a string, b string", ("x" * 5000, None), ("short", "y" * 2000))
    got = rows.select(
        text.audit_message(F.col("a")), text.paired_message("one", F.col("a"), "two", F.col("b"))
    ).collect()
    assert len(got[0][0]) == 4000 and got[1][0] == "short"
    assert got[0][1] == "one: " + "x" * 1500 + " | two: "
    assert got[1][1] == "one: short | two: " + "y" * 1500
