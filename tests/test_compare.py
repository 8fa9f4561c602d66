"""Reconciliation, drift, positions and profiles."""

import os
import random
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegate.operators import positions, reconcile, sales

rows_strategy = st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["x", "y", None])), max_size=12)
relaxed = settings(max_examples=8, deadline=None,
                   suppress_health_check=[HealthCheck.function_scoped_fixture])
SCHEMA = "a int, b string"


@relaxed
@given(rows_strategy, st.randoms())
def test_checksum_ignores_order(spark, rows, rng):
    mixed = list(rows)
    rng.shuffle(mixed)
    one, two = (spark.createDataFrame(r, SCHEMA) for r in (rows, mixed))
    result = reconcile.content_reconcile(one, two.repartition(5), ["a", "b"]).first()
    assert result.counts_equal and result.checksum_equal
    assert (
        reconcile.content_fingerprint(one, ["a", "b"]).first()
        == reconcile.content_fingerprint(two, ["a", "b"]).first()
    )


@relaxed
@given(rows_strategy, rows_strategy)
def test_drift_is_the_multiset_difference(spark, left, right):
    one, two = (spark.createDataFrame(r, SCHEMA) for r in (left, right))
    got = {
        (r.a, r.b, r.only_in): r.copies
        for r in reconcile.data_drift(one, two, ["a", "b"]).collect()
    }
    expected = {(*k, "LEFT"): n for k, n in (Counter(left) - Counter(right)).items()}
    expected |= {(*k, "RIGHT"): n for k, n in (Counter(right) - Counter(left)).items()}
    assert got == expected
    result = reconcile.content_reconcile(one, two, ["a", "b"]).first()
    assert result.checksum_equal == (Counter(left) == Counter(right))


def test_nulls_moved_between_columns_are_a_difference(frame):
    one = frame("a string, b string", (None, "a"), (None, None), ("b", None))
    two = frame("a string, b string", ("a", None), (None, None), ("b", None))
    assert not reconcile.content_reconcile(one, two, ["a", "b"]).first().checksum_equal
    assert reconcile.content_reconcile(one, one, ["a", "b"]).first().checksum_equal


def test_pairs_of_equal_rows_do_not_cancel(frame):
    one = frame(SCHEMA, (1, "x"), (1, "x"), (2, "y"), (2, "y"))
    two = frame(SCHEMA, (3, "x"), (3, "x"), (4, "y"), (4, "y"))
    result = reconcile.content_reconcile(one, two, ["a", "b"]).first()
    assert result.counts_equal and not result.checksum_equal


def test_equal_tables_move_digests_only(spark, folder):
    lines = spark.range(2000).selectExpr("id AS a", "concat('x', id % 7) AS b")
    lines.write.parquet(folder + "/one")
    lines.repartition(5).write.parquet(folder + "/two")
    one, two = (spark.read.parquet(f"{folder}/{n}") for n in ("one", "two"))
    assert reconcile.differing_parts(one, two, ["a", "b"]).count() == 0
    drift = reconcile.data_drift(one, two, ["a", "b"])
    assert drift.collect() == []
    final = drift._jdf.queryExecution().executedPlan().toString()
    initial = final.split("== Final Plan ==")[-1]
    assert "LeftSemi" in final and "Exchange hashpartitioning(a" not in initial.split("== Initial Plan ==")[0]
    changed = two.where("a <> 77").union(spark.createDataFrame([(77, "y"), (5, "x5")], "a long, b string"))
    parts = reconcile.differing_parts(one, changed, ["a", "b"]).count()
    assert 1 <= parts <= 3
    got = {(r.a, r.b, r.only_in, r.copies) for r in reconcile.data_drift(one, changed, ["a", "b"]).collect()}
    assert got == {(77, "x0", "LEFT", 1), (77, "y", "RIGHT", 1), (5, "x5", "RIGHT", 1)}


def test_schema_rows_come_from_footers(spark, folder, plan):
    kinds = {"a": "id", "b": "if(id % 2 = 0, 'x', null)", "c": "array(id, null)", "d": "struct(id AS e, 'k' AS f)",
             "g": "timestamp_ntz '2026-01-01 00:00:00'", "h": "cast(id AS decimal(20,3))", "i": "date '2026-01-01'"}
    rows = spark.range(50).selectExpr(*[f"{value} AS {name}" for name, value in kinds.items()])
    rows.selectExpr("*", "if(a < 25, 1, null) AS p").write.partitionBy("p").parquet(folder + "/t")
    rows.selectExpr("a", "'late' AS z").write.mode("append").parquet(folder + "/u")
    rows.drop("z").write.mode("append").parquet(folder + "/u")
    for name in ("t", "u"):
        path = f"{folder}/{name}"
        table = spark.read.option("mergeSchema", "true").parquet(path)
        expected = {tuple(r) for r in reconcile.schema_rows(table).collect()}
        assert {tuple(r) for r in reconcile.schema_rows_of_files(spark, path).collect()} == expected
        assert reconcile.schema_drift_of_files(spark, path, path).count() == 0
    text = plan(reconcile.footer_nulls(spark, folder + "/t"))
    assert "MapInPandas" in text and "FileScan" not in text
    stated = {r.column_name: (r.row_count, r.known_rows, r.nulls) for r in reconcile.footer_nulls(spark, folder + "/t").collect()}
    assert stated["b"] == (50, 50, 25) and stated["c"] == (50, 0, 0) and stated[None] == (50, 0, 0)


def test_schema_drift(frame):
    one = frame("a int, b string", (1, "x"))
    assert reconcile.schema_drift(one, frame("a int, b string", (2, "y"))).count() == 0
    moved = reconcile.schema_drift(one, frame("b string, a int", ("y", 1)))
    assert moved.count() == 4
    nulls = reconcile.schema_drift(one, frame("a int, b string", (1, None))).collect()
    assert {(r.column_name, r.has_nulls) for r in nulls} == {("b", False), ("b", True)}


def test_positions_with_a_dominant_value(frame):
    rng = random.Random(3)
    rows = [(rng.choice([5, 5, 5, rng.randrange(100)]), n) for n in range(400)]
    df = frame("k int, n int", *rows)
    got = positions.dense_positions(df.repartition(7), ["k", "n"]).orderBy("position").collect()
    assert [(r.k, r.n) for r in got] == sorted(rows)
    assert [r.position for r in got] == list(range(1, 401))
    assert positions.dense_positions(df.limit(0), ["k"]).count() == 0


def test_positional_join_wraps_round(frame):
    children = frame("c int", *[(n,) for n in range(7)])
    parents = frame("p int, name string", (30, "c"), (10, "a"), (20, "b"))
    joined = positions.positional_join(children, ["c"], parents, ["p"], ["name"])
    names = [r.name for r in joined.orderBy("c").collect()]
    assert names == ["a", "b", "c", "a", "b", "c", "a"]
    none = positions.positional_join(children, ["c"], parents.limit(0), ["p"], ["name"])
    assert none.count() == 0


def test_contiguity(frame):
    check = lambda *ids, **kw: tuple(
        reconcile.contiguity(frame("id int", *[(i,) for i in ids]), "id", **kw).first()
    )
    assert check(2, 1, 3) == (3, 3, True, False)
    assert check(1, 3) == (2, 3, False, False)
    assert check(1, 2, target=1) == (2, 2, True, True)
    assert check() == (0, 0, True, False)


def test_resumed_copy_is_complete(spark, folder):
    source = spark.range(1, 101)
    assert reconcile.resumable_copy(source, source.limit(0), "id").count() == 100
    source.where("id <= 40").write.parquet(folder + "/t")
    rest = reconcile.resumable_copy(source, spark.read.parquet(folder + "/t"), "id")
    assert rest.agg(F.min("id"), F.count("id")).first()[:] == (41, 60)


def test_order_totals(frame):
    orders = frame(
        "order_id int, shipping_amount decimal(12,2), discount_amount decimal(12,2),"
        " order_total decimal(14,2)",
        *[(n, *map(__import__("decimal").Decimal, v)) for n, v in
          [(1, ("10.00", "0.00", "0.00")), (2, ("0.00", "99.00", "0.00")),
           (3, ("1.00", "0.00", "7.00"))]],
    )
    lines = frame("order_id int, q int, p double", (1, 3, 0.1), (1, 1, 2.5), (2, 1, 5.0)).select(
        "order_id", sales.line_amount(F.col("q"), F.col("p")).alias("line_amount")
    )
    got = [str(r.order_total) for r in sales.order_totals(orders, lines).orderBy("order_id").collect()]
    assert got == ["12.80", "0.00", "7.00"]


def test_copy_with_a_hole_is_completed(spark, folder):
    source = spark.range(1, 1001).selectExpr("id", "concat('v', id) AS v").union(spark.createDataFrame([(None, "n")], "id long, v string"))
    target = folder + "/copy"
    ranged = source.withColumn("_range", F.floor(F.col("id") / 100))
    # a hole in the middle, a half-written range, a doubled row, a range too many
    broken = ranged.where("_range NOT IN (4, 7)").union(ranged.where("_range = 7 AND id % 2 = 0"))
    broken = broken.union(ranged.where("id = 250")).union(spark.createDataFrame([(5000, "x", 50)], broken.schema))
    broken.write.partitionBy("_range").parquet(target)
    before = {name: os.stat(f"{target}/{name}").st_mtime_ns for name in os.listdir(target)}
    todo = {r._range: (r.source_rows, r.copied_rows) for r in reconcile.complete_copy(source, target, "id", 100).collect()}
    assert todo == {4: (100, 0), 7: (100, 50), 2: (100, 101), 50: (0, 1), None: (1, 0)}
    copied = spark.read.parquet(target).select("id", "v")
    assert reconcile.content_reconcile(source, copied, ["id", "v"]).first().checksum_equal
    same = [name for name in before if name.startswith("_range=") and name.split("=")[1] not in ("2", "4", "7", "50")]
    assert len(same) == 8 and all(os.stat(f"{target}/{name}").st_mtime_ns == before[name] for name in same)
    assert not os.path.exists(f"{target}/_range=50")
    assert reconcile.complete_copy(source, target, "id", 100).count() == 0
    fresh = folder + "/fresh"
    assert reconcile.complete_copy(source, fresh, "id", 100).count() == 12
    assert spark.read.parquet(fresh).count() == 1001


def test_positions_store_keys_only(spark, folder):
    rows = spark.range(200).selectExpr("id % 5 AS k", "id AS n", "repeat('wide', 50) AS wide").union(
        spark.createDataFrame([(1, 7, "same")] * 9 + [(None, None, None)] * 3, "k long, n long, wide string")
    )
    directory = positions.rank_directory(rows, ["k", "n"])
    assert directory.columns == ["_id1", "_id2", "_first"] and directory.count() == 202
    got = positions.dense_positions(rows, ["k", "n"]).collect()
    assert sorted(r.position for r in got) == list(range(1, 213))
    low = lambda v: (v is not None, v or 0)
    order = [(low(r.k), low(r.n)) for r in sorted(got, key=lambda r: r.position)]
    assert order == sorted(order)
