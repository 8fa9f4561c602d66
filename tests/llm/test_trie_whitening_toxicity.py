"""Prefix trie, whitening and toxicity against brute force, labels and odd rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidegate.llm import prefix_trie, toxicity, whitening
from tidegate.llm.scans import PART, part_totals, running, spread
from tidegate.llm.shared import ship

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def session(spark):
    return ship(spark)


# ---- running totals and the trie


def test_running_totals_of_a_hot_group(session):
    from pyspark.sql import functions as F

    rng = random.Random(5)
    rows = [(7 if i % 3 else i % 40, i, rng.randint(-9, 9)) for i in range(3000)]
    rng.shuffle(rows)
    placed = spread(session.createDataFrame(rows, "g long, o long, v long"), "g", ["o"], ["o", "v"])
    assert placed.where("g = 7").select(PART).distinct().count() > 2
    for backward in (False, True):
        totals = {"v": F.sum("v"), "xor1": F.bit_xor("v")}
        parts = part_totals(placed, "g", totals, backward).withColumnRenamed("v", "t").withColumnRenamed("xor1", "x")
        got = {(r.g, r.o): (r.run_v, r.run_xor1) for r in running(placed, parts, "g", {"v": "v", "xor1": "v"}, backward).collect()}
        total, mixed = defaultdict(int), defaultdict(int)
        for g, o, v in sorted(rows, key=lambda r: r[1], reverse=backward):
            total[g] += v
            mixed[g] ^= v
            assert got[g, o] == (total[g], mixed[g])


def brute_trie(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            by[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    by = {c: [t[1:] for t in sorted(turns)] for c, turns in by.items()}
    made = {}
    for c, turns in by.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        made[c] = tuple(by.get(base, [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, s in made.items():
        ends[s].append(c)
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    saved, leaves = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(WORD.findall(node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in kids[node])
        leaves[node] = sum(leaves[k] for k in kids[node]) if kids[node] else 1
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids[n]), leaves[n], saved[n],
         hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
        for n, m in members.items()
    )


def told(frame):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(tuple(r[n] for n in names) for r in frame.collect())


@pytest.mark.parametrize("long", [0, 400])
def test_trie_is_brute_force(session, long):
    rng = random.Random(long)
    rows = []
    for c in [*range(-25, 70), 7_000_000_000]:
        size = long if c == 40 and long else rng.choice([1, 1, 2, 3, 3, 5])
        for k in range(size):
            rows.append((c, rng.choice([k, k, None, 0]), rng.choice(["user", None]), rng.choice(["a b", "a", None, "c  d\n e"])))
    rows += [(200 + i, 0, "user", "hi there") for i in range(200)]  # one large group of equal conversations
    rows += [(None, 0, "user", "lost")] * 3
    wide = [(t, r, c, x, 5, "q", 1) for c, t, r, x in rows]
    frame = session.createDataFrame(wide, "turn long, role string, conv_id long, text string, n long, conv string, d int")
    assert told(prefix_trie.trie_report(frame)) == brute_trie(rows)


def test_trie_of_busy_parents(session, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SHARE", 3)
    rows = [(20 * i, k, "user", f"{i % (k * 9 + 1)} x") for i in range(60) for k in range(3)]
    frame = session.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert told(prefix_trie.trie_report(frame)) == brute_trie(rows)


def test_trie_of_nothing_and_of_turnless_conversations(session):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.trie_report(session.createDataFrame([], schema)).collect() == []
    rows = [(c, 0, "user", "x") for c in range(300, 330) if zlib.crc32(str(c).encode()) % 4 and c % 20]
    rows = [r for r in rows if r[0] - r[0] % 20 not in (300,)]
    assert rows
    assert told(prefix_trie.trie_report(session.createDataFrame(rows, schema))) == brute_trie(rows)


# ---- whitening


def brute_whitening(rows):
    good = [(k, v) for k, v in rows if v is not None and all(e is not None and np.isfinite(e) for e in v)]
    x = np.floor(np.array([v for _, v in good], float) * 256).astype(np.int64)
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    apart = distinct - sums / n
    values, vectors = np.linalg.eigh(apart.T @ apart / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    y = (x - sums / n) @ vectors[:, :4] / np.sqrt(values[:4])
    return [k for k, _ in good], n, ((n * x - sums) ** 2).sum(axis=1), y, values / values.sum()


def test_whitening_is_brute_force(session):
    table = session.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    keys, n, deviation, y, explained = brute_whitening(rows)
    got = {(r.vec_id, r.component): r for r in whitening.whitening_report(table).collect()}
    assert len(got) == 4 * len(keys)
    mine = np.array([[got[k, c].whitened for c in range(1, 5)] for k in keys])
    sign = np.sign((mine * y).sum(axis=0))
    assert np.abs(mine * sign - y).max() < 1e-9
    for key, d in zip(keys, deviation):
        assert got[key, 1].deviation == d and got[key, 1].n == n
    one = [got[keys[0], c] for c in range(1, 5)]
    assert np.allclose([r.explained for r in one], explained[:4], rtol=1e-9)
    assert one[0].identity_error < 1e-9


@pytest.mark.parametrize("size,number", [(1, 9), (5, 3), (8, 200), (33, 90)])
def test_rank_one_updates(size, number):
    rng = np.random.default_rng(size)
    x = rng.integers(-50, 50, (number, size))
    x[:, size // 2] = 7  # a flat direction
    x[1:3] = x[0]  # equal vectors
    halves = [whitening.Spectrum.empty(size) for _ in range(2)]
    for i, vector in enumerate(x):
        halves[i % 2].take(vector)
    halves[0].join(halves[1])
    apart = x - x.mean(axis=0)
    scatter = apart.T @ apart
    found = halves[0]
    scale = max(np.abs(scatter).max(), 1)
    assert np.abs((found.basis * found.values) @ found.basis.T - scatter).max() < 1e-12 * scale
    assert np.abs(found.basis.T @ found.basis - np.eye(size)).max() < 1e-12
    assert found.n == number and (found.sums == x.sum(axis=0)).all()


def test_whitening_of_odd_rows(session):
    inf, nan = float("inf"), float("nan")
    schema = "embedding array<float>, vec_id long, x string, n int"
    rows = [
        (None, 1, "a", 1), ([1.0, None], 2, "a", 1), ([nan, 1.0], 3, "a", 1), ([], 4, "a", 1), ([1.0, 2.0], 5, None, None),
        ([1.0, 2.0], 5, None, None), ([3.0, 2.5], None, "a", 1), ([3.0, 2.5, 1.0], 8, "a", 1), ([-inf, 1.0], 9, "a", 1),
    ]
    frame = session.createDataFrame(rows, schema)
    got = whitening.whitening_report(frame).collect()
    assert sorted((r.vec_id or 0, r.component, r.n) for r in got) == [(0, 1, 2), (0, 2, 2), *[(5, 1, 2)] * 2, *[(5, 2, 2)] * 2]
    assert all(abs(r.whitened) == pytest.approx(1.0 if r.component == 1 else 0.0) for r in got)
    assert whitening.whitening_report(frame.limit(0)).collect() == []
    assert whitening.whitening_report(frame.where("vec_id IN (1, 4)")).collect() == []
    alone = whitening.whitening_report(frame.where("vec_id = 5")).collect()
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone} == {(1, 0, 0.0, 0.0, 0.0)}


def test_whitening_merges_many_tasks(session):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=6) * [5, 4, 3, 2, 1, 0.5]]) for i in range(600)]
    frame = session.createDataFrame(rows, "vec_id long, embedding array<double>")
    before = session.conf.get("spark.sql.shuffle.partitions")
    session.conf.set("spark.sql.shuffle.partitions", "70")
    try:
        got = {(r.vec_id, r.component): r.whitened for r in whitening.whitening_report(frame).collect()}
    finally:
        session.conf.set("spark.sql.shuffle.partitions", before)
    keys, _, _, y, _ = brute_whitening(rows)
    mine = np.array([[got[k, c] for c in range(1, 5)] for k in keys])
    assert np.abs(mine * np.sign((mine * y).sum(axis=0)) - y).max() < 1e-9


# ---- toxicity


def instance_texts(text):
    letters = "?abcdefghijklmnopqrstuvwxyz"
    data = np.frombuffer(text.encode(), np.uint8)
    found = toxicity.Instances.of(data, np.array([0, len(data)]))
    return ["".join(letters[i] for i in found.letters[a:b]) for a, b in zip(found.start, found.end)]


def test_instances():
    assert instance_texts("Ab i.d-i,o*t  ÉTÉ\n") == ["ab", "idiot", "ete"]
    assert instance_texts("i d i o t and it is a b") == ["idiot", "and", "itisab"]
    assert instance_texts(" \n.") == [] and instance_texts("") == []
    pieces = instance_texts("abcdefghijklmnopqrstuvwxyz" * 2)
    assert [len(p) for p in pieces] == [24, 24, 24, 16] and pieces[1] == pieces[0][12:] + "yzabcdefghij"


def test_kernel_is_brute_force():
    from itertools import combinations

    def phi(word):
        out = defaultdict(float)
        padded = "." + word + "."
        for n in toxicity.LENGTHS:
            for at in combinations(range(len(padded)), n):
                skipped = at[-1] - at[0] - n + 1
                if skipped <= toxicity.SKIPS:
                    out["".join(padded[i] for i in at)] += toxicity.DECAY**skipped
        return out

    def strings(words):
        data = np.frombuffer(" ".join(words).encode(), np.uint8)
        found = toxicity.Instances.of(data, np.array([0, len(data)]))
        return found.take(np.arange(len(found.start)))

    words, marks = ["idiot", "idxiot", "banana", "abcdefgh"], ["idiot", "bandana", "fghab"]
    left, right = strings(words), strings(marks)
    near = toxicity.Kernel(right).with_landmarks(left)
    for i, word in enumerate(words):
        for j, mark in enumerate(marks):
            a, b = phi(word), phi(mark)
            expected = sum(v * b[k] for k, v in a.items() if k in b) / left.norms()[i] / right.norms()[j]
            assert near[i, j] == pytest.approx(expected, rel=1e-5)
    # the machine's table gives the same sums
    alpha = np.array([0.5, -2.0, 1.5])
    machine = toxicity.Kernel(right).machine(alpha, 0.25)
    assert np.allclose(toxicity.margins(left, toxicity.Tables(machine), 0.25), near @ alpha + 0.25, atol=1e-5)


@pytest.fixture(scope="module")
def scored(session):
    docs = session.read.parquet(f"{FOLDER}/documents.parquet")
    labels = session.read.parquet(f"{FOLDER}/labels.parquet")
    rows = toxicity.toxicity_report(docs, labels).collect()
    return docs, labels, {r.doc_id: r for r in rows}, rows


def test_held_out_accuracy(scored):
    docs, labels, by, rows = scored
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    marks = [(by[r.doc_id], r.toxic) for r in labels.collect() if by[r.doc_id].held_out]
    bad = [r.predicted for r, t in marks if t == 1]
    good = [r.predicted for r, t in marks if t == 0]
    assert sum(bad) >= 0.75 * len(bad) and sum(good) <= 0.02 * len(good)


def test_gapped_insults_are_found(session, scored):
    docs, labels, by, _ = scored
    texts, marks = toxicity.labelled_sample(docs, labels, "doc_id", "text")
    machine = toxicity.fit(texts, marks)
    tables = toxicity.Tables(machine)
    calm = "the ration of anding is here and the ether in on " * 3
    texts = [calm + x + " and then " + x for x in ("", "you idiot stupid", "you i d i o t s.t.u.p.i.d", "you idxiot stuxpid worzthless")]
    scores = toxicity.score_batch(pa.array(texts), machine, tables)
    assert scores[0] < 0.5 and (scores[1:] > scores[0] + 0.2).all()


def test_toxicity_of_odd_rows(session, scored):
    _, labels, _, _ = scored
    schema = "text string, doc_id long, score string, toxic int, id int"
    long = "x" * 300_000 + " idiot"
    rows = [
        (None, 1, "a", 1, 1), ("", 2, "a", 1, 1), ("idiot moron " * 3, None, "a", 1, 1), (long, 4, None, None, None),
        (long, 4, None, None, None), ("日本語 ☃ \U00012345 á", 5, "a", None, 2), (None, None, None, None, None),
    ]
    frame = session.createDataFrame(rows, schema)
    got = toxicity.toxicity_report(frame, labels).collect()
    assert len(got) == len(rows)
    empty = {r.score for r in got if r.doc_id in (1, 2)}
    assert len(empty) == 1 and len({r.score for r in got if r.doc_id == 4}) == 1
    assert {r.held_out for r in got if r.doc_id is None} == {False}
    assert toxicity.toxicity_report(frame.limit(0), labels).collect() == []
    assert {r.score for r in toxicity.toxicity_report(frame, labels.limit(0)).collect()} == {0.5}
