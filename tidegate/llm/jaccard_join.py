"""Similarity join of texts by the Jaccard coefficient of their five-word shingles.

1. Every text becomes its set of distinct shingle hashes. Texts with equal sets form a
   class; only classes go on, with the number of their copies.
2. MinHash values are drawn for each class and put in bands of eight. Classes that share a
   band are joined to the band's smallest member: one edge per member, never all pairs. Eight
   values a band keep texts apart that only share a passage; 64 bands miss a pair at exactly
   0.8 with a probability of 8e-6, and one at 0.85 with 2e-9.
3. Components of those edges hold the candidates. Within a component MinHash values are
   compared 32 at a time, and a pair is dropped as soon as the posterior probability that it
   reaches the threshold falls below ``TOLERANCE``; the rest is verified on the whole sets.
   A large component is cut into blocks, and every pair of blocks is a task of its own that
   returns at most one row per text: its link count and an edge that keeps what the links
   connect connected.
4. Components of the verified links are the groups.
"""

from __future__ import annotations

from functools import lru_cache
from math import ceil, lgamma, exp, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.components import components
from tidegate.llm.lexemes import (
    distinct_parts, mixed, shingle_hashes, text_slices, words,
)
from tidegate.llm.shared import col, written

THRESHOLD = 0.8
BANDS, ROWS = 64, 8
STEP = 32  # MinHash values compared before a pair is judged again
ROUNDS = 8
TOLERANCE = 1e-9  # a pair is dropped when it reaches the threshold with less probability
BLOCK = 512  # texts of a block
SIEVE_BITS = 1 << 26
PACK_TEXTS = 256  # small components worked on together, in texts

_SALTS = np.random.default_rng(20250).integers(0, 2**32, (2, BANDS * ROWS), dtype=np.uint64)
_FACTORS, _SHIFTS = (_SALTS[0] | 1).astype(np.uint32), _SALTS[1].astype(np.uint32)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    runs = words(data, offsets)
    return distinct_parts(*shingle_hashes(runs.hashes(), runs.counts))


def min_hashes(flat: np.ndarray, counts: np.ndarray, n: int = BANDS * ROWS) -> np.ndarray:
    """``n`` MinHash values of each non-empty set; the sets lie end to end."""
    out = np.empty((len(counts), n), np.uint32)
    points = (flat >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum(counts) - counts
    a = 0
    while a < len(counts):
        b = int(np.searchsorted(starts, starts[a] + 32_768, "right"))
        b = min(max(b, a + 1), len(counts))
        part = points[starts[a] : starts[b - 1] + counts[b - 1]]
        marks = starts[a:b] - starts[a]
        for k in range(n):
            out[a:b, k] = np.minimum.reduceat(part * _FACTORS[k] + _SHIFTS[k], marks)
        a = b
    return out


def sketches(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Per document ``doc_id``, ``text_hash``, ``key`` of its shingle set, ``bands``."""
    source = docs.select(
        col(doc_id).alias("doc_id"),
        F.xxhash64(F.coalesce(col(text), F.lit(""))).alias("text_hash"),
        col(text).alias("text"),
    )
    schema = source.select("doc_id", "text_hash").schema.add("key", "long").add("bands", "binary")

    def run(batches):
        for batch in batches:
            for a, b, data, offsets in text_slices(batch.column(2)):
                sets = shingle_sets(data, offsets)
                counts = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(counts)
                flat = np.concatenate([sets[i] for i in full]) if len(full) else np.empty(0, np.uint64)
                keys = np.zeros(len(sets), np.uint64)
                bands = [b""] * len(sets)
                if len(full):
                    sizes = counts[full]
                    starts = np.cumsum(sizes) - sizes
                    sums = np.add.reduceat(mixed(flat), starts)
                    keys[full] = mixed(sums ^ mixed(sizes.astype(np.uint64)))
                    values = min_hashes(flat, sizes).astype(np.uint64)
                    hashes = np.zeros((len(full), BANDS), np.uint64)
                    for k in range(ROWS):
                        hashes = mixed(hashes ^ values[:, k::ROWS])
                    hashes = mixed(hashes + np.arange(BANDS, dtype=np.uint64)).astype("<u8")
                    for i, row in zip(full.tolist(), hashes):
                        bands[i] = row.tobytes()
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(keys.view(np.int64)), pa.array(bands, pa.binary())],
                    names=schema.names,
                )

    return source.mapInArrow(run, schema)


def band_rows(classes: DataFrame) -> DataFrame:
    """``band``, ``key``: one row per class and band."""

    def run(batches):
        for batch in batches:
            raw = batch.column("bands").cast(pa.large_binary())
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            flat = np.frombuffer(b"".join(raw.to_pylist()), "<i8")
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat), pa.array(np.repeat(keys, BANDS))], names=["band", "key"]
            )

    return classes.mapInArrow(run, "band long, key long")


@lru_cache(maxsize=4)
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> np.ndarray:
    """After each round, the fewest equal MinHash values a pair may have to be kept.

    With a uniform prior the posterior after m of n matches is Beta(m + 1, n - m + 1); its
    mass above the threshold is the chance of at most m successes in n + 1 draws at it.
    """
    out = []
    for n in range(STEP, STEP * ROUNDS + 1, STEP):
        mass, m = 0.0, 0
        while m <= n:
            mass += exp(
                lgamma(n + 2) - lgamma(m + 1) - lgamma(n - m + 2)
                + m * log(threshold) + (n + 1 - m) * log(1 - threshold)
            )
            if mass >= tolerance:
                break
            m += 1
        out.append(m)
    return np.array(out)


def candidates(left: np.ndarray, right: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two MinHash tables that are not dropped in any round."""
    least = least_matches()
    equal = np.zeros((len(left), len(right)), np.int32)
    for k in range(STEP):
        equal += left[:, k][:, None] == right[:, k][None, :]
    alive = equal >= least[0]
    if same:
        alive &= np.triu(np.ones_like(alive), 1)
    i, j = np.nonzero(alive)
    matches = equal[i, j]
    for turn in range(1, ROUNDS):
        if not len(i):
            break
        for a in range(0, len(i), 65_536):
            part = slice(a, a + 65_536)
            span = slice(turn * STEP, (turn + 1) * STEP)
            matches[part] += (left[i[part], span] == right[j[part], span]).sum(1)
        stay = matches >= least[turn]
        i, j, matches = i[stay], j[stay], matches[stay]
    return i, j


def shared_counts(left: list[np.ndarray], right: list[np.ndarray], i: np.ndarray, j: np.ndarray):
    """Sizes of the intersections of pairs of sets, by products of incidence tables."""
    rows_l, at_l = np.unique(i, return_inverse=True)
    rows_r, at_r = np.unique(j, return_inverse=True)
    side_l = [left[r] for r in rows_l.tolist()]
    side_r = [right[r] for r in rows_r.tolist()]
    values_l, values_r = np.concatenate(side_l), np.concatenate(side_r)
    common = np.intersect1d(values_l, values_r)
    total = np.zeros((len(rows_l), len(rows_r)), np.float32)
    places = []
    for side, values in ((side_l, values_l), (side_r, values_r)):
        owner = np.repeat(np.arange(len(side)), [len(s) for s in side])
        at = np.minimum(np.searchsorted(common, values), max(len(common) - 1, 0))
        hit = common[at] == values if len(common) else np.zeros(len(values), bool)
        order = np.argsort(at[hit], kind="stable")
        places.append((at[hit][order], owner[hit][order]))
    for a in range(0, len(common), 4096):
        tables = []
        for (at, owner), n in zip(places, total.shape):
            lo, hi = np.searchsorted(at, (a, a + 4096))
            one = np.zeros((n, min(4096, len(common) - a)), np.float32)
            one[owner[lo:hi], at[lo:hi] - a] = 1
            tables.append(one)
        total += tables[0] @ tables[1].T
    return total[at_l, at_r].astype(np.int64)


def linked(sets, hashes, left: slice, right: slice, threshold: float = THRESHOLD):
    """Pairs (i, j), i in the left and j in the right run of sets, that reach the threshold.

    The two runs are the same or apart; in one run every pair is given once.
    """
    i, j = candidates(hashes[left], hashes[right], left == right)
    if not len(i):
        return i, j
    i, j = i + left.start, j + right.start
    shared = shared_counts(sets, sets, i, j)
    sizes = np.array([len(s) for s in sets])
    union = sizes[i] + sizes[j] - shared
    # as whole numbers, so that exactly 0.8 counts
    real = shared * 1_000_000 >= round(threshold * 1_000_000) * union
    return i[real], j[real]


def _sets_of(texts: pd.Series) -> list[np.ndarray]:
    out = []
    for _, _, data, offsets in text_slices(pa.array(texts, pa.large_string())):
        out += shingle_sets(data, offsets)
    return out


def _verify(group: pd.DataFrame) -> pd.DataFrame:
    """Links inside some components, or between two blocks of one.

    Gives for every text the copies it is linked to, and an edge to the first text that chains
    of the links found here connect it to.
    """
    group = group.sort_values(["root", "side"]).reset_index(drop=True)
    keys, copies = group["key"].to_numpy(), group["copies"].to_numpy()
    sets = _sets_of(group["text"])
    hashes = min_hashes(np.concatenate(sets), np.array([len(x) for x in sets]), STEP * ROUNDS)
    links = np.zeros(len(keys), np.int64)
    first = np.arange(len(keys))
    roots, sides = group["root"].to_numpy(), group["side"].to_numpy()
    starts = np.flatnonzero(np.append(True, roots[1:] != roots[:-1]))
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)]):
        cut = a + int(np.searchsorted(sides[a:b], 1))
        if group["mate"].iat[a] == group["block"].iat[a]:  # a block with itself
            i, j = linked(sets, hashes, slice(a, b), slice(a, b))
        elif cut in (a, b):
            continue
        else:
            i, j = linked(sets, hashes, slice(a, cut), slice(cut, b))
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        before = None
        while before is None or (first != before).any():
            before = first.copy()
            least = np.minimum(first[i], first[j])
            np.minimum.at(first, i, least)
            np.minimum.at(first, j, least)
            first[a:b] = first[first[a:b]]
    return pd.DataFrame({"key": keys, "links": links, "near": keys[first]})


def similarity_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text_hash``, ``key``, ``class_id``, ``n_copies``,
    ``n_links``.

    ``key`` names the text's shingle set, ``class_id`` is the smallest id of all documents
    that chains of links connect (links: coefficient 0.8 or more), ``n_copies`` counts the
    rows with an equal set (itself included) and ``n_links`` the other rows it is linked to.

    A null text counts as empty. Texts without a word have equal (empty) sets and form a
    class; a text of one to four words has all its words as its only shingle. Repeated rows
    count as copies, a null id is never the class id of a class that has another, and an
    empty table gives no rows. Other columns are ignored.
    """
    rows = written(sketches(docs, doc_id, text), "sketches")
    members = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")
    )
    members = written(
        members.select("key", "copies", F.col("first.doc_id").alias("first_id"), F.col("first.text_hash").alias("first_text")),
        "classes",
    )
    shown = rows.where(F.length("bands") > 0).dropDuplicates(["key"]).select("key", "bands")
    banded = band_rows(shown)
    shared = (
        banded.groupBy("band").agg(F.min("key").alias("a"), F.max("key").alias("last"))
        .where(F.col("a") != F.col("last")).select("band", "a")
    )
    edges = banded.join(shared, "band").select("a", F.col("key").alias("b"))
    groups = components(edges)
    blocks = written(_blocks(groups, members), "blocks")
    found = _links(blocks, docs, doc_id, text)
    final = components(found.select(F.col("key").alias("a"), F.col("near").alias("b")))
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    named = (
        members.join(final, F.col("key") == F.col("node"), "left")
        .select("key", "copies", "first_id", F.coalesce("root", "key").alias("root"))
    )
    ids = named.groupBy("root").agg(F.min("first_id").alias("class_id"))
    named = written(
        named.join(ids, "root").join(links, "key", "left").select(
            "key", "class_id", F.col("copies").alias("n_copies"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "named",
    )
    return rows.select("doc_id", "text_hash", "key").join(named, "key").select(
        "doc_id", "text_hash", "key", "class_id", "n_copies", "n_links"
    )


def _blocks(groups: DataFrame, members: DataFrame) -> DataFrame:
    """Where each candidate's text is needed: ``pack`` is a unit of work.

    Small components share packs. A component of several blocks has a pack for each pair of
    blocks; a text then goes to as many packs as its component has blocks.
    """
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    total = groups.count()
    packs = max(1, ceil(total / PACK_TEXTS))
    placed = (
        groups.join(sizes, "root")
        .withColumn("n_blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("node", F.lit(7)), F.col("n_blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .withColumn("block", F.least("own", "other"))
        .withColumn("mate", F.greatest("own", "other"))
    )
    small = F.pmod(F.xxhash64("root"), F.lit(packs)).cast("string")
    large = F.concat_ws(":", "root", "block", "mate")
    return placed.join(members, F.col("node") == F.col("key")).select(
        "key", "copies", "first_id", "first_text", "root", "block", "mate",
        (F.col("own") == F.col("mate")).cast("int").alias("side"),
        F.when(F.col("n_blocks") == 1, small).otherwise(large).alias("pack"),
    )


def _links(blocks: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Verified links per class: ``key``, ``links``, ``near``; the texts are read again."""
    texts = docs.select(
        F.coalesce(col(doc_id), F.lit(0)).alias("first_id"),  # the text tells the rest
        F.xxhash64(F.coalesce(col(text), F.lit(""))).alias("first_text"),
        col(text).alias("text"),
    )
    blocks = blocks.withColumn("first_id", F.coalesce("first_id", F.lit(0)))
    texts = _sifted(texts, blocks).dropDuplicates(["first_id", "first_text"])
    held = blocks.join(texts, ["first_id", "first_text"])
    work = held.select("key", "copies", "root", "block", "mate", "side", "text", "pack")
    return written(
        work.groupBy("pack").applyInPandas(_packed, "key long, links long, near long"), "links"
    )


def _sifted(texts: DataFrame, blocks: DataFrame) -> DataFrame:
    """The texts whose hash bit is set by some wanted text, so that few others are shuffled.

    The bits have a fixed size (8 MB); when a corpus fills them, more pass, none are lost.
    """
    slot = F.pmod(F.xxhash64("first_id", "first_text"), F.lit(SIEVE_BITS)).alias("slot")
    parts = (
        blocks.select(slot).groupBy(F.bitmap_bucket_number(F.col("slot") + 1).alias("at"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("slot") + 1)).alias("bits"))
    )
    sieve = np.zeros(SIEVE_BITS // 8, np.uint8)
    for at, bits in parts.collect():
        sieve[(at - 1) * 4096 : at * 4096] = np.frombuffer(bits, np.uint8)
    shared, names = texts.sparkSession.sparkContext.broadcast(sieve), texts.columns

    def run(batches):
        for batch in batches:
            slots = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            kept = (shared.value[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1
            yield batch.filter(pa.array(kept.astype(bool))).select(names)

    return texts.select("*", slot).mapInArrow(run, texts.schema)


def _packed(group: pd.DataFrame) -> pd.DataFrame:
    return _verify(group.drop(columns="pack"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group the row with the smallest id
    stays, of repeated rows one."""
    names = docs.columns
    plain = docs.select(*[col(c).alias(f"c{i}") for i, c in enumerate(names)])
    own_id, own_text = f"c{names.index(doc_id)}", f"c{names.index(text)}"
    classes = similarity_classes(plain, own_id, own_text)
    first = (
        classes.groupBy(F.coalesce("class_id", F.lit(0)).alias("_c"), F.when(F.col("class_id").isNull(), F.col("key")).alias("_k"))
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("text_hash").alias("t"))).alias("f"))
        .select(F.col("f.d").alias("_d"), F.col("f.t").alias("_t"))
    )
    found = plain.withColumn("_x", F.xxhash64(F.coalesce(F.col(own_text), F.lit("")))).join(
        first, F.col(own_id).eqNullSafe(F.col("_d")) & (F.col("_x") == F.col("_t"))
    )
    return found.dropDuplicates(["_d", "_t"]).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
