"""Quality rules: counts of a text, and its perplexity under a corpus model.

The model is a modified Kneser-Ney model of order 5 over the bytes of all texts (equal texts count
as one). No n-gram is dropped: all are counted by Spark and stored as sorted arrays, one row for
each pair of bytes that ends an n-gram's context. Whatever the smoothing needs of an n-gram, its
contexts and its shorter ends down to three bytes, lies in its own row, so every n-gram gets its
final probability where it is stored; pairs and single bytes are tables of fixed size.

N-grams with at least one of SHARE occurrences are fewer than SHARE at any size; they are broadcast
as hash arrays and added up where the text is read. The others are joined, and none of them is
frequent enough to be a hot key. Texts are counted in one pass and scored in one.

A text has two perplexities, by bytes and by words, and is judged within its language: it is
rejected if the logarithm of one lies outside a band around the quartiles of its language's texts.
A mean over few words varies with the root of their number, so the band of a short text is wider.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.lexemes import Spans, mixed, text_slices, words
from tidegate.llm.shared import col, tasks, written

ORDER = 5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MEASURES = ("log_perplexity", "log_word_perplexity")
# quartile distances accepted below the lower and above the upper quartile, and nats in any case
REACH = {"log_perplexity": (8.0, 1.8, 0.02), "log_word_perplexity": (3.0, 2.5, 0.1)}
STEADY_WORDS = 250  # below so many words a text's mean varies more, and the band widens
SYMBOLS = b"#*$%&|<>"
SHARE = 2_000_000  # n-grams with at least one of so many occurrences are broadcast
KEPT_GRAMS = 1_000_000  # distinct n-grams a task gathers before it hands them on
SIEVE = 20  # bits of a text's number in the bit set of repeated texts; a word has 64 bits
SLICE = 1 << 19  # bytes of text worked on at once
NEWLINE = 10

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def gram_codes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The code of the n-gram ending at each byte; a text begins after line ends."""
    code = data.astype(np.int64)
    starts = offsets[:-1][np.diff(offsets) > 0]
    before = data
    for back in range(1, ORDER):
        shifted = np.empty_like(before)
        shifted[1:] = before[:-1]
        shifted[starts] = NEWLINE
        code += shifted.astype(np.int64) << (8 * back)
        before = shifted
    return code


def text_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each text."""
    n = len(offsets) - 1

    def per_text(flags):
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[offsets[1:]] - total[offsets[:-1]]

    runs = words(data, offsets)
    hashes, owner = runs.hashes(), runs.owner()
    inside = np.zeros(len(data) + 1, np.int64)
    np.add.at(inside, runs.start, 1)
    np.add.at(inside, runs.end, -1)
    inside = np.cumsum(inside[:-1]) > 0
    # lines with a word that equal an earlier line of their text
    lines = Spans(data, offsets, data != 10)
    holds = np.searchsorted(runs.start, lines.end) > np.searchsorted(runs.start, lines.start)
    whose = lines.owner()[holds]
    n_lines = np.bincount(whose, minlength=n)
    # the distinct lines of each text, found on keys that hold the text's number
    keyed = mixed(lines.hashes()[holds] + mixed(whose.astype(np.uint64)))
    _, first = np.unique(keyed, return_index=True)
    n_distinct = np.bincount(whose[first], minlength=n)
    # words inside any 3-word window that is found twice in its text
    repeat = np.zeros(len(hashes), bool)
    if len(hashes) > 2:
        window = np.flatnonzero(owner[2:] == owner[:-2])
        h = hashes
        key = mixed(mixed(mixed(h[window] + owner[window].astype(np.uint64)) + h[window + 1]) + h[window + 2])
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(window), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        at = window[twice]
        for i in range(3):
            repeat[at + i] = True
    return {
        "n_words": runs.counts.astype(np.int64),
        "word_chars": per_text(inside & ((data & 0xC0) != 0x80)),
        "n_symbols": per_text(_IS_SYMBOL[data]),
        "n_dup_lines": n_lines - n_distinct,
        "n_repeat_words": np.bincount(owner[repeat], minlength=n).astype(np.int64),
    }


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _repeated(docs: DataFrame) -> np.ndarray:
    """A bit for every text that occurs more than once (and for texts that share its bit)."""
    twice = docs.groupBy("_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    place = F.shiftrightunsigned("_key", 64 - SIEVE).alias("at")
    found = twice.groupBy(place).agg(F.bit_or(F.expr("shiftleft(1L, cast(_key & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(1 << SIEVE, np.uint64)
    out[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def _has_bit(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    keys = keys.view(np.uint64)
    return (bits[keys >> np.uint64(64 - SIEVE)] >> (keys & np.uint64(63)) & np.uint64(1)).astype(bool)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes = np.concatenate([c for c, _ in parts])
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], np.concatenate([n for _, n in parts])[order]
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))) if len(codes) else order
    return codes[first], np.add.reduceat(counts, first) if len(codes) else counts


def count_grams(docs: DataFrame, text: str = "text") -> DataFrame:
    """How often each n-gram occurs in the different texts: ``g``, ``n``."""
    keyed = docs.select(col(text).alias("text"), text_key(col(text)).alias("_key"))
    bits = docs.sparkSession.sparkContext.broadcast(_repeated(keyed.select("_key")))

    def again(batches):
        for batch in batches:
            hit = _has_bit(bits.value, batch.column(1).to_numpy())
            yield from [batch.filter(pa.array(hit))] if hit.any() else []

    def count(batches, alone):
        parts, size = [], 0
        for batch in batches:
            if alone:
                batch = batch.filter(pa.array(~_has_bit(bits.value, batch.column(1).to_numpy())))
            for _, _, data, offsets in text_slices(batch.column(0), SLICE):
                found = np.unique(gram_codes(data, offsets), return_counts=True)
                parts.append(found)
                size += len(found[0])
                if size > KEPT_GRAMS:
                    parts = [_added(parts)]
                    size = len(parts[0][0])
                    if 2 * size > KEPT_GRAMS:
                        yield _gram_batch(*parts[0])
                        parts, size = [], 0
        if parts:
            yield _gram_batch(*_added(parts))

    # texts that occur once are counted where they are read, the others once each
    different = keyed.mapInArrow(again, "text string, _key long").groupBy("_key").agg(F.min("text").alias("text"))
    grams = keyed.mapInArrow(lambda batches: count(batches, True), "g long, n long").unionByName(
        different.select("text").mapInArrow(lambda batches: count(batches, False), "g long, n long")
    )
    return grams.groupBy("g").agg(F.sum("n").alias("n"))


def _gram_batch(codes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts.astype(np.int64))], ["g", "n"])


def stored_arrays(grams: DataFrame) -> DataFrame:
    """The n-grams as sorted arrays ``keys`` and ``counts``, a row for each pair of bytes before
    the last one (``pair``)."""

    def pack(batches):
        now, keys, counts = None, [], []

        def row():
            one = [pa.array([now]), pa.array([np.concatenate(keys)]), pa.array([np.concatenate(counts)])]
            return pa.RecordBatch.from_arrays(one, ["pair", "keys", "counts"])

        for batch in batches:
            pair, g, n = (c.to_numpy() for c in batch.columns)
            cuts = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1]))) if len(pair) else []
            for a, b in zip(cuts, [*cuts[1:], len(pair)]):
                if now is not None and pair[a] != now:
                    yield row()
                    keys, counts = [], []
                now = int(pair[a])
                keys.append(g[a:b])
                counts.append(n[a:b])
        if now is not None:
            yield row()

    pair = F.shiftright("g", 8).bitwiseAND(0xFFFF).alias("pair")
    spread = grams.select(pair, "g", "n").repartition(tasks(grams), "pair").sortWithinPartitions("pair", "g")
    return spread.mapInArrow(pack, "pair long, keys array<long>, counts array<long>")


def _shorter(codes: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends of n-grams without their first byte, and how many different first bytes each has."""
    return np.unique(codes & ((1 << (8 * order)) - 1), return_counts=True)


def discounts(ones: float, twos: float, threes: float, fours: float) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more, from counts of counts."""
    if min(ones, twos, threes, fours) == 0:  # too regular to estimate: a fixed share
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = ones / (ones + 2 * twos)
    raw = (1 - 2 * y * twos / ones, 2 - 3 * y * threes / twos, 3 - 4 * y * fours / threes)
    return np.array([0.0, *(min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw))])


def chances(codes: np.ndarray, counts: np.ndarray, cut: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Probabilities of the last bytes of n-grams that hold all of their contexts' n-grams."""
    context, at = np.unique(codes >> 8, return_inverse=True)
    spared = cut[np.minimum(counts, 3)]
    total = np.bincount(at, counts, len(context))[at]
    return (counts - spared + np.bincount(at, spared, len(context))[at] * lower) / total


@dataclass
class Smoothing:
    """Discounts of the orders from 3 up, and the probabilities of bytes after one byte."""

    cuts: dict[int, np.ndarray]
    pairs: np.ndarray

    @classmethod
    def of(cls, classes: dict[int, np.ndarray], pairs: np.ndarray) -> "Smoothing":
        """From counts of counts by order, and the numbers of bytes found before each pair."""
        cuts = {order: discounts(*numbers[1:5]) for order, numbers in classes.items()}
        before = (pairs > 0).reshape(256, 256).sum(axis=0)
        single = (before + 1 / 256) / (before.sum() + 1)  # every byte has a chance
        spared = discounts(*[(pairs == i).sum() for i in (1, 2, 3, 4)])[np.minimum(pairs, 3)].reshape(256, 256)
        total = pairs.reshape(256, 256).sum(axis=1, keepdims=True)
        left = np.where(total > 0, spared.sum(axis=1, keepdims=True) / np.maximum(total, 1), 1.0)
        whole = (np.where(total > 0, (pairs.reshape(256, 256) - spared) / np.maximum(total, 1), 0) + left * single).ravel()
        return cls(cuts, whole)

    def costs(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Minus the logarithm of each n-gram's probability; ``codes`` are sorted."""
        tables = {ORDER: (codes, counts)}
        for order in range(ORDER - 1, 2, -1):
            tables[order] = _shorter(tables[order + 1][0], order)
        below, ends = self.pairs, None
        for order in range(3, ORDER + 1):
            codes, counts = tables[order]
            short = codes & ((1 << (8 * (order - 1))) - 1)
            lower = below[short] if ends is None else below[np.searchsorted(ends, short)]
            below, ends = chances(codes, counts, self.cuts[order], lower), codes
        return -np.log(below)


def _row_arrays(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(c)[i].values.to_numpy() for c in (1, 2))


def smoothing(arrays: DataFrame) -> Smoothing:
    """Counts of counts and pairs, added up by Spark to tables of fixed size."""

    def run(batches):
        classes = {order: np.zeros(5, np.int64) for order in range(3, ORDER + 1)}
        pairs = np.zeros(65536, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                codes, counts = _row_arrays(batch, i)
                for order in range(ORDER, 2, -1):
                    classes[order] += np.bincount(np.minimum(counts, 5), minlength=6)[:5]
                    codes, counts = _shorter(codes, order - 1)
                pairs[codes] += counts
        used = np.flatnonzero(pairs)
        rows = [(order, k, int(numbers[k])) for order, numbers in classes.items() for k in range(1, 5)]
        rows += [(2, int(at), int(pairs[at])) for at in used]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], ["kind", "at", "n"])

    found = arrays.mapInArrow(run, "kind long, at long, n long").groupBy("kind", "at").agg(F.sum("n").alias("n")).toArrow()
    kind, at, n = (found.column(c).to_numpy() for c in ("kind", "at", "n"))
    classes = {order: np.zeros(5, np.int64) for order in range(3, ORDER + 1)}
    for order, numbers in classes.items():
        numbers[at[kind == order]] = n[kind == order]
    pairs = np.zeros(65536, np.int64)
    pairs[at[kind == 2]] = n[kind == 2]
    return Smoothing.of(classes, pairs)


def fit(docs: DataFrame, text: str = "text") -> DataFrame:
    """The model of all texts: ``g``, ``n``, ``value`` (minus the logarithm of its probability)
    of every n-gram they have, and whether it is ``common``."""
    arrays = written(stored_arrays(count_grams(docs, text)), "grams")
    shared = docs.sparkSession.sparkContext.broadcast(smoothing(arrays))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                codes, counts = _row_arrays(batch, i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes), pa.array(counts), pa.array(shared.value.costs(codes, counts))], ["g", "n", "value"]
                )

    values = arrays.mapInArrow(run, "g long, n long, value double")
    total = arrays.select(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    return written(values.withColumn("common", F.col("n") * SHARE >= total), "values")


class HashArrays:
    """Values by key: keys sorted by their hash, and where each run of top bits begins."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        hashes = mixed(keys.view(np.uint64))
        order = np.argsort(hashes)
        self.bits = max(int(len(keys)).bit_length() + 1, 4)
        tops = (hashes[order] >> np.uint64(64 - self.bits)).astype(np.int64)
        self.start = np.searchsorted(tops, np.arange((1 << self.bits) + 1)).astype(np.int32)
        self.keys, self.values = keys[order], values[order]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, 0 where the key is unknown, and whether it is known."""
        top = (mixed(keys.view(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)
        place, end = self.start[top], self.start[top + 1]
        out, known = np.zeros(len(keys)), np.zeros(len(keys), bool)
        open_ = np.flatnonzero(place < end)
        while len(open_):
            at = place[open_]
            hit = self.keys[at] == keys[open_]
            out[open_[hit]] = self.values[at[hit]]
            known[open_[hit]] = True
            open_ = open_[~hit]
            place[open_] += 1
            open_ = open_[place[open_] < end[open_]]
        return out, known


def _common(values: DataFrame) -> HashArrays:
    found = values.where("common").select("g", "value").toArrow()
    return HashArrays(found.column("g").to_numpy(), found.column("value").to_numpy())


def score(docs: DataFrame, values: DataFrame, text: str = "text") -> DataFrame:
    """All columns but the text, with the base counts, ``base_failed`` and the two perplexities'
    logarithms, the mean cost of a byte and of a word (null for a text without words)."""
    made = {*COUNTS, *MEASURES, "base_failed"}
    source = docs.select(*[col(c) for c in docs.columns if c not in made and c != text], col(text).alias("_text"))
    schema = source.drop("_text").schema
    names = [*schema.names, *COUNTS, "base_failed"]
    for name in COUNTS:
        schema = schema.add(name, "long")
    schema = schema.add("base_failed", "boolean").add("_cost", "double").add("_size", "long").add("_rare", T.ArrayType(T.LongType()))
    near = docs.sparkSession.sparkContext.broadcast(_common(values))

    def run(batches):
        for batch in batches:
            for a, b, data, offsets in text_slices(batch.column(batch.num_columns - 1), SLICE):
                counts = text_counts(data, offsets)
                codes = gram_codes(data, offsets)
                cost, known = near.value.find(codes)
                sums = np.concatenate(([0.0], np.cumsum(cost)))
                rare = np.concatenate(([0], np.cumsum(~known)))[offsets].astype(np.int32)
                failed = (counts["n_words"] < MIN_WORDS) | (
                    100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.slice(a, b - a).columns[:-1], *[pa.array(counts[c]) for c in COUNTS], pa.array(failed),
                        pa.array(sums[offsets[1:]] - sums[offsets[:-1]]), pa.array(np.diff(offsets)),
                        pa.ListArray.from_arrays(pa.array(rare), pa.array(codes[~known])),
                    ],
                    names=schema.names,
                )

    rows = written(source.mapInArrow(run, schema).withColumn("_row", F.monotonically_increasing_id()), "scoring")
    rare = rows.select("_row", F.explode("_rare").alias("g")).join(values.where("NOT common").select("g", "value"), "g")
    rest = rare.groupBy("_row").agg(F.sum("value").alias("_rest"))
    cost = F.col("_cost") + F.coalesce("_rest", F.lit(0.0))
    return rows.join(rest, "_row", "left").select(
        *[col(c) for c in names],
        F.when(F.col("n_words") > 0, cost / F.col("_size")).alias("log_perplexity"),
        F.when(F.col("n_words") > 0, cost / F.col("n_words")).alias("log_word_perplexity"),
    )


def bands(scored: DataFrame, lang: str = "lang") -> DataFrame:
    """Lowest and highest accepted values for each language, before short texts' bands widen:
    the quartiles of its texts that meet the base rules, and the reach beyond them."""
    quartiles = [F.percentile_approx(m, F.array(F.lit(0.25), F.lit(0.75)), F.lit(10_000)).alias(f"_q_{m}") for m in MEASURES]
    found = scored.where(~F.col("base_failed")).groupBy(col(lang).alias("_band_lang")).agg(*quartiles)
    columns = []
    for m in MEASURES:
        down, up, least = REACH[m]
        low, high = F.col(f"_q_{m}")[0], F.col(f"_q_{m}")[1]
        columns += [
            low.alias(f"_low_{m}"), high.alias(f"_high_{m}"),
            F.greatest(F.lit(least), down * (high - low)).alias(f"_down_{m}"),
            F.greatest(F.lit(least), up * (high - low)).alias(f"_up_{m}"),
        ]
    return found.select("_band_lang", *columns)


def with_verdict(scored: DataFrame, limits: DataFrame, lang: str = "lang") -> DataFrame:
    """Adds ``kept``. Limits are one row per language."""
    limits = written(limits, "bands")
    joined = scored.join(limits, col(lang).eqNullSafe(F.col("_band_lang")), "left")
    short = F.sqrt(F.greatest(F.lit(1.0), STEADY_WORDS / F.greatest("n_words", F.lit(1))))
    inside = F.lit(True)
    for m in MEASURES:
        low = F.col(f"_low_{m}") - F.col(f"_down_{m}") * short
        high = F.col(f"_high_{m}") + F.col(f"_up_{m}") * short
        inside = inside & F.col(m).between(low, high)
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    return joined.withColumn("kept", kept).drop(*limits.columns)


def quality_report(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """All columns but the text, with the counts, ``base_failed``, the logarithms of the two
    perplexities, ``kept``.

    A null text counts as empty and an empty text fails the base rule; a null language is a
    language of its own; repeated rows are judged alike; an empty table gives no rows.
    Columns that have one of the added names are replaced.
    """
    scored = written(score(docs, fit(docs, text), text), "scored")
    return with_verdict(scored, bands(scored, lang), lang)


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows whose text is kept, with the columns of ``docs``.

    A verdict belongs to a text and a language; the rejected ones are taken out by the text's
    64-bit hash, so each text is scored once.
    """
    names = docs.columns
    plain = docs.select(*[col(c).alias(f"c{i}") for i, c in enumerate(names)])
    text, lang = f"c{names.index(text)}", f"c{names.index(lang)}"
    narrow = plain.select(F.col(text), F.col(lang), text_key(F.col(text)).alias("_key"))
    judged = quality_report(narrow, text, lang).where("NOT kept")
    rejected = written(judged.select("_key", F.col(lang).alias("_lang")).distinct(), "rejected")
    keyed = plain.withColumn("_key", text_key(F.col(text)))
    same = (keyed["_key"] == rejected["_key"]) & keyed[lang].eqNullSafe(rejected["_lang"])
    kept = keyed.join(rejected, same, "left_anti")
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
