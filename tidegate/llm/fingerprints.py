"""Document fingerprints: the smallest hashes of a text's five-word shingles.

A fingerprint holds the ``SIZE`` smallest distinct shingle hashes (48 bits each, ascending,
base64). Fingerprints of parts merge into that of the whole; two of them estimate the
resemblance (Jaccard) and containment of shingle sets, one the number of distinct shingles.
A fingerprint with fewer than ``SIZE`` hashes holds all of them, and estimates become exact.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.lexemes import distinct_parts, shingle_hashes, text_slices, words
from tidegate.llm.shared import col, tasks

SIZE = 128
_DROP = np.uint64(16)
_SCALE = float(1 << 48)


def sketches(column: pa.Array) -> list[np.ndarray]:
    """The smallest shingle hashes of each text."""
    out = []
    for _, _, data, offsets in text_slices(column):
        runs = words(data, offsets)
        hashes, counts = shingle_hashes(runs.hashes(), runs.counts)
        out += [part[:SIZE] for part in distinct_parts(hashes >> _DROP, counts)]
    return out


def to_text(sketch: np.ndarray) -> str:
    raw = sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]
    return base64.b64encode(raw.tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 2:] = raw
    return wide.view(">u8").ravel().astype(np.uint64)


def merge(*sketches_: np.ndarray) -> np.ndarray:
    """The fingerprint of the parts together."""
    return np.unique(np.concatenate(sketches_))[:SIZE]


def _overlap(a: np.ndarray, b: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Hashes in both, and in either, among the smallest that both fingerprints know."""
    both = np.sort(np.concatenate([a, b]))
    again = np.append(both[1:] == both[:-1], False)
    union = both[np.insert(~again[:-1], 0, True)] if len(both) else both
    if len(a) >= SIZE or len(b) >= SIZE:
        union = union[:SIZE]
    shared = int((both[again] <= union[-1]).sum()) if len(union) else 0
    return shared, len(union), union


def resemblance(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard coefficient; two empty texts are alike."""
    shared, union, _ = _overlap(a, b)
    return shared / union if union else 1.0


def distinct_count(sketch: np.ndarray) -> float:
    """Estimated number of distinct shingles."""
    if len(sketch) < SIZE:
        return float(len(sketch))
    return (SIZE - 1) / ((float(sketch[SIZE - 1]) + 1) / _SCALE)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of a's shingles that b has too; nothing is contained in anything."""
    if not len(a):
        return 1.0
    shared, union, known = _overlap(a, b)
    if len(a) < SIZE and len(b) < SIZE:
        return shared / len(a)
    inside = int((a <= known[-1]).sum())
    return shared / inside if inside else 0.0


def with_fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """All columns but the text, with the text's fingerprint. A null text counts as empty."""
    kept = [c for c in docs.columns if c not in (text, name)]
    source = docs.select(*[col(c) for c in kept], col(text).alias("_text"))
    schema = source.drop("_text").schema.add(name, "string")

    def run(batches):
        for batch in batches:
            made = [to_text(s) for s in sketches(batch.column(batch.num_columns - 1))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made, pa.string())], names=schema.names)

    return source.mapInArrow(run, schema)


def merged_fingerprints(prints: DataFrame, key: str, name: str = "fingerprint") -> DataFrame:
    """``key``, ``fingerprint``: the fingerprint of all rows of a key together.

    Each task first merges what it has read, so a key sends one row per task at most.
    """

    def run(batches):
        held: dict = {}
        for batch in batches:
            for k, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if p is not None:
                    new = from_text(p)
                    held[k] = merge(held[k], new) if k in held else new
            if len(held) > 20_000:
                yield packed(held)
                held = {}
        if held:
            yield packed(held)

    schema = prints.select(col(key).alias("key")).schema.add("fingerprint", "string")

    def packed(held):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), arrow_kind), pa.array([to_text(s) for s in held.values()], pa.string())],
            names=["key", "fingerprint"],
        )

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_kind = to_arrow_type(schema["key"].dataType)
    source = prints.select(col(key).alias("key"), col(name).alias("fingerprint"))
    partial = source.mapInArrow(run, schema)
    return partial.repartition(tasks(prints), "key").mapInArrow(run, schema)


def with_neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows in runs of descending ids: ``part``, ``ghost``, ``doc_id``, ``text``.

    Ids are cut into parts at quantiles. A part is read as a whole by one task, and the row
    that follows its last one (the first row of the next part, the very first after the very
    last) goes along as a ghost. Texts are shuffled once. A null id comes after all others;
    rows with one id are ordered by a hash of their texts.
    """
    source = docs.select(
        col(doc_id).alias("doc_id"),
        F.coalesce(col(doc_id), F.lit(-(2**63))).alias("place"),
        F.coalesce(col(text), F.lit("")).alias("text"),
    )
    n = tasks(docs)
    shares = [(i + 1) / (2 * n) for i in range(2 * n - 1)]
    cuts = source.agg(F.percentile_approx("place", shares, 100_000).alias("cuts")).first().cuts
    cuts = sorted(set(cuts or []))
    cut_list = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    source = source.withColumn("part", F.size(F.filter(cut_list, lambda c: c < F.col("place"))))
    tops = {r.part: r.top for r in source.groupBy("part").agg(F.max("place").alias("top")).collect()}
    above = sorted(tops)  # at most 2n of them
    ghosts = {}
    for low, high in zip(above, above[1:]):
        ghosts.setdefault(tops[low], []).append(high)
    if above:
        ghosts.setdefault(tops[above[-1]], []).append(above[0])
    goes = F.array(F.struct(F.col("part"), F.lit(False).alias("ghost")))
    if ghosts:
        pairs = [(F.lit(place).cast("long"), F.array(*map(F.lit, parts))) for place, parts in ghosts.items()]
        extra = F.element_at(F.create_map(*[x for pair in pairs for x in pair]), F.col("place"))
        extra = F.coalesce(extra, F.array().cast("array<int>"))
        ghost = F.transform(extra, lambda p: F.struct(p.alias("part"), F.lit(True).alias("ghost")))
        goes = F.concat(goes, ghost)
    dealt = source.withColumn("to", F.explode(goes)).select(
        F.col("to.part").alias("part"), F.col("to.ghost").alias("ghost"), "doc_id", "place", "text"
    )
    return (
        dealt.repartition(n, "part")
        .sortWithinPartitions("part", "ghost", F.desc("place"), F.xxhash64("text"))
        .select("part", "ghost", "doc_id", "text")
    )


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the first part of another, as long at most."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``, ``n_shingles``. The next document is the one with the next
    smaller id, after the last the first. A null text counts as empty, an empty text has an
    empty fingerprint, and two empty ones are alike. A single row follows itself; repeated
    ids follow one another in one task; an empty table gives no rows.
    """
    schema = docs.select(col(doc_id).alias("doc_id")).schema
    for name, kind in (
        ("n_chars", "long"), ("edited_sha256", "string"), ("fingerprint", "string"),
        ("edited_fingerprint", "string"), ("near_edited", "double"), ("near_next", "double"),
        ("n_shingles", "double"),
    ):
        schema = schema.add(name, kind)

    def run(batches):
        held = None
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                if held is not None:
                    part = pa.Table.from_batches([held, part]).combine_chunks().to_batches()[0]
                held = part.slice(part.num_rows - 1)
                if part.num_rows > 1:
                    yield judged(part)

    def judged(part):
        ghost = part.column(1).to_pylist()
        texts = part.column(3).to_pylist()
        own = [i for i in range(part.num_rows - 1) if not ghost[i]]
        prints = sketches(part.column(3))
        changed = [edited(texts[i], texts[i + 1]) for i in own]
        changed_prints = sketches(pa.array(changed, pa.large_string()))
        return pa.RecordBatch.from_arrays(
            [
                part.column(2).take(pa.array(own, pa.int64())),
                pa.array([len(texts[i]) for i in own], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
                pa.array([to_text(prints[i]) for i in own], pa.string()),
                pa.array([to_text(p) for p in changed_prints], pa.string()),
                pa.array([resemblance(prints[i], p) for i, p in zip(own, changed_prints)], pa.float64()),
                pa.array([resemblance(prints[i], prints[i + 1]) for i in own], pa.float64()),
                pa.array([distinct_count(prints[i]) for i in own], pa.float64()),
            ],
            names=schema.names,
        )

    return with_neighbours(docs, doc_id, text).mapInArrow(run, schema)
