"""Toxicity of texts by a subsequence string kernel and a support vector machine.

Two strings are alike as far as they share subsequences of four or five symbols that skip at most
two symbols, each skipped one at the price of a factor DECAY: an insult with inserted characters
still shares most of them. The machine sees a string only through its kernel values with some
landmark strings (Nyström), so its decision on a string is a weighted sum over the string's
subsequences, whose weights fill one table.

Instances are the words of the labelled sentences: letters in one case and without accents,
whatever is put between them inside a word dropped; words of one or two letters in a row are one
instance ("i d i o t"); longer strings are cut into overlapping ones. A label belongs to a whole
text, so the words of a toxic text that carry the label are chosen anew in every round of
training (multiple-instance learning); the clean words that look worst join the landmarks. A text is judged by its strongest words, how strong all
are together, and how many there are, with a logistic function fitted on words the machine had
not seen.

The machine is fitted on a bounded sample of labelled rows (TRAIN_DOCS, TRAIN_CHARS); scoring
reads every text wholly, in one pass without a shuffle.
"""

from __future__ import annotations

import unicodedata
import uuid
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.lexemes import Spans, span_hashes, text_slices
from tidegate.llm.shared import col, written

TRAIN_DOCS = 3000  # expected labelled texts of each class in the sample; never more than twice that
TRAIN_CHARS = 8_000_000  # characters of the sample; texts that would exceed it are left out of it
LANDMARKS = 192  # to begin with, two thirds from toxic and one from clean texts
MORE_LANDMARKS = 64  # clean words added in each round
DECAY = 0.6
LENGTHS = (4, 5)
SKIPS = 2
PIECE, STEP = 24, 12  # longest instance, and the distance of the pieces of a longer string
SHORT = 2  # words of so few letters in a row are one instance
ROUNDS = 3
HARD, EASY = 5_000, 5_000  # clean words of a round: those nearest to insults, and a spread of all
INSERTIONS = 3  # times that a toxic word is shown with a letter put in somewhere
PENALTY = 1e-3
TOXIC_WEIGHT = 3.0  # of a toxic text in the logistic function; they are about a tenth
TELLING = 3.0  # standard errors by which a word has to favour toxic texts to stand for one; at first twice
ACCEPTED = 0.7
FOLDS = 2

EDGE, DIGIT, OTHER, SPACE_MARK, DROPPED = 0, 27, 28, 64, 65
_KNOWN = 0x250


def _symbols() -> np.ndarray:
    """Symbol of every code point below the other scripts: a-z, a digit, a space or nothing."""
    out = np.full(_KNOWN, DROPPED, np.uint8)
    for point in range(_KNOWN):
        base = unicodedata.normalize("NFD", chr(point).casefold())[:1]
        if "a" <= base <= "z":
            out[point] = 1 + ord(base) - ord("a")
        elif chr(point).isalpha():
            out[point] = OTHER + point % 36
        elif chr(point).isdigit():
            out[point] = DIGIT
    out[[0x20, *range(0x09, 0x0E)]] = SPACE_MARK
    return out


SYMBOLS = _symbols()
PATTERNS = [
    steps for n in LENGTHS for steps in product(range(1, SKIPS + 2), repeat=n - 1) if sum(steps) - n + 1 <= SKIPS
]


def symbols(points: np.ndarray) -> np.ndarray:
    """Symbols of code points; other scripts' letters share 36, neighbours apart."""
    out = SYMBOLS[np.minimum(points, _KNOWN - 1)]
    far = points >= _KNOWN
    out[far] = OTHER + points[far] % 36
    # combining marks, general and ideographic punctuation
    mark = (points >= 0x300) & (points < 0x370) | (points >= 0x2000) & (points < 0x2070) | (points >= 0x3000) & (points < 0x3040)
    out[mark] = DROPPED
    return out


@dataclass
class Instances:
    """Strings cut out of texts: symbols, where each starts and ends, and whose it is."""

    letters: np.ndarray
    start: np.ndarray
    end: np.ndarray
    owner: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> "Instances":
        points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
        lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        offsets = lead[offsets]
        found = symbols(points)
        kept = found != DROPPED
        offsets = np.concatenate(([0], np.cumsum(kept)))[offsets]
        found = found[kept]
        spans = Spans(found, offsets, found != SPACE_MARK)
        size, owner = spans.end - spans.start, spans.owner()
        short = size <= SHORT
        fresh = np.ones(len(size), bool)
        fresh[1:] = ~(short[1:] & short[:-1] & (owner[1:] == owner[:-1]))
        first = np.flatnonzero(fresh)
        stop = np.concatenate(([0], np.cumsum(size)))
        start, end = stop[:-1][first], stop[np.append(first[1:], len(size))] if len(first) else stop[:0]
        owner = owner[first]
        # pieces of long strings
        pieces = 1 + np.maximum(0, -(-(end - start - PIECE) // STEP))
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start, end, owner = (np.repeat(x, pieces) for x in (start, end, owner))
        start = start + nth * STEP
        return cls(found[found != SPACE_MARK], start, np.minimum(start + PIECE, end), owner)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.letters, self.start, self.end)

    def take(self, at: np.ndarray) -> "Strings":
        return Strings.of(self.letters, self.start[at], self.end[at])


@dataclass
class Strings:
    """Strings laid end to end, an edge before and after each."""

    flat: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, letters: np.ndarray, start: np.ndarray, end: np.ndarray) -> "Strings":
        size = end - start
        bounds = np.concatenate(([0], np.cumsum(size + 2)))
        flat = np.zeros(bounds[-1], np.int32)
        inner = np.repeat(bounds[:-1] + 1 - (np.cumsum(size) - size), size) + np.arange(size.sum())
        flat[inner] = letters[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        return cls(flat, bounds)

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def part(self, a: int, b: int) -> "Strings":
        return Strings(self.flat[self.bounds[a] : self.bounds[b]], self.bounds[a : b + 1] - self.bounds[a])

    def at(self, rows: np.ndarray) -> "Strings":
        return Strings.of(self.flat, self.bounds[:-1][rows] + 1, self.bounds[1:][rows] - 1)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.bounds))

    def norms(self) -> np.ndarray:
        """The norm of a string of this length whose subsequences all differ."""
        size = np.diff(self.bounds)
        total = np.zeros(len(size))
        for steps in PATTERNS:
            skipped = sum(steps) - len(steps)
            total += DECAY ** (2 * skipped) * np.maximum(size - sum(steps), 0)
        return np.sqrt(np.maximum(total, 1e-9))

    def subsequences(self):
        """For every pattern of steps: places, keys, and the factor of its skipped symbols."""
        room = np.repeat(self.bounds[1:], np.diff(self.bounds)) - 1 - np.arange(len(self.flat))
        for steps in PATTERNS:
            place = np.flatnonzero(room >= sum(steps))
            key = self.flat[place].astype(np.int64)
            at = place
            for step in steps:
                at = at + step
                key = key * 64 + self.flat[at]
            yield steps, place, key, DECAY ** (sum(steps) - len(steps))


@dataclass
class Machine:
    """Weights of subsequences by length (sorted keys), the bias, and the logistic function."""

    keys: dict[int, np.ndarray]
    weights: dict[int, np.ndarray]
    bias: float
    judge: np.ndarray


def _slot(key: np.ndarray) -> np.ndarray:
    """A key's place in a table of 2^24."""
    return (key ^ (key >> 24) * 0x9E3779) & 0xFFFFFF


class Tables:
    """A machine's keys by hashed place, so that almost every lookup ends at an empty one."""

    def __init__(self, machine: Machine):
        self.keys = np.concatenate([machine.keys[n] + (n << 32) for n in LENGTHS])
        self.weights = np.concatenate([machine.weights[n] for n in LENGTHS])
        order = np.argsort(self.keys)
        self.keys, self.weights = self.keys[order], self.weights[order]
        self.filled = np.zeros(1 << 24, bool)
        self.filled[_slot(self.keys & 0xFFFFFFFF)] = True

    def add(self, total: np.ndarray, place: np.ndarray, key: np.ndarray, n: int, factor: float) -> None:
        hit = np.flatnonzero(self.filled[_slot(key)])
        key = key[hit] + (n << 32)
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        same = self.keys[at] == key if len(self.keys) else np.zeros(len(key), bool)
        total[place[hit[same]]] += factor * self.weights[at[same]]


def margins(strings: Strings, tables: Tables, bias: float) -> np.ndarray:
    """The machine's decision on each string: above 0 is an insult."""
    total = np.zeros(len(strings.flat))
    for steps, place, key, factor in strings.subsequences():
        tables.add(total, place, key, len(steps) + 1, factor)
    each = np.concatenate(([0.0], np.cumsum(total)))
    return (each[strings.bounds[1:]] - each[strings.bounds[:-1]]) / strings.norms() + bias


def text_features(owner: np.ndarray, margin: np.ndarray, n: int) -> np.ndarray:
    """For each text: 1, its three largest margins, all margins together, the number of strings."""
    strong = np.maximum(margin + 1, 0)
    out = np.zeros((n, 6))
    out[:, 0] = 1
    out[:, 4] = np.log1p(np.bincount(owner, np.maximum(margin, 0), n))
    out[:, 5] = np.log1p(np.bincount(owner, minlength=n))
    use = np.flatnonzero(strong)
    use = use[np.lexsort((-strong[use], owner[use]))]
    rank = np.arange(len(use)) - np.searchsorted(owner[use], owner[use])
    for k in range(3):
        nth = use[rank == k]
        out[owner[nth], 1 + k] = strong[nth]
    return out


def logistic(features: np.ndarray, judge: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features @ judge, -50, 50)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Newton's method with a ridge on all but the constant; rows of label 1 count TOXIC_WEIGHT."""
    count = np.where(y == 1, TOXIC_WEIGHT, 1.0)
    w = np.zeros(x.shape[1])
    keep = ridge * np.eye(len(w))
    keep[0, 0] = 1e-6
    for _ in range(50):
        p = logistic(x, w)
        curve = (x * (count * p * (1 - p))[:, None]).T @ x + keep
        step = np.linalg.solve(curve, x.T @ (count * (y - p)) - keep @ w)
        w = w + step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared hinge loss in the primal, by Newton steps over the margin's violators."""
    z = np.column_stack([z, np.ones(len(z), z.dtype)]).astype(float)
    w = np.zeros(z.shape[1])
    keep = PENALTY * np.eye(len(w))
    keep[-1, -1] = 1e-9
    active = np.ones(len(z), bool)
    for _ in range(30):
        part = z[active] * weight[active, None]
        w = np.linalg.solve(part.T @ z[active] + keep, part.T @ y[active])
        now = y * (z @ w) < 1
        if (now == active).all():
            break
        active = now
    return w[:-1], w[-1]


class Kernel:
    """Kernel values with the landmarks, and what a sum of them means for a subsequence."""

    def __init__(self, landmarks: Strings):
        entries = {n: [] for n in LENGTHS}
        owner, norms = landmarks.owner(), landmarks.norms()
        for steps, place, key, factor in landmarks.subsequences():
            entries[len(steps) + 1].append((key, owner[place], factor / norms[owner[place]]))
        self.keys, self.values = {}, {}
        for n, found in entries.items():
            key, who, value = (np.concatenate(x) for x in zip(*found))
            self.keys[n], inverse = np.unique(key, return_inverse=True)
            self.values[n] = np.zeros((len(self.keys[n]), len(landmarks)), np.float32)
            np.add.at(self.values[n], (inverse, who), value)

    def with_landmarks(self, strings: Strings, step: int = 4000) -> np.ndarray:
        out = np.zeros((len(strings), next(iter(self.values.values())).shape[1]), np.float32)
        for a in range(0, len(strings), step):
            part = strings.part(a, min(a + step, len(strings)))
            owner, norms = part.owner(), part.norms()
            for steps, place, key, factor in part.subsequences():
                keys = self.keys[len(steps) + 1]
                at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
                hit = keys[at] == key if len(keys) else np.zeros(len(key), bool)
                if not hit.any():
                    continue
                who = owner[place[hit]]
                first = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1])))
                sums = np.add.reduceat(self.values[len(steps) + 1][at[hit]], first, axis=0)
                out[a + who[first]] += factor * sums / norms[who[first], None]
        return out

    def machine(self, alpha: np.ndarray, bias: float) -> Machine:
        return Machine(self.keys, {n: (v @ alpha).astype(np.float32) for n, v in self.values.items()}, bias, np.zeros(6))


def _signs(docs: np.ndarray, ids: np.ndarray, strings: Strings, toxic: np.ndarray) -> np.ndarray:
    """For each string how far its most telling run of five symbols favours toxic texts."""
    place, key = next((p, k) for steps, p, k, _ in strings.subsequences() if steps == (1, 1, 1, 1))
    owner = strings.owner()[place]
    order = np.argsort(ids, kind="stable")
    docs, bounds = docs[order], np.searchsorted(ids[order], np.arange(len(strings) + 1))
    count = (bounds[1:] - bounds[:-1])[owner]
    doc = docs[np.repeat(bounds[owner] - (np.cumsum(count) - count), count) + np.arange(count.sum())]
    seen = np.unique(np.repeat(key, count) * len(toxic) + doc)
    keys, inverse = np.unique(seen // len(toxic), return_inverse=True)
    mark = toxic[seen % len(toxic)]
    bad, good = np.bincount(inverse, mark, len(keys)), np.bincount(inverse, 1 - mark, len(keys))
    present = toxic[np.unique(docs)]
    n_bad, n_good = max(present.sum(), 1), max((1 - present).sum(), 1)
    p = (bad + good + 1) / (n_bad + n_good + 2)
    z = (bad / n_bad - good / n_good) / np.sqrt(p * (1 - p) * (1 / n_bad + 1 / n_good))
    out = np.full(len(strings), -9.0)
    np.maximum.at(out, owner, z[np.searchsorted(keys, key)])
    return out


def _best(score: np.ndarray, among: np.ndarray, n: int) -> np.ndarray:
    return among[np.argsort(-score[among], kind="stable")][:n]


def _evenly(among: np.ndarray, n: int) -> np.ndarray:
    return among[np.linspace(0, len(among) - 1, min(n, len(among))).astype(int)]


def _with_insertions(strings: Strings, nth: int) -> Strings:
    """The strings with one more letter somewhere inside each."""
    size = np.diff(strings.bounds) - 2
    draw = np.random.default_rng(nth)
    place = strings.bounds[:-1] + 1 + draw.integers(1, np.maximum(size, 2))
    flat = np.insert(strings.flat, place, draw.integers(1, DIGIT, len(place)))
    return Strings(flat, strings.bounds + np.arange(len(strings.bounds)))


def _train(docs: np.ndarray, ids: np.ndarray, strings: Strings, toxic: np.ndarray) -> Machine:
    """The machine for strings ``ids`` of texts ``docs``; toxic texts choose what stands for them."""
    pairs = np.unique(docs * np.int64(len(strings)) + ids)
    docs, ids = pairs // len(strings), pairs % len(strings)
    used, ids = np.unique(ids, return_inverse=True)
    small = strings.at(used)
    score = _signs(docs, ids, small, toxic)
    bad = toxic[docs] == 1
    present = toxic[np.unique(docs)]
    n_bad, n_good = max(present.sum(), 1), max((1 - present).sum(), 1)
    own, who = ids[bad & (score[ids] > TELLING)], docs[bad & (score[ids] > TELLING)]
    against = np.bincount(ids[~bad], minlength=len(small))
    clean = np.flatnonzero(against)
    nothing = Machine({n: np.zeros(0, np.int64) for n in LENGTHS}, {n: np.zeros(0) for n in LENGTHS}, -1.0, np.zeros(6))
    if not len(own) or not len(clean):
        return nothing
    marks = np.union1d(_best(score, np.unique(own), LANDMARKS * 2 // 3), _evenly(clean, LANDMARKS // 3))
    limit, machine = 2 * TELLING, nothing
    for _ in range(ROUNDS):
        order = np.lexsort((-score[own], who))
        chosen = score[own] > limit
        chosen[order[np.concatenate(([True], who[order][1:] != who[order][:-1]))]] = True
        weight = np.bincount(own[chosen], minlength=len(small))
        positive = np.flatnonzero(weight)
        negative = np.union1d(_best(score, clean, HARD), _evenly(clean, EASY))
        kernel = Kernel(small.at(marks))
        values, vectors = np.linalg.eigh(kernel.with_landmarks(small.at(marks)).astype(float))
        real = values > values[-1] * 1e-6
        root = vectors[:, real] / np.sqrt(values[real])
        insults = small.at(positive)
        strange = [_with_insertions(insults, k) for k in range(INSERTIONS)]
        near = np.concatenate([kernel.with_landmarks(x) for x in (insults, *strange, small.at(negative))])
        y = np.concatenate([np.ones(len(near) - len(negative)), -np.ones(len(negative))])
        share = np.concatenate([np.tile(weight[positive] / n_bad, 1 + INSERTIONS), against[negative] / n_good])
        w, bias = fit_svm(near @ root, y, share)
        machine = kernel.machine(root @ w, bias)
        score, limit = margins(small, Tables(machine), bias), 0.0
        marks = np.union1d(marks, _best(score * against, clean, MORE_LANDMARKS))
    return machine


def fit(texts: pa.Array, labels: np.ndarray) -> Machine:
    """The machine and the logistic function for labelled texts (label 1 is toxic)."""
    column = pa.array(texts) if not isinstance(texts, (pa.Array, pa.ChunkedArray)) else texts
    hashes, docs, pieces, sizes = [], [], [], []
    for a, _, data, offsets in text_slices(column):
        found = Instances.of(data, offsets)
        unique, at, inverse = np.unique(found.hashes(), return_index=True, return_inverse=True)
        hashes.append((unique, inverse))
        docs.append(found.owner + a)
        pieces.append(found.take(at))
        sizes.append(len(unique))
    if not docs:
        return Machine({n: np.zeros(0, np.int64) for n in LENGTHS}, {n: np.zeros(0) for n in LENGTHS}, -1.0, np.zeros(6))
    joined = np.concatenate([u for u, _ in hashes])
    _, first, final = np.unique(joined, return_index=True, return_inverse=True)
    start = np.concatenate(([0], np.cumsum(sizes)))
    ids = np.concatenate([final[start[i] + inverse] for i, (_, inverse) in enumerate(hashes)])
    docs = np.concatenate(docs)
    bounds = np.concatenate(([0], np.cumsum(np.concatenate([np.diff(p.bounds) for p in pieces]))))
    strings = Strings(np.concatenate([p.flat for p in pieces]), bounds).at(first)
    toxic = np.asarray(labels, int)
    machine = _train(docs, ids, strings, toxic)
    features = np.zeros((len(toxic), 6))
    for fold in range(FOLDS):
        mine = np.arange(len(toxic)) % FOLDS == fold
        held = mine[docs]
        part = _train(docs[~held], ids[~held], strings, toxic)
        which = np.unique(ids[held])
        value = np.zeros(len(strings))
        value[which] = margins(strings.at(which), Tables(part), part.bias)
        features[mine] = text_features(docs[held], value[ids[held]], len(toxic))[mine]
    machine.judge = fit_logistic(features, toxic)
    return machine


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str) -> tuple[pa.Array, np.ndarray]:
    """Texts and labels to learn from, at most 2 * TRAIN_DOCS a class and TRAIN_CHARS in all."""
    known = labels.where(F.col("toxic").isin(0, 1) & col(key).isNotNull() & ~held_out(col(key)))
    known = known.groupBy(col(key).alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    mixed = F.pmod(F.xxhash64("id"), F.lit(1 << 20))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for label, n in sorted(counts.items()):
        share = min(1 << 20, (1 << 20) * TRAIN_DOCS // n)
        part = known.where((F.col("toxic") == label) & (mixed < share)).limit(2 * TRAIN_DOCS)
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        return pa.array([], pa.string()), np.zeros(0, int)
    chosen = F.broadcast(written(chosen, "ids"))  # at most 4 * TRAIN_DOCS rows
    rows = docs.select(col(key).alias("id"), col(text).alias("text")).where("text IS NOT NULL").join(chosen, "id")
    rows = written(rows.groupBy("id", "toxic").agg(F.min("text").alias("text")), "sample")
    sizes = rows.select("id", F.length("text").alias("n"), mixed.alias("order")).toPandas().sort_values(["order", "id"])
    used, total = [], 0
    for one, n in zip(sizes["id"].tolist(), sizes["n"].tolist()):
        if total + n <= TRAIN_CHARS:
            used.append(one)
            total += n
    if len(used) < len(sizes):
        few = docs.sparkSession.createDataFrame([(i,) for i in used], rows.select("id").schema)
        rows = rows.join(F.broadcast(few), "id")
    found = rows.select("id", "toxic", "text").toArrow().sort_by("id")
    return found.column("text"), found.column("toxic").to_numpy()


class _Tables:
    """The expanded weights of a broadcast machine, made once per Python worker."""

    made: dict = {}

    @classmethod
    def of(cls, token: str, machine: Machine) -> Tables:
        if token not in cls.made:
            cls.made.clear()
            cls.made[token] = Tables(machine)
        return cls.made[token]


def score_batch(column: pa.Array, machine: Machine, tables: Tables) -> np.ndarray:
    scores = [np.zeros(0)]
    for a, b, data, offsets in text_slices(column):
        found = Instances.of(data, offsets)
        _, at, inverse = np.unique(found.hashes(), return_index=True, return_inverse=True)
        margin = margins(found.take(at), tables, machine.bias)[inverse]
        scores.append(logistic(text_features(found.owner, margin, b - a), machine.judge))
    return np.concatenate(scores)


def with_scores(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """Replaces the text by ``score``, the chance that the text is toxic."""
    source = docs.select(*[col(c) for c in docs.columns if c not in (text, "score")], col(text).alias("_text"))
    schema = source.drop("_text").schema.add("score", "double")
    shared, token = docs.sparkSession.sparkContext.broadcast(machine), uuid.uuid4().hex

    def run(batches):
        machine = shared.value
        tables = _Tables.of(token, machine)
        for batch in batches:
            scores = score_batch(batch.column(batch.num_columns - 1), machine, tables)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores)], names=schema.names)

    return source.mapInArrow(run, schema)


def toxicity_report(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: the key, ``held_out``, ``score`` (0 to 1) and ``predicted``.

    Labels are read by the key; a document labelled twice is toxic if one label says so; labels
    other than 0 and 1, and rows held out, teach nothing. Without any label every score is 0.5.
    A null text is empty, and an empty text has the score of a text without words. Rows with a
    null key are scored and not held out. Repeated rows are scored alike; no rows give no rows;
    other columns are ignored.
    """
    texts, marks = labelled_sample(docs, labels, key, text)
    machine = fit(texts, marks)
    scored = with_scores(docs.select(col(key).alias(key), col(text).alias(text)), machine, text)
    return scored.select(
        col(key), F.coalesce(held_out(col(key)), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= ACCEPTED).cast("int").alias("predicted"),
    )
