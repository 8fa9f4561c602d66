"""Token counts by a transducer over characters.

A piece tokenizer is a deterministic transducer: reading one character changes how many
tokens the text so far has by a number that only depends on a finite state. The state is
the longest suffix that may still grow into a piece, with the last token and the relative
count at each position inside it. That is enough, because a token sequence is the
tokenizer's own exactly if each adjacent pair is, so the last token of a longer prefix
follows from the last tokens of shorter ones. States are compiled when first met and stay
with the Python worker.

Texts are laid end to end and cut into chunks. A chunk's map from entry state to exit state
is constant as soon as the chunk holds a place where the state is known anyhow (text start,
a word's first boundary mark, a character outside the vocabulary). All chunks run from that
place at once, maps are composed by a scan over the chunks, and what lies before the place
is run from the composed entry state.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.pieces import BOUNDARY, MODEL, load

CHUNK = 512
SLICE = 2 << 20  # characters run at once
DEAD, FRESH = 0, 1
_START = "\x00" + BOUNDARY  # a mark between texts, then the boundary every text begins with
_STATE_LIMIT = 400_000  # compiled states kept; beyond it the transducer starts anew
_SPREAD = 0x9E3779B97F4A7C15


class Transducer:
    """States and their transitions, compiled when first met.

    Class 0 is every character outside the vocabulary; its count is the length of its UTF-8
    form, added outside. Class 1 is the boundary mark.
    """

    def __init__(self, model: str = MODEL):
        self.pieces = load(model)
        self.prefixes = {p[:n] for p in self.pieces.id_of for n in range(1, len(p) + 1)}
        self.longest = max(map(len, self.pieces.id_of))
        self.pair_ok: dict[tuple[int, int], bool] = {}
        self.names = {i: p for p, i in self.pieces.id_of.items()}
        self.reset()

    def reset(self) -> None:
        self.class_of = np.full(0x110000, -1, np.int32)
        known = self.pieces.char_id >= 0
        self.class_of[~known] = 0
        self.class_of[ord(BOUNDARY)] = self.class_of[0x20] = 1
        self.chars = ["", BOUNDARY]
        self.states: dict[tuple, int] = {}
        self.body: list[tuple] = []
        self.filled = 0
        self.grow(1 << 16)
        self.state(("dead",))
        self.state(("", ((-1, 0),)))

    def grow(self, slots: int) -> None:
        """Transitions lie in one hash table: a slot's key is state and class."""
        old = (self.keys, self.next, self.gain) if self.filled else None
        self.keys = np.full(slots, -1, np.int64)
        self.next = np.zeros(slots, np.int32)
        self.gain = np.zeros(slots, np.int16)
        self.shift = np.uint64(64 - (slots.bit_length() - 1))
        if old:
            self.filled = 0
            used = old[0] >= 0
            for key, after, gained in zip(*(part[used].tolist() for part in old)):
                self.put(key, after, gained)

    def put(self, key: int, after: int, gained: int) -> None:
        if self.filled * 4 > len(self.keys):
            self.grow(2 * len(self.keys))
        slot = (key * _SPREAD & 0xFFFFFFFFFFFFFFFF) >> int(self.shift)
        while self.keys[slot] >= 0:
            slot = (slot + 1) & (len(self.keys) - 1)
        self.keys[slot], self.next[slot], self.gain[slot] = key, after, gained
        self.filled += 1

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slot of each key, and which keys are not there."""
        slots = ((keys.astype(np.uint64) * np.uint64(_SPREAD)) >> self.shift).astype(np.int64)
        off = np.flatnonzero(self.keys.take(slots) != keys)
        missing = []
        while len(off):
            at = self.keys[slots[off]]
            missing.append(off[at < 0])
            off = off[(at >= 0) & (at != keys[off])]
            slots[off] = (slots[off] + 1) & (len(self.keys) - 1)
        return slots, np.concatenate(missing) if missing else np.empty(0, np.int64)

    def state(self, body: tuple) -> int:
        found = self.states.get(body)
        if found is None:
            found = self.states[body] = len(self.body)
            self.body.append(body)
        return found

    def classes(self, codes: np.ndarray) -> np.ndarray:
        out = self.class_of[codes]
        if (out < 0).any():
            for code in np.unique(codes[out < 0]).tolist():
                self.class_of[code] = len(self.chars)
                self.chars.append(chr(code))
            out = self.class_of[codes]
        return out

    def tokens(self, text: str) -> list[int]:
        """The pieces of a short run of vocabulary characters, by the merge rule itself."""
        id_of, rank = self.pieces.id_of, self.pieces.rank
        parts = list(text)
        while True:
            found = [
                (rank[id_of[a + b]], i)
                for i, (a, b) in enumerate(zip(parts, parts[1:]))
                if a + b in id_of
            ]
            if not found:
                return [id_of[p] for p in parts]
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def follows(self, last: int, token: int) -> bool:
        key = (last, token)
        ok = self.pair_ok.get(key)
        if ok is None:
            text = self.names[token]
            if last < 0:
                ok = self.tokens(text) == [token]
            else:
                ok = self.tokens(self.names[last] + text) == [last, token]
            if len(self.pair_ok) > 2_000_000:
                self.pair_ok.clear()
            self.pair_ok[key] = ok
        return ok

    def compiled(self, state: int, kind: int) -> tuple[int, int]:
        """Next state and count gained when a character of a class is read in a state."""
        if state == DEAD:
            return DEAD, 0
        if kind == 0:
            return FRESH, 0
        suffix, marks = self.body[state]
        char = self.chars[kind]
        if kind == 1 and suffix and suffix[-1] != BOUNDARY:
            suffix, marks = "", ((-1, 0),)  # no piece goes on beyond a word's end
        text = suffix + char
        for n in range(1, len(text) + 1):
            token = self.pieces.id_of.get(text[-n:])
            mark = marks[len(marks) - n]
            if token is not None and mark is not None and self.follows(mark[0], token):
                break
        else:
            raise ValueError(f"no token ends {text!r}")
        gained = mark[1] + 1
        marks = (*marks, (token, gained))
        keep = min(len(text), self.longest)
        while keep and text[-keep:] not in self.prefixes:
            keep -= 1
        # a place inside matters only while a piece may still begin there
        after = tuple(
            (m[0], m[1] - gained) if n == 0 or (m and text[-n:] in self.prefixes) else None
            for n, m in zip(range(keep, -1, -1), marks[len(marks) - keep - 1 :])
        )
        return self.state((text[len(text) - keep :], after)), gained

    def step(self, states: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One character for every lane."""
        keys = states.astype(np.int64) << 21 | kinds
        slots, missing = self.find(keys)
        if len(missing):
            for key in np.unique(keys[missing]).tolist():
                self.put(key, *self.compiled(key >> 21, key & 0x1FFFFF))
            slots, _ = self.find(keys)
        return self.next.take(slots), self.gain.take(slots)

    def gains(self, kinds: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Tokens gained at each character; ``known`` marks places where the state is fresh."""
        n = len(kinds)
        chunks = -(-n // CHUNK)
        grid = np.zeros((chunks, CHUNK), np.int32)
        grid.ravel()[:n] = kinds
        grid = np.ascontiguousarray(grid.T)
        out = np.zeros((CHUNK, chunks), np.int16)
        flags = np.zeros((chunks, CHUNK), bool)
        flags.ravel()[:n] = known
        first = np.where(flags.any(1), flags.argmax(1), CHUNK)
        # every chunk from its first known place
        order = np.argsort(first, kind="stable")
        turn = np.searchsorted(first[order], np.arange(CHUNK + 1))
        states = np.full(chunks, DEAD, np.int32)
        for t in range(CHUNK):
            if turn[t] != turn[t + 1]:
                states[order[turn[t] : turn[t + 1]]] = FRESH
            states, out[t] = self.step(states, grid[t])
        # compose: a constant map gives the next chunk its entry state at once; a chunk
        # without a known place hands on what its own entry state becomes
        leaves = np.where(first < CHUNK, states, -1)
        enters = np.concatenate([[FRESH], leaves[:-1]])
        todo = np.flatnonzero(first > 0)
        while len(todo):
            ready = todo[enters[todo] >= 0]
            todo = todo[enters[todo] < 0]
            ready = ready[np.argsort(-first[ready], kind="stable")]
            stops = first[ready]
            states = enters[ready].astype(np.int32)
            for t in range(int(stops.max())):
                live = int(np.searchsorted(-stops, -t, "left"))
                states[:live], out[t, ready[:live]] = self.step(states[:live], grid[t, ready[:live]])
            open_end = ready[stops == CHUNK]
            leaves[open_end] = states[stops == CHUNK]
            nxt = open_end[open_end + 1 < chunks] + 1
            enters[nxt] = leaves[nxt - 1]
        return np.ascontiguousarray(out.T).ravel()[:n]


@lru_cache(maxsize=2)
def transducer(model: str = MODEL) -> Transducer:
    return Transducer(model)


def count_tokens(texts: list[str], model: str = MODEL) -> np.ndarray:
    """Tokens of each text, without begin and end; an empty text has none."""
    machine = transducer(model)
    counts = np.zeros(len(texts), np.int64)
    a = 0
    while a < len(texts):
        b, size = a, 0
        while b < len(texts) and (b == a or size + len(texts[b]) < SLICE):
            size += len(texts[b]) + 1
            b += 1
        counts[a:b] = _counted(machine, texts[a:b])
        a = b
        if len(machine.body) > _STATE_LIMIT:
            machine.reset()
    return counts


def _counted(machine: Transducer, texts: list[str]) -> np.ndarray:
    lengths = np.fromiter((len(t) + 2 if t else 0 for t in texts), np.int64, len(texts))
    if not lengths.sum():
        return np.zeros(len(texts), np.int64)
    joined = "".join(_START + t for t in texts if t)
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    kinds = machine.classes(codes)
    ends = np.cumsum(lengths)
    starts = (ends - lengths)[lengths > 0]
    kinds[starts] = 0  # leads to the fresh state, so that no text sees the one before
    known = kinds == 1
    known[1:] &= kinds[:-1] != 1
    known[1:] |= kinds[:-1] == 0
    known[0] = True
    gained = machine.gains(kinds, known).astype(np.int64)
    outside = np.flatnonzero(kinds == 0)
    code = codes[outside]
    gained[outside] = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
    gained[starts] = 0
    total = np.concatenate([[0], np.cumsum(gained)])
    return total[ends] - total[ends - lengths]


def token_counts(docs: DataFrame, text: str = "text", model: str = MODEL,
                 limit: int = 4096) -> DataFrame:
    """All columns but the text's, with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    One pass over the rows without a shuffle; whole texts are counted. A null text counts as
    empty (no bytes, no tokens); repeated rows stay repeated. Columns of those three names
    that the input has are replaced.
    """
    made = {"n_bytes", "n_tokens", "over_limit"}
    kept = [c for c in docs.columns if c != text and c not in made]
    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).schema
    schema = schema.add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")

    def run(batches):
        for batch in batches:
            column = batch.column(batch.num_columns - 1).fill_null("")
            texts = column.to_pylist()
            tokens = count_tokens(texts, model)
            sizes = np.fromiter((len(t) if t.isascii() else len(t.encode()) for t in texts),
                                np.int64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)],
                names=[*kept, "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`")).mapInArrow(run, schema)
