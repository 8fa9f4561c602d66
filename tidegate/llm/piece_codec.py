"""Piece encoding by vectorised merge rounds, and decoding.

No piece goes on beyond a word's end, so texts are cut into words, and each distinct word
is encoded once per Python worker while it stays in a bounded memory. New words of a batch
are laid end to end as one flat symbol array. A round takes, in every word, the leftmost of
the adjacent pairs with the best merge rank, joins all of those at once and compacts the
arrays; words without a pair left leave. The order within a word is thus the tokenizer's.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from tidegate.llm.pieces import BOUNDARY, MODEL, NO_RANK, load

SLICE_CHARS = 2 << 20  # characters encoded at once; a longer text is one slice
MEMORY_WORDS = 400_000  # distinct words remembered; beyond it the memory starts anew
_RUNS = re.compile(" *[^ ]+| +$")
_OUTSIDE = 1 << 20  # symbols above stand for characters without a piece


class PieceCodec:
    """Encodes and decodes texts with one model."""

    def __init__(self, model: str = MODEL):
        self.pieces = pieces = load(model)
        pairs = [
            (pieces.id_of[p[:i]] << 20 | pieces.id_of[p[i:]], joined)
            for p, joined in pieces.id_of.items()
            for i in range(1, len(p))
            if p[:i] in pieces.id_of and p[i:] in pieces.id_of
        ]
        pairs.sort()
        self.pair_keys = np.array([k for k, _ in pairs], np.int64)
        self.pair_ids = np.array([i for _, i in pairs], np.int32)
        self.rank = np.append(pieces.rank, NO_RANK)  # the last answers for "no pair"
        self.bytes_of = np.frombuffer(b"".join(pieces.text), np.uint8)
        self.byte_counts = np.array([len(t) for t in pieces.text], np.int64)
        self.byte_starts = np.cumsum(self.byte_counts) - self.byte_counts
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.int32)
        self.used = 0
        self.starts: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The joined piece of each pair, -1 where there is none."""
        keys = left.astype(np.int64) << 20 | right
        keys[(left >= _OUTSIDE) | (right >= _OUTSIDE)] = -1
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ids[at], -1)

    def merge_words(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final symbols of words laid end to end, and how many each word has."""
        total = len(counts)
        word = np.repeat(np.arange(total), counts)
        done_symbols, done_words = [], []
        joined = np.full(len(symbols), -1, np.int32)  # what a symbol and the next one make
        inner = np.flatnonzero(word[1:] == word[:-1])
        joined[inner] = self.pairs(symbols[inner], symbols[inner + 1])
        while len(symbols):
            ranks = self.rank[joined]
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            best = np.minimum.reduceat(ranks, first)
            sizes = np.diff(np.append(first, len(word)))
            finished = best == NO_RANK
            if finished.any():
                out = np.repeat(finished, sizes)
                done_symbols.append(symbols[out])
                done_words.append(word[out])
                stay = ~out
                symbols, word, joined, ranks = symbols[stay], word[stay], joined[stay], ranks[stay]
                best, sizes = best[~finished], sizes[~finished]
                if not len(symbols):
                    break
            at = np.flatnonzero(ranks == np.repeat(best, sizes))
            at = at[np.concatenate(([True], word[at][1:] != word[at][:-1]))]  # leftmost
            symbols[at] = joined[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            place = at - np.arange(len(at))  # where the joined symbols are after compaction
            symbols, word, joined = symbols[keep], word[keep], joined[keep]
            for side in (place - 1, place):  # only pairs beside a joined symbol are new
                side = side[side >= 0]
                joined[side] = -1
                side = side[side + 1 < len(symbols)]
                side = side[word[side] == word[side + 1]]
                joined[side] = self.pairs(symbols[side], symbols[side + 1])
        if not done_symbols:
            return np.empty(0, np.int32), np.zeros(total, np.int64)
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return symbols[order], np.bincount(word, minlength=total)

    def learn(self, words: list[str]) -> None:
        """Encode words (boundary marks in place) and remember them in this order."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        counts = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.pieces.char_id[codes]
        outside = symbols < 0
        symbols[outside] = codes[outside].astype(np.int32) + _OUTSIDE
        symbols, counts = self.merge_words(symbols, counts)
        outside = np.flatnonzero(symbols >= _OUTSIDE)
        if len(outside):  # as bytes
            code = symbols[outside] - _OUTSIDE
            width = np.ones(len(symbols), np.int64)
            width[outside] = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
            spots = np.cumsum(width) - width
            raw = np.frombuffer(code.astype(np.uint32).tobytes().decode("utf-32-le").encode(), np.uint8)
            spread = np.repeat(symbols, width)
            spread[np.repeat(symbols >= _OUTSIDE, width)] = self.pieces.byte_id[raw]
            totals = np.concatenate(([0], np.cumsum(counts)))
            ends = np.concatenate((spots, [len(spread)]))
            counts = np.diff(ends[totals])
            symbols = spread
        while self.used + len(symbols) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.ids[self.used : self.used + len(symbols)] = symbols
        self.starts.append(self.used + np.cumsum(counts) - counts)
        self.sizes.append(counts)
        self.used += len(symbols)

    def encode_slice(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and how many each text has."""
        if len(self.known) > MEMORY_WORDS:
            self.forget()
        known, new, places, counts = self.known, [], [], []
        for text in texts:
            if BOUNDARY in text:
                text = text.replace(BOUNDARY, " ")
            if not text:
                words = []
            elif "  " in text or text[0] == " " or text[-1] == " ":
                # a single leading mark is left out of the name, as below
                words = [w[1:] if w[:1] == " " and w[1:2] not in (" ", "") else
                         "\n" + w if w[:1] != " " else w for w in _RUNS.findall(" " + text)]
            else:
                words = text.split(" ")
            counts.append(len(words))
            for w in words:
                n = known.get(w)
                if n is None:
                    n = known[w] = len(known)
                    new.append(w)
                places.append(n)
        if new:
            self.learn([w.replace(" ", BOUNDARY) if w[0] == " " else BOUNDARY + w for w in new])
            self.starts, self.sizes = [np.concatenate(self.starts)], [np.concatenate(self.sizes)]
        if not places:
            return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
        places = np.array(places)
        flat, sizes = gathered(self.ids, self.starts[0][places], self.sizes[0][places])
        ends = np.concatenate(([0], np.cumsum(sizes)))
        return flat, np.diff(ends[np.concatenate(([0], np.cumsum(counts)))])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, without begin and end."""
        out = []
        for a, b in slices(texts):
            flat, counts = self.encode_slice(texts[a:b])
            out += np.split(flat, np.cumsum(counts)[:-1])
        return out

    def decode(self, flat: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """UTF-8 of each id sequence laid end to end; control ids stand for nothing.

        The boundary mark a text begins with is left out; bytes that form no character
        become U+FFFD each.
        """
        data, sizes = gathered(self.bytes_of, self.byte_starts[flat], self.byte_counts[flat])
        ends = np.concatenate(([0], np.cumsum(sizes)))
        marks = ends[np.concatenate(([0], np.cumsum(counts)))]
        raw = data.tobytes()
        out = []
        for a, b in zip(marks[:-1].tolist(), marks[1:].tolist()):
            text = raw[a + (raw[a:a + 1] == b" " and b > a) : b]
            try:
                text.decode()
            except UnicodeDecodeError:
                text = "".join(
                    "�" if "\udc80" <= c <= "\udcff" else c
                    for c in text.decode("utf-8", "surrogateescape")
                ).encode()
            out.append(text)
        return out


def gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    """Runs of ``values`` one after the other."""
    total = int(sizes.sum())
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)
    return values[at], sizes


def slices(texts: list[str]):
    a = 0
    while a < len(texts):
        b, size = a, 0
        while b < len(texts) and (b == a or size + len(texts[b]) < SLICE_CHARS):
            size += len(texts[b]) + 1
            b += 1
        yield a, b
        a = b


@lru_cache(maxsize=2)
def codec(model: str = MODEL) -> PieceCodec:
    return PieceCodec(model)


def encode_documents(docs: DataFrame, text: str = "text", model: str = MODEL,
                     with_ids: bool = True, with_text: bool = True) -> DataFrame:
    """Encode every whole text with begin and end ids, and decode it again.

    Adds ``n_tokens``, ``ids`` (array of int, if asked for), ``ids_sha256`` (of the ids as
    little-endian unsigned 32-bit integers), ``decoded`` (if asked for) and
    ``decoded_sha256``; columns of those names are replaced and the text column is left out.
    A null text counts as empty: begin and end only. One pass without a shuffle; repeated
    rows stay repeated, and an empty table gives no rows.
    """
    made = [("n_tokens", "long"), *[("ids", ArrayType(IntegerType()))] * with_ids, ("ids_sha256", "string"),
            *[("decoded", "string")] * with_text, ("decoded_sha256", "string")]
    kept = [c for c in docs.columns if c != text and c not in dict(made)]
    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).schema
    for name, kind in made:
        schema = schema.add(name, kind)
    names = [*kept, *dict(made)]

    def run(batches):
        tool = codec(model)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).fill_null("").to_pylist()
            for a, b in slices(texts):
                flat, counts = tool.encode_slice(texts[a:b])
                begins = np.cumsum(counts) - counts
                framed = np.empty(len(flat) + 2 * len(counts), np.uint32)
                shifted = begins + 2 * np.arange(len(counts))
                framed[np.arange(len(flat)) + np.repeat(2 * np.arange(len(counts)) + 1, counts)] = flat
                framed[shifted] = tool.pieces.begin
                framed[shifted + counts + 1] = tool.pieces.end
                counts = counts + 2
                decoded = tool.decode(framed, counts)
                raw = framed.astype("<u4").tobytes()
                ends = (4 * np.cumsum(counts)).tolist()
                digests = [hashlib.sha256(raw[s:e]).hexdigest() for s, e in zip([0, *ends], ends)]
                columns = [pa.array(counts, pa.int64())]
                if with_ids:
                    marks = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
                    columns.append(pa.ListArray.from_arrays(marks, pa.array(framed.astype(np.int32))))
                columns.append(pa.array(digests, pa.string()))
                if with_text:
                    columns.append(pa.array(decoded, pa.binary()).cast(pa.string()))
                columns.append(pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string()))
                rest = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*rest.columns[:-1], *columns], names=names)

    return docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`")).mapInArrow(run, schema)
