"""The vocabulary of a piece model: ids, merge order and bytes, read once per Python worker."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

MODEL = "piece_bpe_32k.model"
BOUNDARY = "▁"  # stands for a space
NO_RANK = np.int32(2**31 - 1)


def model_path(model: str) -> str:
    """A model named without a folder is one of the installed public tokenizers."""
    if "/" in model:
        return model
    import public_tokenizers

    return public_tokenizers.path(model)


class Pieces:
    """Ids of ordinary pieces, their merge order (lower first) and what each id stands for.

    The merge rule: the adjacent pair whose joined piece scores highest merges first, the
    leftmost of equals. Characters outside the vocabulary become their UTF-8 bytes.
    """

    def __init__(self, model: str):
        import sentencepiece

        book = sentencepiece.SentencePieceProcessor(model_file=model_path(model))
        self.size = book.get_piece_size()
        self.begin, self.end = book.bos_id(), book.eos_id()
        self.id_of: dict[str, int] = {}
        self.byte_id = np.full(256, -1, np.int32)
        scores = np.full(self.size, -np.inf)
        self.text: list[bytes] = []
        for i in range(self.size):
            piece = book.id_to_piece(i)
            if book.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                self.text.append(bytes([value]))
            elif book.is_control(i):
                self.text.append(b"")
            elif book.is_unknown(i):
                self.text.append(" ⁇ ".encode())
            else:
                self.id_of[piece] = i
                scores[i] = book.get_score(i)
                self.text.append(piece.replace(BOUNDARY, " ").encode())
        _, order = np.unique(-scores, return_inverse=True)
        self.rank = order.astype(np.int32)  # equal scores share a rank
        self.char_id = np.full(0x110000, -1, np.int32)
        for piece, i in self.id_of.items():
            if len(piece) == 1:
                self.char_id[ord(piece)] = i
        if any(BOUNDARY in piece.lstrip(BOUNDARY) for piece in self.id_of):
            raise ValueError("a piece spans a word boundary; texts cannot be cut at spaces")

    def merged(self, left: int, right: int, names: list[str]) -> int:
        return self.id_of.get(names[left] + names[right], -1)


@lru_cache(maxsize=4)
def load(model: str = MODEL) -> Pieces:
    return Pieces(model)
