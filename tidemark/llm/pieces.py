"""A public SentencePiece vocabulary with its merge rule, shared by three operators.

The vocabulary is read from the model file with the public library; nothing is trained. Models of
the kind "BPE with byte fallback", no normalisation and a leading blank are understood. No piece
has a blank after another character, so a text falls apart into segments, each a run of blanks and
the characters up to the next blank, that are encoded on their own.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

BLANK = "▁"
#: Stands for "nothing before" and for a character outside the vocabulary, which never merges.
ALONE = -1
SEGMENT = re.compile(f"{BLANK}+[^{BLANK}]*")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def segments(text: str) -> list[str]:
    """The segments of a text, with the leading blank that the model adds."""
    if not text:
        return []
    return SEGMENT.findall(BLANK + text.replace(" ", BLANK))


class Pieces:
    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.size = sp.get_piece_size()
        self.ids: dict[str, int] = {}
        self.scores: dict[int, float] = {}
        self.texts: list[str] = [""] * self.size
        self.raw: list[bytes] = [b""] * self.size
        self.byte_ids = np.zeros(256, dtype=np.int32)
        for i in range(self.size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:-1], 16)] = i
                self.raw[i] = bytes([int(piece[3:-1], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                if BLANK in piece.lstrip(BLANK):
                    raise ValueError("a piece has a blank after another character")
                self.ids[piece] = i
                self.scores[i] = sp.get_score(i)
                self.texts[i] = piece
                self.raw[i] = piece.replace(BLANK, " ").encode()
        self.longest = max(map(len, self.ids))

    def merge(self, text: str) -> list[str]:
        """The merge rule by itself: always join the neighbours whose union scores best, the
        leftmost of equals. Used on pairs of pieces and in tests."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = self.ids.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or self.scores[found] > best):
                    best, at = self.scores[found], i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, before: int, piece: int) -> bool:
        """Whether the merge rule leaves ``piece`` whole right after ``before``.

        The encoding of a text is the only division into pieces that each come out whole and of
        which each two neighbours fit: up to the first merge across a border, the parts on both
        sides develop as they do alone.
        """
        own = self.texts[piece]
        if before == ALONE:
            return self.merge(own) == [own]
        return self.merge(self.texts[before] + own) == [self.texts[before], own]


@lru_cache(maxsize=2)
def load(model: str) -> Pieces:
    """One vocabulary per Python worker."""
    return Pieces(model)
