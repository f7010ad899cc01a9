"""SentencePiece encoding and decoding by suffix-array matching.

The distinct segments of a batch of texts are written one after the other into one array of
character codes. A suffix array over it, as deep as the longest piece, is searched for every piece
of the vocabulary by binary search, all pieces at once; each range of the suffix array is that
piece's occurrences, which are the edges of the segments' lattices. The edges are sorted by where
they end, and relaxed from left to right, all segments in step: a prefix is reached by the one edge
that fits the piece before it (``Pieces.fits``), which gives the encoding of the merge rule. Ids
are gathered per text. Characters outside the vocabulary become one token per byte.

Defined results: a null or empty text has no tokens and decodes to the empty text. Every text
without the vocabulary's blank sign comes back exactly; that sign comes back as a space. Repeated
rows are encoded each.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.pieces import ALONE, Pieces, default_model, load, segments
from tidemark.llm.shared import map_batches, text_or_empty

#: Characters indexed at a time, segments whose encodings a worker keeps, bytes of text at a time.
INDEX_CHARS = 200_000
MAX_KEPT = 200_000
BATCH_BYTES = 2 << 20
_SLOTS = 1 << 22


class Encoder:
    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        letters = sorted({c for p in pieces.ids for c in p})
        if len(letters) > 65_000:
            raise ValueError("too many characters for 16-bit codes")
        self.width = -(-pieces.longest // 4) * 4
        self.codes = np.zeros(0x110000, dtype=np.uint16)
        self.codes[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.other = len(letters) + 1  # any character outside the vocabulary
        self.piece_ids = np.array(list(pieces.ids.values()), dtype=np.int32)
        self.piece_len = np.array([len(p) for p in pieces.ids], dtype=np.int32)
        low = np.zeros((len(self.piece_ids), self.width), dtype=np.uint16)
        for row, piece in zip(low, pieces.ids):
            row[: len(piece)] = self.codes[[ord(c) for c in piece]]
        high = low.copy()
        high[np.arange(self.width)[None, :] >= self.piece_len[:, None]] = 0xFFFF
        self.low, self.high = self._pack(low), self._pack(high)
        self.len_of = np.zeros(pieces.size + 1, dtype=np.int32)
        self.len_of[self.piece_ids] = self.piece_len
        self.alone = pieces.size  # the code of ALONE in arrays
        # pairs met so far, as 2 * pair + 1 + fits; 0 is an empty slot
        small = 2 * (self.alone + 1) ** 2 < 1 << 32
        self.known = np.zeros(_SLOTS, dtype=np.uint32 if small else np.uint64)
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.pool = np.zeros(0, dtype=np.int32)
        self.starts = np.zeros(0, dtype=np.int64)
        self.counts = np.zeros(0, dtype=np.int64)
        self.uses = np.zeros(0, dtype=np.int64)

    def shrink(self) -> None:
        """Keep the encodings that were used again, at most half of ``MAX_KEPT``, the most used."""
        order = np.argsort(-self.uses, kind="stable")[: MAX_KEPT // 2]
        kept = np.sort(order[self.uses[order] > 1])
        new = np.full(len(self.uses), -1, dtype=np.int64)
        new[kept] = np.arange(len(kept))
        self.index = {s: n for s, old in self.index.items() if (n := int(new[old])) >= 0}
        counts = self.counts[kept]
        starts = np.cumsum(counts) - counts
        self.pool = self.pool[np.arange(counts.sum()) + np.repeat(self.starts[kept] - starts, counts)]
        self.starts, self.counts = starts, counts
        self.uses = np.ones(len(kept), dtype=np.int64)

    def _pack(self, codes: np.ndarray) -> list[np.ndarray]:
        packed = []
        for k in range(0, self.width, 4):
            wide = np.zeros(len(codes), dtype=np.uint64)
            for at in range(k, k + 4):
                wide <<= np.uint64(16)
                wide |= codes[:, at]
            packed.append(wide)
        return packed

    def fits(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """``Pieces.fits`` for arrays, through a table of the pairs met so far."""
        keys = before.astype(np.int64) * (self.alone + 1) + piece
        slots = (keys * 0x9E3779B1 >> 7) & (_SLOTS - 1)
        held = self.known[slots].astype(np.int64) - 1
        out = (held & 1).astype(bool)
        missed = np.flatnonzero((held < 0) | (held >> 1 != keys))
        if len(missed):
            new, where = np.unique(keys[missed], return_inverse=True)
            first, second = np.divmod(new, self.alone + 1)
            rule, alone = self.pieces.fits, self.alone
            found = np.array(
                [
                    b == alone or rule(ALONE if a == alone else a, b)
                    for a, b in zip(first.tolist(), second.tolist())
                ],
                dtype=bool,
            )
            out[missed] = found[where]
            self.known[(new * 0x9E3779B1 >> 7) & (_SLOTS - 1)] = 2 * new + 1 + found
        return out

    def edges(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and piece of every occurrence of every piece in an array of codes."""
        n = len(data)
        padded = np.concatenate([data, np.zeros(self.width, dtype=np.uint16)])
        view = np.lib.stride_tricks.sliding_window_view(padded, self.width)[:n]
        keys = self._pack(view)
        suffixes = np.lexsort(keys[::-1]).astype(np.int32)
        ordered = [k[suffixes] for k in keys]

        def place(wanted: list[np.ndarray], after: bool) -> np.ndarray:
            """How many suffixes are smaller than (or, ``after``, at most) each wanted key."""
            lo = np.zeros(len(self.piece_ids), dtype=np.int64)
            hi = np.full(len(self.piece_ids), n, dtype=np.int64)
            for _ in range(int(n).bit_length()):
                mid = np.minimum((lo + hi) >> 1, n - 1)
                less = np.zeros(len(lo), dtype=bool)
                equal = np.ones(len(lo), dtype=bool)
                for have, want in zip(ordered, wanted):
                    here = have[mid]
                    less |= equal & (here < want)
                    equal &= here == want
                go = (less | equal if after else less) & (lo < hi)
                lo, hi = np.where(go, mid + 1, lo), np.where(go, hi, mid)
            return lo

        first, last = place(self.low, False), place(self.high, True)
        found = last - first
        piece = np.repeat(self.piece_ids, found)
        offset = np.arange(len(piece)) - np.repeat(np.cumsum(found) - found, found)
        return suffixes[np.repeat(first, found) + offset], piece

    def lattices(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """Characters of the words, each closed by a zero; begin and size of each word; start,
        piece and length of the edges. Characters without a piece of their own are edges too."""
        chars = np.frombuffer("\0".join([*words, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.array([len(s) for s in words], dtype=np.int64)
        begins = np.cumsum(sizes + 1) - sizes - 1
        data = self.codes[chars]
        data[data == 0] = self.other
        data[begins + sizes] = 0
        start, piece = self.edges(data)
        single = np.zeros(len(data), dtype=bool)
        single[start[self.len_of[piece] == 1]] = True
        odd = np.flatnonzero(~single & (data != 0)).astype(np.int32)
        start = np.concatenate([start, odd])
        length = np.concatenate([self.len_of[piece], np.ones(len(odd), dtype=np.int32)])
        piece = np.concatenate([piece, np.full(len(odd), self.alone, dtype=np.int32)])
        return chars, begins, sizes, start, piece, length

    def learn(self, new: list[str]) -> None:
        """Encode segments not met before and keep their ids."""
        chars, begins, sizes, start, piece, length = self.lattices(new)
        offset = np.arange(len(chars)) - np.repeat(begins, sizes + 1)
        ends = offset[start] + length
        order = np.argsort(ends.astype(np.uint16) if ends.max(initial=0) < 65_536 else ends, kind="stable")
        start, piece, length, ends = start[order], piece[order], length[order], ends[order]
        borders = np.flatnonzero(np.diff(ends, prepend=-1, append=-1))
        # nodes are places between characters: the place before character i is node i
        last = np.full(len(chars) + 1, self.alone, dtype=np.int32)
        back = np.full(len(chars) + 1, -1, dtype=np.int64)
        for a, b in zip(borders[:-1], borders[1:]):
            s, p = start[a:b], piece[a:b]
            good = self.fits(last[s], p)
            s, p = s[good], p[good]
            to = s + length[a:b][good]
            last[to], back[to] = p, s
        on = np.zeros(len(chars) + 1, dtype=bool)
        at, floor = begins + sizes, begins.copy()
        while len(at):
            on[at] = True
            at = back[at]
            if (at < 0).any():
                raise AssertionError("a segment has no encoding")
            more = at > floor
            at, floor = at[more], floor[more]
        nodes = np.flatnonzero(on)
        tokens = last[nodes]
        of = np.searchsorted(begins, nodes - 1, side="right") - 1
        plain = tokens != self.alone
        spread = np.ones(len(tokens), dtype=np.int64)
        raw = [chr(c).encode("utf-8", "surrogatepass") for c in chars[nodes[~plain] - 1].tolist()]
        spread[~plain] = [len(r) for r in raw]
        ids = np.repeat(tokens, spread)
        if raw:
            ids[np.repeat(~plain, spread)] = self.pieces.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        counts = np.bincount(of, weights=spread, minlength=len(new)).astype(np.int64)
        base = len(self.counts)
        self.index.update(zip(new, range(base, base + len(new))))
        self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.uses = np.concatenate([self.uses, np.zeros(len(new), dtype=np.int64)])
        self.pool = np.concatenate([self.pool, ids])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and where each text begins and ends."""
        if len(self.index) > MAX_KEPT:
            self.shrink()
        cut = [segments(t) for t in texts]
        new: list[str] = []
        size, index = 0, self.index
        for s in {s for found in cut for s in found if s not in index}:
            new.append(s)
            size += len(s) + 1
            if size > INDEX_CHARS:
                self.learn(new)
                new, size = [], 0
        if new:
            self.learn(new)
        number = np.array([index[s] for found in cut for s in found], dtype=np.int64)
        per_text = np.array([len(found) for found in cut], dtype=np.int64)
        self.uses += np.bincount(number, minlength=len(self.uses))
        counts = self.counts[number]
        done = np.concatenate([[0], np.cumsum(counts)])
        ids = self.pool[np.arange(done[-1]) + np.repeat(self.starts[number] - done[:-1], counts)]
        return ids, done[np.concatenate([[0], np.cumsum(per_text)])]


@lru_cache(maxsize=1)
def encoder(model: str) -> Encoder:
    return Encoder(load(model))


@lru_cache(maxsize=1)
def _raw_pool(model: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = load(model).raw
    sizes = np.array([len(r) for r in raw], dtype=np.int64)
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum(sizes) - sizes, sizes


def decode_ids(model: str, ids: np.ndarray, borders: np.ndarray) -> list[str]:
    """The texts of ids laid end to end; the leading blank that encoding adds goes again."""
    pool, starts, sizes = _raw_pool(model)
    size = sizes[ids]
    done = np.concatenate([[0], np.cumsum(size)])
    data = pool[np.arange(done[-1]) + np.repeat(starts[ids] - done[:-1], size)].tobytes()
    at = done[borders].tolist()
    out = [data[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:])]
    return [t[1:] if t[:1] == " " else t for t in out]


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``docs`` as doc_id, text with the ids of the text (array of int)."""
    model = model or default_model()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, borders = encoder(model).encode(batch.column(1).to_pylist())
        arrays = pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(ids, pa.int32()))
        return pa.RecordBatch.from_arrays([*batch.columns, arrays], names=["doc_id", "text", "ids"])

    return map_batches(rows, work, "doc_id bigint, text string, ids array<int>", batch_bytes=BATCH_BYTES, done=lambda: encoder(model).forget())


def decode(rows: DataFrame, model: str | None = None) -> DataFrame:
    """``rows`` (doc_id, text, ids) with the column ``decoded``; a null list decodes to nothing.

    Control and unknown ids have no text. Ids outside the vocabulary are an error.
    """
    model = model or default_model()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(2)
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        texts = decode_ids(model, ids, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(texts, pa.string())], names=["doc_id", "text", "ids", "decoded"]
        )

    wanted = rows.select("doc_id", "text", "ids")
    return map_batches(wanted, work, "doc_id bigint, text string, ids array<int>, decoded string")


def round_trip(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``decode(encode(docs))`` in one pass: one Python worker a task instead of two in a row, and
    the texts cross over to it once."""
    model = model or default_model()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, borders = encoder(model).encode(batch.column(1).to_pylist())
        lists = pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(ids, pa.int32()))
        texts = decode_ids(model, ids, borders)
        return pa.RecordBatch.from_arrays(
            [*batch.columns, lists, pa.array(texts, pa.string())], names=["doc_id", "text", "ids", "decoded"]
        )

    wanted = "doc_id bigint, text string, ids array<int>, decoded string"
    return map_batches(rows, work, wanted, batch_bytes=BATCH_BYTES, done=lambda: encoder(model).forget())


def op3(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Per document the number of tokens, a hash of the ids, and what decoding gives back."""
    return round_trip(docs, model).select(
        "doc_id",
        F.octet_length("text").cast("bigint").alias("n_bytes"),
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.xxhash64("ids").alias("ids_hash"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.col("text")).alias("exact"),
    )
