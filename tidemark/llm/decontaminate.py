"""Benchmark passages in documents: CGK embedding, bit-sampling LSH, exact edit distance.

Texts are compared by their letters and digits, lower-cased, as bytes; blanks and punctuation are
left out. Windows have the size class of the item: the largest of SIZES that fits the item with a
quarter to spare. In a document windows begin at every quarter of their size, in an item at every
byte, so an item's occurrence holds whole windows that begin where an indexed one does.

A window is embedded by a CGK random walk: at each step the current byte is written down, and a
random bit drawn for (step, byte) says whether to move on. Two strings at a small edit distance
write down the same bytes but at few steps, so bit sampling finds them: each repetition keys a
window by the bytes at SAMPLED random steps. The number of repetitions follows from the wanted
recall. Windows of documents look their keys up in the items' table, which is broadcast in blocks of
bounded size, and each find is settled by the exact edit distance of the item to the best matching
stretch around it, by bit-parallel dynamic programming.

Defined results: null or empty texts hold nothing. Items with fewer than ``SIZES[0] * 5 / 4``
letters and digits are no evidence and are not searched. Equal items are all reported. Repeated
rows are searched each. Extra columns are kept by ``drop_contaminated`` and ignored by ``matches``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ngram_join import bytes_of
from tidemark.llm.shared import given_back, split_batch, text_or_empty

SIZES = (12, 24, 48, 96)
#: Most edits as a share of the item's length; steps sampled for a key; chance that a sampled step
#: agrees at that many edits (measured); wanted recall.
EDITS, SAMPLED, AGREEMENT, RECALL = 0.1, 10, 0.81, 0.95
#: Items searched for in one pass over the documents, in bytes.
BLOCK_BYTES = 8 << 20
WINDOWS_AT_ONCE = 1 << 16

_FOLD = np.zeros(256, dtype=np.uint8)
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("0") : ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[128:] = np.arange(128, 256)


def folded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Letters and digits of all texts end to end, and where each text begins and ends."""
    data, borders = bytes_of(column)
    data = _FOLD[data]
    keep = data != 0
    done = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(keep, out=done[1:])
    return data[keep], done[borders]


def repetitions(recall: float = RECALL, sampled: int = SAMPLED, agreement: float = AGREEMENT) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - agreement**sampled))


def size_of(length: int) -> int | None:
    fitting = [s for s in SIZES if s * 5 <= length * 4]
    return fitting[-1] if fitting else None


def least_edits(item: bytes, text: bytes) -> int:
    """The smallest edit distance of ``item`` to any stretch of ``text`` (Myers' bit vectors)."""
    m = len(item)
    peq: dict[int, int] = {}
    for i, c in enumerate(item):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, m
    for c in text:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = (mv | ~(xh | pv)) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        pv = (mh | ~(xv | ph)) & full
        mv = ph & xv
        if score < best:
            best = score
    return best


class Walk:
    """The random walk and the sampled steps of one window size; the same in every process."""

    def __init__(self, size: int, repeats: int):
        rng = np.random.RandomState(size)
        self.steps = size * 3 // 2
        self.moves = rng.randint(0, 2, size=(self.steps, 256)).astype(np.int64)
        self.at: list[list[int]] = [[] for _ in range(self.steps)]
        for r in range(repeats):
            for step in rng.choice(self.steps, min(SAMPLED, self.steps), replace=False):
                self.at[step].append(r)
        self.repeats = repeats

    def keys(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """repetitions x windows; ``data`` has to go on for ``steps`` bytes after each start."""
        keys = np.zeros((self.repeats, len(starts)), dtype=np.uint64)
        place = starts.astype(np.int64)
        for moves, wanted in zip(self.moves, self.at):
            here = data[place]
            for r in wanted:
                row = keys[r]
                row += here
                row *= np.uint64(0x9E3779B97F4A7C15)
                row ^= row >> np.uint64(29)
            place += moves[here]
        return keys


def marks(keys: np.ndarray) -> np.ndarray:
    """A bit for each value of the first 20 bits of a key, set where a key has it."""
    seen = np.zeros(1 << 20, dtype=bool)
    seen[keys >> np.uint64(44)] = True
    return np.packbits(seen, bitorder="little")


def marked(seen: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Not zero where the bit of a key is set."""
    at = (keys >> np.uint64(44)).astype(np.uint32)
    return (seen[at >> 3] >> (at & 7).astype(np.uint8)) & 1


class Index:
    """Items of one block, with the keys of their windows by size class."""

    def __init__(self, items: list[tuple[int, str]], recall: float = RECALL, edits: float = EDITS):
        data, borders = folded(pa.array([t for _, t in items], pa.string()))
        self.ids = [i for i, _ in items]
        self.texts = [data[a:b].tobytes() for a, b in zip(borders, borders[1:])]
        self.most = [int(len(t) * edits) for t in self.texts]
        self.classes = []
        for size in SIZES:
            walk = Walk(size, repetitions(recall))
            own = [n for n, t in enumerate(self.texts) if size_of(len(t)) == size]
            if not own:
                continue
            of, offset, keys = [], [], []
            for n in own:
                begins = np.arange(len(self.texts[n]) - size + 1, dtype=np.int32)
                padded = np.frombuffer(self.texts[n] + bytes(walk.steps), np.uint8)
                keys.append(walk.keys(padded, begins))
                of.append(np.full(len(begins), n, dtype=np.int32))
                offset.append(begins)
            of, offset, keys = np.concatenate(of), np.concatenate(offset), np.concatenate(keys, axis=1)
            tables = []
            for row in keys:
                order = np.argsort(row, kind="stable")
                tables.append((row[order], of[order], offset[order], marks(row)))
            self.classes.append((size, walk, tables))

    def finds(self, data: np.ndarray, borders: np.ndarray) -> dict[tuple[int, int], int]:
        """(text, item) -> edits, for texts laid end to end."""
        candidates: set[tuple[int, int, int]] = set()
        for size, walk, tables in self.classes:
            padded = np.concatenate([data, np.zeros(walk.steps, dtype=np.uint8)])
            stride = size // 4
            counts = np.maximum(0, (np.diff(borders) - size) // stride + 1)
            done = np.concatenate([[0], np.cumsum(counts)])
            text = np.repeat(np.arange(len(counts)), counts)
            starts = borders[:-1][text] + (np.arange(done[-1]) - done[:-1][text]) * stride
            for a in range(0, len(starts), WINDOWS_AT_ONCE):
                part = starts[a : a + WINDOWS_AT_ONCE]
                for keys, (have, of, offset, seen) in zip(walk.keys(padded, part), tables):
                    maybe = np.flatnonzero(marked(seen, keys))
                    if not len(maybe):
                        continue
                    lo = np.searchsorted(have, keys[maybe], "left")
                    hi = np.searchsorted(have, keys[maybe], "right")
                    for w, x, y in zip(maybe[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
                        for k in range(x, y):
                            item = int(of[k])
                            begin = int(part[w]) - int(offset[k])
                            # nearby beginnings are one candidate: its zone has room for them
                            room = max(1, self.most[item])
                            candidates.add((int(text[a + w]), item, begin // room))
        best: dict[tuple[int, int], int] = {}
        raw = data.tobytes()
        for n, item, slot in candidates:
            if best.get((n, item), 1 << 60) == 0:
                continue
            own, most = self.texts[item], self.most[item]
            room = max(1, most)
            low = max(int(borders[n]), slot * room - 2 * room)
            high = min(int(borders[n + 1]), slot * room + len(own) + 3 * room)
            edits = 0 if raw.find(own, low, high) >= 0 else least_edits(own, raw[low:high])
            if edits <= most and edits < best.get((n, item), 1 << 60):
                best[n, item] = edits
        return best


@lru_cache(maxsize=1)
def index_of(items: tuple[tuple[int, str], ...], recall: float, edits: float) -> Index:
    """The index of a block, built once in each Python worker; only the items are sent."""
    return Index(list(items), recall, edits)


def _blocks(items: DataFrame) -> Iterator[tuple[tuple[int, str], ...]]:
    """The items in blocks of a bounded number of bytes."""
    rows = items.where(F.col("text").isNotNull()).select(
        F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = size // BLOCK_BYTES + 1
    for block in range(n):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).orderBy("item_id", "text")
        yield tuple((r["item_id"], r["text"]) for r in own.toLocalIterator())


def matches(
    docs: DataFrame, items: DataFrame, recall: float = RECALL, edits: float = EDITS
) -> DataFrame:
    """(doc_id, item_id, edits, item_length) for every item found in a document."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    schema = "doc_id bigint, item_id bigint, edits bigint, item_length bigint"
    found = None
    for block in _blocks(items):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def work(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            own = index_of(held.value, recall, edits)
            for whole in batches:
                for batch in split_batch(whole, "text", 4 << 20):
                    best = own.finds(*folded(batch.column(1)))
                    if best:
                        ids = batch.column(0).to_pylist()
                        rows = [(ids[n], own.ids[i], e, len(own.texts[i])) for (n, i), e in sorted(best.items())]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, pa.int64()) for c in zip(*rows)],
                            names=["doc_id", "item_id", "edits", "item_length"],
                        )

        part = rows.mapInArrow(given_back(work), schema)
        found = part if found is None else found.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found


def drop_contaminated(
    docs: DataFrame, items: DataFrame, recall: float = RECALL, edits: float = EDITS
) -> DataFrame:
    """The rows of ``docs`` whose text holds none of the items, all columns unchanged."""
    names, kept = docs.columns, docs
    for block in _blocks(items):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            own = index_of(held.value, recall, edits)
            for whole in batches:
                for batch in split_batch(whole, "__text", 4 << 20):
                    keep = np.ones(batch.num_rows, dtype=bool)
                    for n, _ in own.finds(*folded(batch.column(len(names)))):
                        keep[n] = False
                    yield batch.select(list(range(len(names)))).filter(pa.array(keep))

        kept = kept.withColumn("__text", text_or_empty()).mapInArrow(given_back(clean), docs.schema)
    return kept
