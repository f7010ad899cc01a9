"""Exact substring dedup: bytes covered by a string of ``length`` bytes that also starts earlier.

The positions are ranked by prefixes of growing length, and those whose rank is unique drop out. All
sorting is Spark's. Sorting every byte position at every doubling would move more than 16 bytes
for each byte of text and round; three exact reductions come first, and the ranks are doubled on what is left:

1. Equal texts are one class; only its earliest document is ranked, and its other documents consist
   of earlier strings from end to end.
2. Rank at ``SEED`` bytes. Of the seeds inside a string of ``length`` bytes the one with the smallest
   hash (the leftmost of equals) is its anchor, so equal strings have equal anchors at equal places.
   Anchors are sorted by rank; an anchor with a unique one drops out with all strings around it.
3. Rank at the core length. The strings of one anchor come in blocks of ``BLOCK`` neighbouring starts;
   what they have in common is their core. A row holds the rank of the core (doubled from ranks of
   8 bytes at offsets 8, 16, 32, ...) and the few bytes on both sides. Spark sorts the rows by
   (core rank, position).
4. Rank at ``length``: the pair of core rank and the bytes that a start adds on its sides. In the
   sorted order the first start with a pair is kept, and every later one is a repeat.

Positions are ordered by (smallest doc_id of the text, null first; hash of the text; offset). Ranks
are 64-bit names of the strings they stand for; two strings count as equal if the names of their
cores and the bytes beside them agree.

Defined results: a null or empty text has no bytes and nothing removed; texts shorter than ``length``
lose nothing; rows equal in doc_id and text are the same document. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import cut, mix, split_batch, text_or_empty

LENGTH, SEED, BLOCK = 100, 24, 8
EMPTY = hashlib.sha256(b"").hexdigest()
_LOW = np.uint64(0xFFFFFFFF)


def _eights(data: bytes) -> np.ndarray:
    """The 8 bytes from each position on as a number; zeros follow the end."""
    return np.ndarray(len(data), dtype="<u8", buffer=data + bytes(8), strides=(1,))


def _double(ranks: np.ndarray, shift: int) -> np.ndarray:
    """Ranks of twice (or, for a smaller shift, partly overlapping) length, by pairs."""
    return mix(ranks[:-shift] * np.uint64(0x9E3779B97F4A7C15) + mix(ranks[shift:]))


def ranks_of(data: bytes, length: int) -> np.ndarray:
    """Names of all strings of ``length`` >= 8 bytes of a text, by prefix doubling."""
    ranks, have = mix(_eights(data)[: max(0, len(data) - 7)]), 8
    while have < length and len(ranks):
        shift = min(have, length - have)
        ranks = _double(ranks, shift) if len(ranks) > shift else ranks[:0]
        have += shift
    return ranks


def anchors_of(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of all seeds, and for each start of a string of ``length`` bytes its anchor."""
    seeds = ranks_of(data, SEED)
    window = length - SEED + 1
    if len(data) < length:
        return seeds, np.zeros(0, dtype=np.int64)
    smallest = (seeds & ~_LOW) | np.arange(len(seeds), dtype=np.uint64)
    reach = 1
    while reach * 2 <= window:
        smallest = np.minimum(smallest[:-reach], smallest[reach:])
        reach *= 2
    if reach < window:
        smallest = np.minimum(smallest[: reach - window], smallest[window - reach :])
    return seeds, (smallest & _LOW).astype(np.int64)


def _anchor_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for batch in split_batch(whole, "text", 8 << 20):
                ranks, nodes, places = [], [], []
                for node, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    if node in seen:
                        continue
                    seen.add(node)
                    seeds, anchor = anchors_of(text.as_buffer().to_pybytes(), length)
                    if len(anchor):
                        at = anchor[np.flatnonzero(np.diff(anchor, prepend=-1))]
                        ranks.append(seeds[at])
                        places.append(at)
                        nodes.append(np.full(len(at), node, dtype=np.int64))
                if not ranks:
                    continue
                rank, place, node = (np.concatenate(x) for x in (ranks, places, nodes))
                order = np.argsort(rank, kind="stable")
                first = np.ones(len(rank), dtype=bool)
                first[1:] = rank[order][1:] != rank[order][:-1]
                alone = first & np.append(first[1:], True)
                # 0: once here; 1: stands for several here; from 2 on: the others of these
                seat = np.where(alone, 0, np.where(first, 1, 2 + np.arange(len(rank))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rank[order].view(np.int64)), pa.array(seat.astype(np.int32)),
                     pa.array(node[order]), pa.array(place[order].astype(np.int32))],
                    names=["rank", "seat", "node", "place"],
                )

    return run


def repeated_anchors(texts: DataFrame, length: int) -> DataFrame:
    """node, places: the anchors whose seed occurs at another position, by text.

    Of the anchors with one rank in a batch of texts only the first meets those of other batches;
    the others are known to be repeats, and are dealt out on their own.
    """
    rows = texts.select("node", "text").mapInArrow(
        _anchor_rows(length), "rank bigint, seat int, node bigint, place int"
    )
    same = Window.partitionBy("rank", F.when(F.col("seat") < 2, 0).otherwise(F.col("seat")))
    again = rows.select(
        "node", "place", "seat",
        (F.min("node").over(same) != F.max("node").over(same)).alias("n"),
        (F.min("place").over(same) != F.max("place").over(same)).alias("p"),
    ).where("seat > 0 or n or p")
    return again.groupBy("node").agg(F.array_sort(F.collect_set("place")).alias("places"))


def _block_rows(length: int):
    core_length = length - BLOCK + 1
    side = BLOCK - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["core", "least_id", "node", "base", "mask", "left", "right"]
        for whole in batches:
            for batch in split_batch(whole, "text", 2 << 20):
                out: list[list[np.ndarray]] = [[] for _ in range(6)]
                ids = []
                for node, least, text, places in zip(
                    batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)
                ):
                    data = text.as_buffer().to_pybytes()
                    _, anchor = anchors_of(data, length)
                    marked = np.zeros(len(data) + 1, dtype=bool)
                    marked[places.values.to_numpy()] = True
                    start = np.flatnonzero(marked[anchor])
                    if not len(start):
                        continue
                    back = anchor[start] - start
                    # the base of a block is its last start; the block's starts are base - 0 .. 7
                    base = anchor[start] - back // BLOCK * BLOCK
                    bit = np.left_shift(1, back % BLOCK)
                    base, where = np.unique(base * np.int64(1 << 31) + anchor[start], return_inverse=True)
                    mask = np.bincount(where, weights=bit).astype(np.int32)
                    base = base >> np.int64(31)
                    cores = ranks_of(data + bytes(side), core_length)
                    around = _eights(bytes(8) + data + bytes(8))
                    left = around[base] >> np.uint64(8)  # the 7 bytes before the base
                    right = around[np.minimum(base + 8 + core_length, len(around) - 1)] & np.uint64((1 << 56) - 1)
                    for column, values in zip(out, (cores[base].view(np.int64), np.full(len(base), node), base.astype(np.int32), mask, left.astype(np.int64), right.astype(np.int64))):
                        column.append(values)
                    ids += [least] * len(base)
                if ids:
                    core, node, base, mask, left, right = (np.concatenate(c) for c in out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(core), pa.array(ids, pa.int64()), pa.array(node.astype(np.int64)),
                         pa.array(base), pa.array(mask), pa.array(left), pa.array(right)],
                        names=names,
                    )

    return run


def _repeat_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (core, position): mark the starts met before. What is kept between
    batches are the pairs of the core that the last batch ended with."""
    open_core, seen = None, [set() for _ in range(BLOCK)]
    for batch in batches:
        if not batch.num_rows:
            continue
        core, mask, left, right = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 4, 5, 6))
        mixed = mix(core.view(np.uint64))
        bits = np.zeros(len(core), dtype=np.int32)
        head = core == open_core
        tail = core == core[-1]
        if not head.any() or core[-1] != open_core:
            later = [set() for _ in range(BLOCK)]
        else:
            later = seen
        for back in range(BLOCK):
            rows = np.flatnonzero(mask >> back & 1)
            if not len(rows):
                continue
            # a start ``back`` bytes before the base has that many bytes on the left of the core
            # and the rest on its right
            before = left[rows].view(np.uint64) >> np.uint64(8 * (BLOCK - 1 - back)) if back else np.zeros(len(rows), np.uint64)
            after = right[rows].view(np.uint64) & np.uint64((1 << (8 * (BLOCK - 1 - back))) - 1)
            beside = before << np.uint64(8 * (BLOCK - 1 - back)) | after if back < BLOCK - 1 else before
            pair = mixed[rows] + mix(beside + np.uint64(back << 56))
            _, first, where = np.unique(pair, return_index=True, return_inverse=True)
            again = first[where] != np.arange(len(rows))
            if head[rows].any() and seen[back]:
                own = head[rows]
                again[own] |= np.array([p in seen[back] for p in pair[own].tolist()], dtype=bool)
            later[back].update(pair[tail[rows]].tolist())
            bits[rows[again]] |= 1 << back
        open_core, seen = core[-1], later
        keep = np.flatnonzero(bits)
        if len(keep):
            yield pa.RecordBatch.from_arrays(
                [batch.column(2).take(pa.array(keep)), batch.column(3).take(pa.array(keep)), pa.array(bits[keep])],
                names=["node", "base", "bits"],
            )


def removals(starts: np.ndarray, n: int, length: int) -> np.ndarray:
    """Which of n bytes lie in a string of ``length`` bytes from one of the starts."""
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + length, -1)
    return np.cumsum(edges[:-1]) > 0


def _edited_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, digests, kept = [], [], [], []
            for text, bases, bits in zip(batch.column(1), batch.column(2), batch.column(3)):
                data = np.frombuffer(text.as_buffer(), dtype=np.uint8)
                bases, bits = bases.values.to_numpy(), bits.values.to_numpy()
                starts = np.concatenate([bases[bits >> back & 1 > 0] - back for back in range(BLOCK)])
                gone = removals(starts, len(data), length)
                rest = data[~gone].tobytes()
                removed.append(int(gone.sum()))
                spans.append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
                digests.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(digests, pa.string()), pa.array(kept, pa.binary())],
                names=["node", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return run


def dedup_substrings(docs: DataFrame, length: int = LENGTH, with_bytes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs`` (doc_id, text);
    with ``with_bytes`` also the remaining bytes of documents that lost some (``kept``)."""
    if length < SEED + BLOCK:
        raise ValueError(f"length must be at least {SEED + BLOCK}")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    seed = 0
    while True:
        texts = rows.withColumn("node", F.xxhash64(F.lit(seed), "text"))
        members = cut(
            texts.select("doc_id", "node", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("sha")),
            "members",
        )
        classes = cut(
            members.groupBy("node").agg(
                F.min("doc_id").alias("known_id"), F.bool_or(F.col("doc_id").isNull()).alias("unnamed"),
                (F.min("sha") != F.max("sha")).alias("clash"), F.count("*").alias("copies"),
            ).select("node", F.when(~F.col("unnamed"), F.col("known_id")).alias("least_id"), "clash", "copies"),
            "classes",
        )
        if classes.where("clash").isEmpty():
            break
        seed += 1
    marks = cut(
        repeated_anchors(texts.where(F.octet_length("text") >= length), length).join(classes.select("node", "least_id"), "node"),
        "anchors",
    )
    suspects = cut(
        texts.join(marks.withColumnRenamed("node", "own"), (F.col("node") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("least_id")))
        .select("node", "least_id", "text", "places").dropDuplicates(["node"]),
        "suspects",
    )
    blocks = suspects.mapInArrow(
        _block_rows(length),
        "core bigint, least_id bigint, node bigint, base int, mask int, left bigint, right bigint",
    )
    order = blocks.repartition("core").sortWithinPartitions("core", F.asc_nulls_first("least_id"), "node", "base")
    starts = (
        order.mapInArrow(_repeat_rows, "node bigint, base int, bits int").groupBy("node")
        .agg(F.collect_list(F.struct("base", "bits")).alias("found"))
    )
    edited = (
        suspects.join(starts, "node").select("node", "text", "found.base", "found.bits")
        .mapInArrow(_edited_rows(length), "node bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
    )
    if not with_bytes:
        edited = edited.drop("kept")
    changed = classes.select("node", "least_id", "copies").join(edited, "node", "left").where(
        (F.col("copies") > 1) | F.col("n_removed").isNotNull()
    )
    out = members.join(changed, "node", "left")
    whole = (F.col("copies") > 1) & ~F.col("doc_id").eqNullSafe(F.col("least_id")) & (F.col("n_bytes") >= length)
    first = F.coalesce(F.col("doc_id").eqNullSafe(F.col("least_id")), F.lit(False))
    extra = [F.when(whole, F.lit(b"")).when(first, F.col("kept")).alias("kept")] if with_bytes else []
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).when(first, F.coalesce("n_removed", F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias("n_removed"),
        F.when(whole, F.lit(1)).when(first, F.coalesce("n_spans", F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias("n_spans"),
        F.when(whole, F.lit(EMPTY)).when(first, F.coalesce("kept_sha256", "sha")).otherwise(F.col("sha")).alias("kept_sha256"),
        *extra,
    )
