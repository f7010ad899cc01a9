"""Similarity join of texts on sets of word n-grams (Jaccard), and its connected components.

A text's set are the hashes of its distinct runs of ``n`` words. Equal sets are folded into one
class first, wherever they are. The classes are joined by prefix filtering: n-grams are ordered
rarest first, and two sets that reach the threshold share some within their first few. On that join
work the filter on lengths, the positional filter, and the suffix filter (counts of the remaining
n-grams in ranges of their hashes bound the overlap). What is left is verified exactly, once per
pair.

The result is the components, so links inside a component already known need no proof. Prefixes are
longer than needed to share one n-gram, so that a pair has to share several. Round one compares
every set with one partner per shared n-gram, the next smaller set that has it; the next rounds
compare the sets of an n-gram that are in other components than its first one with that one. Both
are linear in a group of near copies, and an n-gram whose sets are in one component is left out from then on.
The last round takes all pairs that share a prefix n-gram and are
still in different components, so the components are those of all links. An n-gram that few sets have
joins their rows, and a pair is made at the first n-gram of a run that both have in a row. Where many
sets have one, their rows meet in blocks of bounded size with their counts in ranges, and only pairs that
the suffix filter leaves become rows.

Most prefix n-grams are in one set only. They have to move to be found single, and take most of the room
that the job needs, so they move packed: a task sends one row for each range of n-grams and some hundred
thousand of its rows, sorted and by byte planes. Rows of their own are made of what is left.

Which n-grams are frequent is an ordering hint only: a list of bounded length is broadcast, and any
list gives the same result. Hashes have 64 bits within a pair; classes are told apart by 128 bits.
The 64-bit number that stands for a class is checked to be unique, and dealt anew if not.

Defined results: null text and text without words give the empty set, linked with nothing; equal
rows are documents of their own in one component. A null doc_id is the smallest id only where a
component has no other. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import PrefixHash, cut, given_back, map_batches, mix, split_batch, text_or_empty

WORDS, PERCENT = 5, 80
#: An n-gram is counted as frequent where this many texts of a task have it; the longest list kept.
FREQUENT, MAX_FREQUENT = 4, 1 << 18
#: Ranges of hashes for the suffix filter, and the share of n-grams that a prefix is longer by.
RANGES, LONGER = 256, 10
#: Bytes of text whose n-grams are made at a time: the arrays for it take some thirty-five times as much.
TEXT_BYTES = 2 << 20
#: Rounds of comparing with the first set of an n-gram before all open pairs are compared; another one
#: follows only while the last found more than one link for FEWER of the first round.
STARS, FEWER = 3, 100
#: Rows of an n-gram from which they meet in blocks, and rows of such a block.
CROWDED, BLOCK = 32, 1024
#: Bits of the broadcast marks of the classes whose texts are wanted.
MARKS = 1 << 24
#: Rows of prefixes that a task packs at a time, and about as many that a range of n-grams has.
PACKED, RANGE_ROWS = 1 << 18, 1 << 18
#: One packed row.
ROW = np.dtype([("gram", "<u8"), ("node", "<i8"), ("size", "<i4"), ("pos", "<i4")])

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column without nulls, and where each text begins and ends."""
    column = column.cast(pa.large_string())
    borders = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[borders[0] : borders[-1]], borders - borders[0]


def shingle_sets(column: pa.Array, n: int = WORDS) -> list[np.ndarray]:
    """For each text the sorted hashes of its distinct n-grams of words; with fewer words the whole
    sequence is one."""
    data, borders = bytes_of(column)
    data = _LOWER[data]
    blank = _KIND[data].astype(bool)
    first = np.ones(len(data) + 1, dtype=bool)
    first[1:] = blank
    first[borders] = True
    starts = np.flatnonzero(~blank & first[:-1])
    last = np.ones(len(data), dtype=bool)
    if len(data):
        last[:-1] = blank[1:]
        last[borders[1:][borders[1:] > 0] - 1] = True
    ends = np.flatnonzero(~blank & last) + 1
    words = PrefixHash(data).ranges(starts, ends)
    at = np.searchsorted(starts, borders)
    grams = np.zeros(max(0, len(words) - n + 1), dtype=np.uint64)
    for k in range(n):
        grams = mix(grams * np.uint64(0x100000001B3) + words[k : k + len(grams)])
    out = []
    for a, b in zip(at.tolist(), at[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            whole = hashlib.blake2b(words[a:b].tobytes(), digest_size=8).digest()
            out.append(np.frombuffer(whole, dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def _keys(found: np.ndarray, seed: int) -> tuple[bytes, int]:
    digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
    number = hashlib.blake2b(digest, digest_size=8, salt=seed.to_bytes(4, "little")).digest()
    return digest, int.from_bytes(number, "little", signed=True)


def least_overlap(a: Column, b: Column, percent: int) -> Column:
    """The smallest overlap of sets of sizes a and b that reaches the threshold."""
    return F.ceil((a + b) * percent / F.lit(100.0 + percent) - F.lit(1e-9))


def prefix_length(size: int, percent: int) -> int:
    """So many that two sets at the threshold share ``1 + size // LONGER`` of them."""
    return min(size, size - -(-size * percent // 100) + 1 + size // LONGER)


def least_shared(size: Column) -> Column:
    return F.floor(size / F.lit(LONGER)) + 1


def members_of(rows: DataFrame, words: int, seed: int) -> DataFrame:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column(1), words)
        keys = [_keys(s, seed) for s in sets]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([k for k, _ in keys], pa.binary()), pa.array([n for _, n in keys], pa.int64())],
            names=["doc_id", "size", "key", "node"],
        )

    shape = "doc_id bigint, size bigint, key binary, node bigint"
    return map_batches(rows, work, shape, batch_bytes=TEXT_BYTES)


def frequent_grams(rows: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes met in several texts of one task, with their summed counts: at most MAX_FREQUENT."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = split_batch(batch, "text", TEXT_BYTES)
        sets = [s for part in parts for s in shingle_sets(part.column(1), words)]
        found, counts = np.unique(np.concatenate(sets or [np.zeros(0, np.uint64)]), return_counts=True)
        often = counts >= FREQUENT
        return pa.RecordBatch.from_arrays(
            [pa.array(found[often].view(np.int64)), pa.array(counts[often].astype(np.int64))], names=["gram", "n"]
        )

    counted = map_batches(rows, work, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "gram").limit(MAX_FREQUENT).toArrow()
    grams = top["gram"].to_numpy().view(np.uint64)
    order = np.argsort(grams)
    return grams[order], top["n"].to_numpy()[order]


def rare_first(found: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A set ordered by (frequency in the list, hash)."""
    if not len(grams):
        return found
    at = np.minimum(np.searchsorted(grams, found), len(grams) - 1)
    often = np.where(grams[at] == found, counts[at], 0)
    return found[np.lexsort((found, often))]


def ranges_for(members: DataFrame, percent: int) -> int:
    """Bits of a number of n-gram ranges: enough for all tasks, and for about RANGE_ROWS rows each."""
    total = members.agg(F.sum("size")).first()[0] or 0
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(4 * parts, prefix_length(total, percent) // RANGE_ROWS)
    return max(1, (wanted - 1).bit_length())


def packed(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Rows (gram, node, size, pos) as (part, rows): those of an n-gram range, sorted by n-gram, the first byte
    of each ROW, then the second of each, and so on, as such planes compress."""

    def pack(some: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = np.empty(sum(b.num_rows for b in some), dtype=ROW)
        for k, name in enumerate(ROW.names):
            table[name] = np.concatenate([b.column(k).to_numpy() for b in some]).astype(ROW[name], copy=False)
        table = table[np.argsort(table["gram"])]
        parts = (table["gram"] >> np.uint64(64 - bits)).astype(np.int32)
        starts = np.flatnonzero(np.diff(parts, prepend=-1))
        planes = table.view(np.uint8).reshape(-1, ROW.itemsize)
        rows = [planes[a:b].T.tobytes() for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(table)])]
        return pa.RecordBatch.from_arrays([pa.array(parts[starts]), pa.array(rows, pa.binary())], names=["part", "rows"])

    some, n = [], 0
    for batch in batches:
        some.append(batch)
        n += batch.num_rows
        if n >= PACKED:
            yield pack(some)
            some, n = [], 0
    if n:
        yield pack(some)


def unpacked(rows: list[bytes]) -> np.ndarray:
    planes = [np.frombuffer(r, dtype=np.uint8).reshape(ROW.itemsize, -1) for r in rows]
    return np.ascontiguousarray(np.concatenate(planes, axis=1).T).view(ROW)[:, 0]


def prefixes(rows: DataFrame, words: int, percent: int, seed: int, held, bits: int | None = None) -> DataFrame:
    """gram, node, size, pos for the first n-grams of every class; a class that several tasks
    have comes several times. With ``bits`` the rows are packed for as many ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts = held.value
        seen: set[int] = set()
        for whole in batches:
            for batch in split_batch(whole, "text", TEXT_BYTES):
                out, nodes, sizes, lengths = [], [], [], []
                for found in shingle_sets(batch.column(1), words):
                    if not len(found):
                        continue
                    node = _keys(found, seed)[1]
                    if node in seen:
                        continue
                    seen.add(node)
                    chosen = rare_first(found, grams, counts)[: prefix_length(len(found), percent)]
                    out.append(chosen)
                    nodes.append(node)
                    sizes.append(len(found))
                    lengths.append(len(chosen))
                if out:
                    lengths = np.array(lengths)
                    done = np.cumsum(lengths) - lengths
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(out).view(np.int64)),
                         pa.array(np.repeat(np.array(nodes, dtype=np.int64), lengths)),
                         pa.array(np.repeat(np.array(sizes, dtype=np.int32), lengths)),
                         pa.array((np.arange(lengths.sum()) - np.repeat(done, lengths)).astype(np.int32))],
                        names=["gram", "node", "size", "pos"],
                    )

    if bits is not None:
        return rows.mapInArrow(given_back(lambda batches: packed(run(batches), bits)), "part int, rows binary")
    return rows.mapInArrow(given_back(run), "gram bigint, node bigint, size int, pos int")


def with_neighbours(rows: DataFrame, percent: int) -> DataFrame:
    """gram, node, size, pos, before of the packed rows, each class once, that have a neighbour (the next smaller
    or larger set of the n-gram) of a size that can reach the threshold: other rows have no partner here.
    ``before`` is the smaller one, if it can."""
    near = percent / 100 - 1e-9

    def work(group: pa.Table) -> pa.Table:
        table = unpacked(group["rows"].to_pylist())
        table = table[np.lexsort((table["node"], table["size"], table["gram"]))]
        same = table["gram"][1:] == table["gram"][:-1]
        table = table[np.append(True, ~(same & (table["node"][1:] == table["node"][:-1])))]
        below = np.zeros(len(table) + 1, dtype=bool)
        below[1:-1] = table["gram"][1:] == table["gram"][:-1]
        below[1:-1] &= table["size"][:-1] >= table["size"][1:] * near
        at = np.flatnonzero(below[:-1] | below[1:])
        kept, smaller, without = table[at], table[at - 1], pa.array(~below[at])
        before = pa.StructArray.from_arrays(
            [pa.array(np.ascontiguousarray(smaller[c])) for c in ("size", "node", "pos")], names=["size", "node", "pos"], mask=without
        )
        columns = [pa.array(np.ascontiguousarray(kept["gram"]).view(np.int64))]
        columns += [pa.array(np.ascontiguousarray(kept[c])) for c in ("node", "size", "pos")]
        return pa.Table.from_arrays([*columns, before], names=["gram", "node", "size", "pos", "before"])

    shape = "gram bigint, node bigint, size int, pos int, before struct<size: int, node: bigint, pos: int>"
    return rows.groupBy("part").applyInArrow(work, shape)


def marks_of(nodes: DataFrame) -> np.ndarray:
    """MARKS bits, those at the low ends of the given numbers set: at most MARKS / 64 rows are gathered."""
    spot = F.col("node").bitwiseAND(F.lit(MARKS - 1))
    bit = F.expr("shiftleft(1L, cast(node & 63 as int))")
    marked = nodes.select(F.shiftright(spot, 6).alias("word"), bit.alias("bit"))
    words = marked.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(MARKS // 64, dtype=np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def texts_of(rows: DataFrame, nodes: DataFrame, words: int, seed: int) -> DataFrame:
    """node, text, ranges (counts of the set's hashes in equal ranges) of the wanted classes. Texts
    take half the room of their sets, so texts move and sets are made where they are needed. Most
    texts that are not wanted have no mark and do not move."""
    held = rows.sparkSession.sparkContext.broadcast(marks_of(nodes))

    def name(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column(1), words)
        numbers = np.array([_keys(s, seed)[1] for s in sets], dtype=np.int64)
        low = numbers.view(np.uint64) & np.uint64(MARKS - 1)
        at = np.flatnonzero((held.value[low >> np.uint64(6)] >> (low & np.uint64(63))) & np.uint64(1))
        ranges = [
            np.minimum(0xFFFF, np.bincount((sets[i] >> np.uint64(56)).astype(np.int64), minlength=RANGES)).astype(np.uint16).tobytes()
            for i in at.tolist()
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(numbers[at]), batch.column(1).take(pa.array(at)), pa.array(ranges, pa.binary())],
            names=["node", "text", "ranges"],
        )

    texts = map_batches(rows, name, "node bigint, text string, ranges binary", batch_bytes=TEXT_BYTES)
    return texts.join(nodes.hint("merge"), "node", "left_semi").dropDuplicates(["node"])


def _may_reach(x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Rows of counts whose sets may reach the threshold: the suffix filter."""
    # counts are cut at 16 bits: such a range bounds nothing and counts in full
    shared = np.where((x == 0xFFFF) | (y == 0xFFFF), 1 << 40, np.minimum(x, y)).sum(axis=1, dtype=np.int64)
    both = x.sum(axis=1, dtype=np.int64) + y.sum(axis=1, dtype=np.int64)
    return shared * (100 + percent) >= percent * both


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that reach the threshold. The suffix filter comes first, on the
    small counts; only pairs that it leaves fetch their texts."""
    small = texts.select("node", "ranges")
    counted = pairs.join(small.toDF("a", "ranges_a"), "a").join(small.toDF("b", "ranges_b"), "b")

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, RANGES) for i in (2, 3)
            )
            yield batch.select([0, 1]).filter(pa.array(_may_reach(x, y, percent)))

    likely = cut(counted.select("a", "b", "ranges_a", "ranges_b").mapInArrow(given_back(suffixes), "a bigint, b bigint"), "pairs")
    whole = texts.select("node", "text")
    # only the texts of such pairs move
    first, second = (whole.toDF(s, f"text_{s}").join(likely.select(s).distinct(), s, "left_semi") for s in "ab")
    both = likely.join(second, "b").join(first, "a")

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(*(shingle_sets(batch.column(i), words) for i in (2, 3))):
            shared = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
        return batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return map_batches(
        both.select("a", "b", "text_a", "text_b"), check, "a bigint, b bigint", text="text_a", batch_bytes=TEXT_BYTES
    )


def crowded_pairs(rows: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """a, size_a, pos_a, b, size_b, pos_b of the pairs that share an n-gram which many have, and that the
    filters leave; ``rows`` are (gram, node, size, pos, label, prev, plain, n). The n rows of an n-gram are
    dealt to blocks; each pair of blocks is a group."""
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(float(BLOCK)))).cast("int")
    dealt = (
        rows.join(texts.select("node", "ranges"), "node")
        .withColumns({"blocks": blocks, "block": F.pmod(F.xxhash64("node"), blocks).cast("int")})
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
        .select("gram", "i", "j", "block", "node", "size", "pos", "label", "prev", "plain", "ranges")
    )

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        node, size, pos, label, block = (
            group[c].to_numpy().astype(np.int64) for c in ("node", "size", "pos", "label", "block")
        )
        plain = group["plain"].to_numpy(zero_copy_only=False).astype(bool)
        begun = group["prev"].is_null().to_numpy()
        prev = group["prev"].fill_null(0).to_numpy()
        counts = np.frombuffer(b"".join(group["ranges"].to_pylist()), np.uint16).reshape(-1, RANGES)
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        found = []
        step = max((1 << 18) // max(len(right), 1), 1)
        for start in range(0, len(left), step):
            x, y = left[start : start + step, None], right[None, :]
            keep = (label[x] != label[y]) & (begun[x] | begun[y] | (prev[x] != prev[y]))
            if i == j:
                keep &= x < y
            x_larger = (size[x] > size[y]) | ((size[x] == size[y]) & (node[x] > node[y]))
            keep &= np.where(x_larger, plain[y], plain[x])
            keep &= np.minimum(size[x], size[y]) * 100 >= np.maximum(size[x], size[y]) * percent
            need = np.ceil((size[x] + size[y]) * percent / (100.0 + percent) - 1e-9)
            keep &= np.minimum(pos[x], pos[y]) + np.minimum(size[x] - pos[x], size[y] - pos[y]) >= need
            at_x, at_y = np.nonzero(keep)
            at_x, at_y = left[start + at_x], right[at_y]
            for low in range(0, len(at_x), 1 << 13):
                u, v = at_x[low : low + (1 << 13)], at_y[low : low + (1 << 13)]
                good = _may_reach(counts[u], counts[v], percent)
                larger = (size[u] > size[v]) | ((size[u] == size[v]) & (node[u] > node[v]))
                found.append(np.stack([np.where(larger, u, v)[good], np.where(larger, v, u)[good]]))
        a, b = np.concatenate(found, axis=1) if found else np.zeros((2, 0), dtype=np.int64)
        return pa.table({"a": node[a], "size_a": size[a].astype(np.int32), "pos_a": pos[a].astype(np.int32),
                         "b": node[b], "size_b": size[b].astype(np.int32), "pos_b": pos[b].astype(np.int32)})

    shape = "a bigint, size_a int, pos_a int, b bigint, size_b int, pos_b int"
    return dealt.groupBy("gram", "i", "j").applyInArrow(compare, shape)


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """node, label for all nodes of the links (a, b); equal labels are one component. ``known`` are
    the labels of earlier links, which go on to hold.

    In every pass each label that has a neighbour hooks to the smallest one, and hooks are followed
    two steps further; the number of open labels at least halves. It ends when no link is between
    different labels.
    """
    edges = cut(links.distinct(), "links")
    labels = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("label", F.col("node"))
    if known is not None:
        labels = cut(known.unionByName(labels.join(known, "node", "left_anti")), "labels")
    while True:
        ends = edges.join(labels.toDF("a", "x"), "a").join(labels.toDF("b", "y"), "b").where("x <> y")
        open_ends = cut(
            ends.select(F.inline(F.array(F.struct(F.col("x").alias("x"), F.col("y").alias("y")), F.struct(F.col("y").alias("x"), F.col("x").alias("y"))))),
            "open",
        )
        if open_ends.isEmpty():
            return labels
        hooks = open_ends.groupBy("x").agg(F.min("y").alias("to")).select("x", F.least("x", "to").alias("to"))
        for _ in range(2):
            further = hooks.toDF("to", "beyond")
            hooks = hooks.join(further, "to", "left").select("x", F.coalesce("beyond", "to").alias("to"))
        labels = cut(
            labels.join(hooks.withColumnRenamed("x", "label"), "label", "left")
            .select("node", F.coalesce("to", "label").alias("label")),
            "labels",
        )


def join_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    seed = 0
    while True:
        members = cut(members_of(rows, words, seed), "members")
        classes = cut(
            members.where("size > 0").groupBy("key", "node").agg(F.min("doc_id").alias("least_id")), "classes"
        )
        if classes.groupBy("node").count().where("count > 1").isEmpty():
            break
        seed += 1
    held = docs.sparkSession.sparkContext.broadcast(frequent_grams(rows, words))
    by_gram = Window.partitionBy("gram")
    near = F.lit(percent / 100 - 1e-9)
    packs = prefixes(rows, words, percent, seed, held, ranges_for(members, percent))
    shared = cut(with_neighbours(packs, percent), "prefixes")
    # fewer shared n-grams than two sets at the threshold have in common: no partner at all
    enough = cut(
        shared.groupBy("node", "size").agg(F.count("*").alias("n"))
        .where(F.col("n") >= least_shared(F.col("size"))).select("node"),
        "enough",
    )
    shared = shared.join(enough, "node", "left_semi")
    texts = cut(texts_of(rows, enough, words, seed), "texts")

    def possible(size_a, pos_a, size_b, pos_b, before) -> Column:
        """The filters on lengths and positions; ``before`` is what may be shared earlier."""
        rest = F.least(size_a - pos_a, size_b - pos_b)
        return (F.least(size_a, size_b) * 100 >= F.greatest(size_a, size_b) * percent) & (
            before + rest >= least_overlap(size_a, size_b, percent)
        )

    head = F.col("before")
    first = cut(
        shared.where(F.col("node") != head["node"])
        .where(possible(F.col("size"), F.col("pos"), head["size"], head["pos"], F.least("pos", head["pos"])))
        .select(F.least("node", head["node"]).alias("a"), F.greatest("node", head["node"]).alias("b"))
        .distinct(),
        "first",
    )
    tested = first
    linked = cut(verified(first, texts, words, percent), "links")
    few = linked.count() // FEWER
    labels = components(linked)

    def still_open(rows: DataFrame) -> DataFrame:
        """The rows of n-grams whose sets are still in different components. Labels only merge, so no other
        n-gram opens later. low_... are the smallest (label, size, node, pos), ``n`` is the number of rows."""
        named = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        order = ["label", "size", "node", "pos"]
        by_label = by_gram.orderBy(*order)
        lowest = {f"low_{c}": F.first(c).over(by_label) for c in order}
        return cut(
            named.withColumns({**lowest, "high": F.max("label").over(by_gram), "n": F.count("*").over(by_gram)})
            .where(F.col("low_label") < F.col("high")).drop("high"),
            "unsettled",
        )

    # a pair shares one of these; the n-grams that make prefixes longer are not needed any more
    left = shared.select("gram", "node", "size", "pos").where(F.col("pos") <= F.col("size") - F.ceil(F.col("size") * near))
    left = still_open(left)
    for _ in range(STARS):
        star = (
            left.where(F.col("label") != F.col("low_label"))
            .where(possible(F.col("size"), F.col("pos"), F.col("low_size"), F.col("low_pos"), F.least("pos", "low_pos")))
            .select(F.least("node", "low_node").alias("a"), F.greatest("node", "low_node").alias("b"))
            .distinct()
        )
        star = cut(star.join(tested, ["a", "b"], "left_anti"), "star")
        found = cut(verified(star, texts, words, percent), "links")
        n_found = found.count()
        tested = tested.unionByName(star)
        if n_found:
            labels = components(found, labels)
            left = still_open(left.select("gram", "node", "size", "pos"))
        if n_found <= few:
            break
    # the larger set of a pair comes with its plain prefix, the smaller one with a shorter prefix;
    # both hold the first n-gram that the pair shares. Where both have the same one before, it is not that
    open_grams = cut(
        left.select("gram", "node", "size", "pos", "label", "n")
        .withColumn("plain", F.col("pos") <= F.col("size") - least_overlap(F.col("size"), F.col("size"), percent))
        .withColumn("prev", F.lag("gram").over(Window.partitionBy("node").orderBy("pos"))),
        "crowded",
    )
    thin = open_grams.where(F.col("n") < CROWDED)
    places = [F.col(c) for c in ("size_a", "pos_a", "size_b", "pos_b")]
    joined = (
        thin.select("gram", "node", "size", "pos", "label", "prev").toDF("gram", "a", "size_a", "pos_a", "label_a", "prev_a")
        .join(
            thin.where("plain").select("gram", "node", "size", "pos", "label", "prev")
            .toDF("gram", "b", "size_b", "pos_b", "label_b", "prev_b"),
            "gram",
        )
        .where(
            (F.col("label_a") != F.col("label_b"))
            & (F.col("prev_a").isNull() | F.col("prev_b").isNull() | (F.col("prev_a") != F.col("prev_b")))
            & ((F.col("size_a") > F.col("size_b")) | ((F.col("size_a") == F.col("size_b")) & (F.col("a") > F.col("b"))))
        )
        .where(possible(*places, F.least("pos_a", "pos_b")))
        .select("a", "size_a", "pos_a", "b", "size_b", "pos_b")
    )
    last = (
        joined.unionByName(crowded_pairs(open_grams.where(F.col("n") >= CROWDED), texts, percent))
        .groupBy("a", "b", "size_a", "size_b").agg(F.min("pos_a").alias("pos_a"), F.min("pos_b").alias("pos_b"))
        .where(possible(*places, F.lit(0)))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )
    rest = cut(verified(last.join(tested, ["a", "b"], "left_anti"), texts, words, percent), "links")
    if not rest.isEmpty():
        labels = components(rest, labels)
    named = classes.join(labels, "node", "left").select("key", "least_id", F.coalesce("label", "node").alias("label"))
    least = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    by_key = named.join(least, "label").select("key", "component_id")
    return members.join(by_key, "key", "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


#: The same on small tables, for comparison: all pairs that share an n-gram, and their closure.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 5
         THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
         WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS grams FROM w),
n AS (SELECT doc_id, len(grams) AS size, grams FROM s),
g AS (SELECT doc_id, size, unnest(grams) AS gram FROM n),
p AS (SELECT a.doc_id AS x, b.doc_id AS y FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.size, b.size HAVING 100 * count(*) >= 80 * (a.size + b.size - count(*))),
r AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, p.y FROM r JOIN p ON r.y = p.x)
SELECT n.doc_id, n.size::BIGINT AS n_shingles, min(r.y) AS component_id
FROM n JOIN r ON r.x = n.doc_id GROUP BY n.doc_id, n.size
"""
