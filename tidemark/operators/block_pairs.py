"""Vectors in tight blocks, and the pairs of blocks that can hold similar rows.

``pack`` shuffles every row once: rows are dealt to the nearest of some pivots (from a hash sample of the
vectors, spread out over it), within a large cell by the side of random planes through its
pivot they lie on, and where that is still too many, by hash. Each block is one row of a table: its vectors
as one run of bytes, the other columns as lists, its centre and its spread, the largest angle of a row to
the centre.

``schedule`` lists the pairs of blocks to compare. Two rows at an angle of at most theta lie in blocks whose
centres are at most theta plus both spreads apart; all other pairs of blocks are left out, none that matters
is. Centres are compared in groups of ``GROUP``, two groups at a time.

``meet`` brings the blocks of each pair together, one block with about ``PARTNERS`` others in a task's
group, fewer where there are few pairs for the cores, so a block travels once for every partner the bound
left it, never a row for every block there is.
Only the pivots, and the cells with more rows than a block holds, pass through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.staging import cut

BLOCK_ROWS, BLOCK_BYTES = 8192, 4 << 20
#: Up to so many rows are one block, without a further pass.
SINGLE_ROWS = 4096
MAX_PIVOTS, MAX_PLANES, SAMPLED = 8192, 12, 8
GROUP, PARTNERS, MAX_TASKS = 1024, 16, 20_000
#: Blocks that a table is cut into at least, if they hold LEAST_ROWS; groups of pairs that a core gets at least,
#: if there are so many pairs. Else a few groups keep a few cores busy while the others wait.
LEAST_BLOCKS, LEAST_ROWS, GROUPS_PER_CORE = 16, 1024, 8
ANGLE_SLACK = 1e-3  # far above the float32 error of a product
_SLICE = 2048  # rows taken from a batch at a time
ANGLES = 1 << 20  # angles of rows to pivots or centres that are held at a time


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column as rows x width."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    if len(column) == 0:
        return np.zeros((0, 1), dtype=np.float32)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def with_vectors(batches: Iterator[pa.RecordBatch], most: int = _SLICE) -> Iterator[pa.RecordBatch]:
    """Non-empty batches of up to ``most`` rows without rows that lack a vector.

    Done here rather than by a filter in the plan: an optimizer that moves such a filter below
    the projection that makes the vector has every vector made twice.
    """
    for batch in batches:
        column = batch.column("vec")
        if column.null_count:
            batch = batch.filter(column.is_valid())
        most = min(most, _SLICE)
        for start in range(0, batch.num_rows, most):
            yield batch.slice(start, most)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; a zero row stays zero."""
    wide = rows.astype(np.float64)
    lengths = np.sqrt((wide * wide).sum(axis=1, keepdims=True))
    return np.divide(wide, lengths, out=np.zeros_like(wide), where=lengths > 0)


def rows_at_once(others: int) -> int:
    """So many rows that their angles to the others fit in ``ANGLES``."""
    return max(ANGLES // max(others, 1), 1)


def angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1.0, 1.0))


@dataclass
class Block:
    """A block as the tasks see it: ``table`` holds id and carried columns, row by row."""

    number: int
    table: pa.Table
    vectors: np.ndarray
    center: np.ndarray
    spread: float


@dataclass(frozen=True)
class Packed:
    """Blocks as a frame (block, rows, center, spread, vectors, and a list for each column)."""

    frame: DataFrame
    blocks: int
    columns: tuple[str, ...]
    kinds: tuple[str, ...]

    @property
    def id_type(self) -> str:
        return self.kinds[0]


_FIXED = "block bigint, rows int, center array<float>, spread double, vectors binary"


def _opened(row_of: pa.Table | pa.RecordBatch, at: int, columns: Sequence[str]) -> Block:
    lists = [row_of[c][at].values for c in columns]
    center = row_of["center"][at].values.to_numpy(zero_copy_only=False)
    flat = np.frombuffer(row_of["vectors"][at].as_buffer(), dtype=np.float32)
    return Block(
        row_of["block"][at].as_py(),
        pa.table(dict(zip(columns, lists))),
        flat.reshape(len(lists[0]), -1),
        center,
        row_of["spread"][at].as_py(),
    )


def _closed(rows: pa.Table, columns: Sequence[str]) -> pa.Table:
    """The row of a block from its rows (block, vec, columns)."""
    vectors = np.ascontiguousarray(matrix(rows["vec"]), dtype=np.float32)
    units = unit(vectors)
    center = units.mean(axis=0)
    length = np.linalg.norm(center)
    spread = math.pi
    if length > 0:
        center = center / length
        # a row without direction is similar to none, so it does not widen the block
        cosine = (units @ center)[units.any(axis=1)]
        spread = float(angle(cosine).max()) if len(cosine) else 0.0
    out = {
        "block": pa.array([rows["block"][0].as_py()], pa.int64()),
        "rows": pa.array([rows.num_rows], pa.int32()),
        "center": pa.array([center.astype(np.float32)], pa.list_(pa.float32())),
        "spread": pa.array([spread]),
        "vectors": pa.array([vectors.tobytes()], pa.binary()),
    }
    for name in columns:
        values = rows[name].combine_chunks()
        if isinstance(values, pa.ChunkedArray):
            values = pa.concat_arrays(values.chunks)
        out[name] = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    return pa.table(out)


@dataclass
class _Places:
    """Which block a row belongs to."""

    pivots: np.ndarray | None
    planes: np.ndarray | None = None  # of each cell: how many planes cut it
    full: np.ndarray | None = None  # keys with more rows than a block holds, sorted
    parts: np.ndarray | None = None  # and into how many parts each is split by hash

    def keys(self, units: np.ndarray) -> np.ndarray:
        """Cell and side of the planes of each row, as one number."""
        if self.pivots is None:
            return np.zeros(len(units), dtype=np.int64)
        units = units.astype(np.float32)
        step = rows_at_once(len(self.pivots))
        cell = np.zeros(len(units), dtype=np.int64)
        for at in range(0, len(units), step):
            products = units[at : at + step] @ self.pivots.T
            # the first of those that are equal but for rounding, which differs with the number of rows
            cell[at : at + step] = (products >= products.max(axis=1, keepdims=True) - 1e-6).argmax(axis=1)
        if self.planes is None or not self.planes.any():
            return cell.astype(np.int64) << MAX_PLANES
        normals = np.random.default_rng(11).normal(size=(units.shape[1], MAX_PLANES)).astype(np.float32)
        sides = (units - self.pivots[cell]) @ normals > 0
        sides &= np.arange(MAX_PLANES) < self.planes[cell][:, None]
        return (cell.astype(np.int64) << MAX_PLANES) + sides @ (1 << np.arange(MAX_PLANES))

    def blocks(self, units: np.ndarray, hashed: np.ndarray) -> np.ndarray:
        keys = self.keys(units)
        part = np.zeros(len(keys), dtype=np.int64)
        if self.full is not None and len(self.full):
            at = np.minimum(np.searchsorted(self.full, keys), len(self.full) - 1)
            part = np.where(self.full[at] == keys, np.mod(hashed, self.parts[at]), 0)
        return (keys << 24) + part


def _pivots(rows: DataFrame, count: int, n: int) -> np.ndarray:
    """Pivots that cover the vectors: picked from a hash sample of SAMPLED for each, the next ones with a
    chance that grows with the squared distance to those there are (Bahmani et al. 2012).

    The first filter keeps some 2 * SAMPLED * count rows of the whole table, so the sort is small. The
    sample only decides where rows are compared.
    """
    share = max(n // (2 * SAMPLED * count), 1)
    sampled = rows.where((F.pmod("h", F.lit(share)) == 0) & F.col("vec").isNotNull())
    picked = sampled.orderBy("h", "id").limit(SAMPLED * count).select("vec").toArrow()
    found = unit(matrix(picked.column("vec"))).astype(np.float32)
    found = found[found.any(axis=1)]
    if len(found) <= 1:
        return found
    rng = np.random.default_rng(5)
    chosen = [0]
    apart = np.maximum(1 - found @ found[0], 0)
    while len(chosen) < count and apart.max() > 1e-6:
        some = min(max(count // 64, 1), count - len(chosen), int((apart > 1e-6).sum()))
        weight = np.where(apart > 1e-6, apart, 0).astype(np.float64)
        new = rng.choice(len(found), size=some, replace=False, p=weight / weight.sum())
        chosen += new.tolist()
        apart = np.minimum(apart, np.maximum(1 - (found @ found[new].T).max(axis=1), 0))
    return found[chosen]


def _counted(rows: DataFrame, places: _Places) -> DataFrame:
    """(key, n): rows by cell and planes, added up in the tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in with_vectors(batches):
            for key, n in zip(*np.unique(places.keys(unit(matrix(batch.column("vec")))), return_counts=True)):
                seen[int(key)] = seen.get(int(key), 0) + int(n)
        keys = pa.array(list(seen), pa.int64())
        yield pa.RecordBatch.from_arrays([keys, pa.array(list(seen.values()), pa.int64())], ["key", "n"])

    return rows.select("vec").mapInArrow(count, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def pack(
    rows: DataFrame,
    carry: Sequence[str] = (),
    *,
    tight: bool = True,
    block_rows: int | None = None,
    max_pivots: int = MAX_PIVOTS,
    rows_per_pivot: int | None = None,
    written: bool = False,
) -> Packed:
    """Blocks of ``rows`` (id, vec, h, carried columns); rows without a vector are left out.

    Without ``tight`` blocks are dealt by hash alone. ``written`` says that the rows are stored
    already and can be read several times.
    """
    columns = ("id", *carry)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    n = rows.count()
    places = _Places(None)
    if block_rows is None and n <= SINGLE_ROWS:
        blocks = 1
    else:
        rows = rows if written else cut(rows)
        width = rows.agg(F.max(F.size("vec"))).first()[0] or 1
        block = block_rows or max(min(BLOCK_ROWS, BLOCK_BYTES // (4 * width), max(n // LEAST_BLOCKS, LEAST_ROWS)), 1)
        wanted = min(n // (rows_per_pivot or block), max_pivots)
        if tight and wanted > 1:
            places = _Places(_pivots(rows, wanted, n))
            if len(places.pivots) < 2:
                places = _Places(None)
        if places.pivots is not None:
            planes = np.zeros(len(places.pivots), dtype=np.int64)
            for key, size in _counted(rows, places).where(F.col("n") > block).collect():
                planes[key >> MAX_PLANES] = min(math.ceil(math.log2(size / block)), MAX_PLANES)
            places.planes = planes
        # fewer than n / block keys
        full = sorted(tuple(r) for r in _counted(rows, places).where(F.col("n") > block).collect())
        places.full = np.array([key for key, _ in full], dtype=np.int64)
        places.parts = np.array([math.ceil(size / block) for _, size in full], dtype=np.int64)
        blocks = max(n // block, 2)
    shared = rows.sparkSession.sparkContext.broadcast(places)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in with_vectors(batches):
            hashed = batch.column("h").to_numpy(zero_copy_only=False)
            numbers = shared.value.blocks(unit(matrix(batch.column("vec"))), hashed)
            kept = batch.select(["vec", *columns])
            yield pa.RecordBatch.from_arrays([pa.array(numbers), *kept.columns], ["block", "vec", *columns])

    listed = ", ".join(f"`{c}` {kinds[c]}" for c in columns)
    dealt = rows.mapInArrow(deal, f"block bigint, vec {kinds['vec']}, {listed}")
    dealt = dealt.repartition(_tasks(rows, blocks), "block")
    shape = _FIXED + "".join(f", `{c}` array<{kinds[c]}>" for c in columns)
    frame = dealt.groupBy("block").applyInArrow(lambda part: _closed(part, columns), shape)
    if blocks > 1:
        frame = cut(frame)
        blocks = frame.count()
    return Packed(frame, blocks, columns, tuple(kinds[c] for c in columns))


def _tasks(df: DataFrame, units: int) -> int:
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(min(units, max(2 * cores, min(units // 8, MAX_TASKS))), 1)


# -- which blocks meet -----------------------------------------------------------------------


def _within(a: pa.Table, b: pa.Table, theta: float) -> tuple[np.ndarray, np.ndarray]:
    if not a.num_rows or not b.num_rows:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    centers = [matrix(t["center"]).astype(np.float64) for t in (a, b)]
    spreads = [t["spread"].to_numpy() for t in (a, b)]
    apart = angle(centers[0] @ centers[1].T)
    return np.nonzero(apart <= spreads[0][:, None] + spreads[1][None, :] + theta + ANGLE_SLACK)


def schedule(left: Packed, right: Packed | None, theta: float) -> DataFrame:
    """(a, b): the numbers of blocks to compare; within one set of blocks each pair once, a <= b."""
    groups = [max(math.ceil(side.blocks / GROUP), 1) for side in (left, right or left)]

    def centers(side: Packed, count: int, name: str) -> DataFrame:
        group = F.pmod(F.xxhash64("block"), F.lit(count)).cast("int")
        return side.frame.select(F.lit(name).alias("side"), group.alias("group"), "block", "center", "spread")

    if right is None:
        other = F.explode(F.sequence(F.lit(0), F.lit(groups[0] - 1)))
        all_centers = centers(left, groups[0], "a").withColumn("other", other)
        low, high = F.least("group", "other"), F.greatest("group", "other")
        units = all_centers.select(low.alias("low"), high.alias("high"), "group", "side", "block", "center", "spread")
    else:
        to_right = F.explode(F.sequence(F.lit(0), F.lit(groups[1] - 1)))
        to_left = F.explode(F.sequence(F.lit(0), F.lit(groups[0] - 1)))
        a = centers(left, groups[0], "a").withColumn("high", to_right).withColumn("low", F.col("group"))
        b = centers(right, groups[1], "b").withColumn("low", to_left).withColumn("high", F.col("group"))
        units = a.unionByName(b)
    itself = right is None

    def compare(unit_rows: pa.Table) -> pa.Table:
        numbers = unit_rows["block"].to_numpy()
        group, side = unit_rows["group"].to_numpy(), np.array(unit_rows["side"].to_pylist())
        if itself:
            first, second = group == unit_rows["low"][0].as_py(), group == unit_rows["high"][0].as_py()
        else:
            first, second = side == "a", side == "b"
        at = np.flatnonzero(first), np.flatnonzero(second)
        i, j = _within(unit_rows.take(pa.array(at[0])), unit_rows.take(pa.array(at[1])), theta)
        a, b = numbers[at[0]][i], numbers[at[1]][j]
        if itself:
            if unit_rows["low"][0].as_py() == unit_rows["high"][0].as_py():
                once = a <= b
                a, b = a[once], b[once]
            a, b = np.minimum(a, b), np.maximum(a, b)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return units.groupBy("low", "high").applyInArrow(compare, "a bigint, b bigint")


def dealing(pairs: int, cores: int) -> tuple[int, int]:
    """Partners of a block in one group, and tasks: twice the groups, as groups fall to tasks by hash."""
    partners = min(max(pairs // (GROUPS_PER_CORE * cores), 1), PARTNERS)
    return partners, max(min(2 * math.ceil(pairs / partners), MAX_TASKS), 1)


def fresh(df: DataFrame) -> DataFrame:
    """The same columns under identities of their own, for a frame that meets its own source."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


Work = Callable[[Block, Block, bool], Iterator[pa.Table]]


def _met(work: Work, a: Block, b: Block, same: bool) -> Iterator[pa.RecordBatch]:
    for found in work(a, b, same):
        yield from found.combine_chunks().to_batches(max_chunksize=1 << 16)


def meet(left: Packed, right: Packed | None, theta: float, work: Work, schema: str) -> DataFrame:
    """``work(a, b, same)`` on every scheduled pair of blocks; ``same`` for a block with itself.

    What ``work`` yields goes out piece by piece: a task holds the blocks of one group and one piece,
    however many rows the pairs of blocks give. Both sides carry the same columns.
    """
    columns = left.columns
    itself = right is None
    if itself and left.blocks == 1:

        def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    block = _opened(batch, at, columns)
                    yield from _met(work, block, block, True)

        return left.frame.mapInArrow(alone, schema)
    other = right or left
    if left.blocks == 1 and other.blocks == 1:
        tasks = 1
        numbered = F.lit(0).cast("bigint").alias("a"), F.lit(0).alias("part")
        home, guests = left.frame.select(*numbered, "*"), other.frame.select(*numbered, "*")
    else:
        pairs = cut(schedule(left, right, theta))
        together, tasks = dealing(pairs.count(), pairs.sparkSession.sparkContext.defaultParallelism)
        partners = F.count("*").over(Window.partitionBy("a"))
        parts = F.ceil(partners / F.lit(together))
        dealt = pairs.withColumn("part", F.pmod(F.xxhash64("b"), parts).cast("int"))
        home = dealt.select("a", "part").distinct().join(left.frame.withColumn("a", F.col("block")), "a")
        guests = dealt.withColumnRenamed("b", "block").join(other.frame, "block")
    units = fresh(home.withColumn("guest", F.lit(False))).unionByName(fresh(guests.withColumn("guest", F.lit(True))))

    def bring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, early = None, []
        for batch in batches:
            for at in range(batch.num_rows):
                block = _opened(batch, at, columns)
                if batch["guest"][at].as_py():
                    early.append(block)
                else:
                    host = block
                while host is not None and early:
                    guest = early.pop()
                    yield from _met(work, host, guest, itself and guest.number == host.number)

    return units.repartition(tasks, "a", "part").groupBy("a", "part").applyInArrow(bring, schema)
