"""Similar pairs by random hyperplanes: a candidate join that finds most pairs at a fixed number of copies.

An alternative to ``similarity.similarity_join``, which stays the default and finds all. Every vector gets
a signature for each of several tables: the sides of ``bits`` random planes it lies on. Two vectors at angle a
agree in a table with probability (1 - a/pi)^bits (Charikar 2002), so the number of tables follows from the
recall wanted at the threshold; pairs that are more similar are found more surely. Rows that agree in a table
meet in a bucket and are compared exactly there: no pair below the threshold is ever given. A pair is given by
the first table in which it agrees and by no other, which needs no second shuffle to tell repetitions.

A row is sent once for each table, however many rows there are. Buckets of a table travel in groups of some
``GROUP_ROWS`` rows and are compared one by one within them; the planes are made once for a worker, and the
tables before are looked at only for pairs at the threshold. A bucket of more than ``BUCKET_ROWS`` rows is
dealt into parts that meet two at a time; only such buckets pass through the driver, fewer than tables * rows /
BUCKET_ROWS.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.block_pairs import Block, matrix, unit, with_vectors
from tidemark.operators.similarity import hits

BUCKET_ROWS = 4096
#: Rows of a bucket that a join aims at: larger buckets need fewer tables, so rows are sent less often.
IN_BUCKET = 512
GROUP_ROWS = 4096
MAX_TABLES = 512
#: Buckets that a task counts in an array, and rows whose sides of all planes are held at a time.
COUNTED, SIDES = 1 << 22, 256
_PAIRS = 1 << 14


@functools.lru_cache(maxsize=2)
def _normals(width: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(width, count)).astype(np.float32).astype(np.float64)


@dataclass(frozen=True)
class Planes:
    """How signatures are made: ``tables`` of ``bits`` planes each."""

    bits: int
    tables: int
    seed: int = 3

    @classmethod
    def of(cls, threshold: float, recall: float, rows: int, per_bucket: int = 64) -> "Planes":
        """Planes that find pairs at the threshold with this recall; as many bits as leave some
        ``per_bucket`` rows of evenly spread data in a bucket, fewer if that took over MAX_TABLES tables."""
        if not 0 < recall < 1 or not -1 < threshold < 1:
            raise ValueError("recall has to be between 0 and 1, the threshold between -1 and 1")
        agree = 1 - math.acos(threshold) / math.pi
        for bits in range(max(min(round(math.log2(max(rows, 1) / per_bucket)), 30), 1), 0, -1):
            tables = math.ceil(math.log(1 - recall) / math.log(1 - agree**bits))
            if tables <= MAX_TABLES:
                return cls(bits, tables)
        raise ValueError("no number of tables gives this recall")

    def recall(self, similarity: float) -> float:
        """Chance that a pair of this similarity is found."""
        agree = 1 - math.acos(min(max(similarity, -1), 1)) / math.pi
        return 1 - (1 - agree**self.bits) ** self.tables

    def signatures(self, units: np.ndarray, tables: int | None = None) -> np.ndarray:
        """rows x tables, for the first ``tables`` if given. In double precision: a row has to be on the same side
        of a plane wherever it is looked at."""
        tables = self.tables if tables is None else tables
        normals = _normals(units.shape[1], self.tables * self.bits, self.seed)[:, : tables * self.bits]
        out = np.empty((len(units), tables), dtype=np.int64)
        for at in range(0, len(units), SIDES):
            some = units[at : at + SIDES]
            sides = (some @ normals > 0).reshape(len(some), tables, self.bits)
            out[at : at + SIDES] = sides.astype(np.float64) @ 2.0 ** np.arange(self.bits)
        return out


def _buckets(rows: DataFrame, planes: Planes, full: dict[int, int], n_rows: int) -> DataFrame:
    """(unit, bucket, low, high, part, right, id, vec): every row once for each unit in which it is compared. A
    full bucket is a unit of its own, others share one."""
    units = max(n_rows // GROUP_ROWS, 1)
    keys = np.array(sorted(full), dtype=np.int64)
    parts = np.array([full[k] for k in keys.tolist()], dtype=np.int64)
    shared = rows.sparkSession.sparkContext.broadcast((keys, parts))
    kind = rows.schema["id"].dataType.simpleString()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, parts = shared.value
        for batch in with_vectors(batches):
            signatures = planes.signatures(unit(matrix(batch.column("vec"))))
            hashed = batch.column("h").to_numpy(zero_copy_only=False)
            for table in range(planes.tables):
                bucket = (np.int64(table) << 32) + signatures[:, table]
                count = np.ones(len(bucket), dtype=np.int64)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, bucket), len(keys) - 1)
                    count = np.where(keys[at] == bucket, parts[at], 1)
                own = np.mod(hashed, count)
                row = np.repeat(np.arange(len(bucket)), count)
                other = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                low, high = np.minimum(own[row], other), np.maximum(own[row], other)
                unit_of = np.where(count > 1, -1 - bucket, (np.int64(table) << 32) + signatures[:, table] % units)
                taken = batch.select(["right", "id", "vec"]).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c) for c in (unit_of[row], bucket[row], low, high, own[row])), *taken.columns],
                    ["unit", "bucket", "low", "high", "part", "right", "id", "vec"],
                )

    shape = "unit bigint, bucket bigint, low bigint, high bigint, part bigint, right boolean"
    shape += f", id {kind}, vec array<float>"
    return rows.mapInArrow(emit, shape)


def _sizes(rows: DataFrame, planes: Planes) -> DataFrame:
    in_array = planes.tables << planes.bits <= COUNTED

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((planes.tables << planes.bits) * in_array, dtype=np.int64)
        for batch in with_vectors(batches):
            signatures = planes.signatures(unit(matrix(batch.column("vec"))))
            if in_array:
                flat = signatures + (np.arange(planes.tables, dtype=np.int64) << planes.bits)
                found, n = np.unique(flat, return_counts=True)
                seen[found] += n
                continue
            buckets = signatures + (np.arange(planes.tables, dtype=np.int64) << 32)
            found, n = np.unique(buckets, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["bucket", "n"])
        met = np.flatnonzero(seen)
        buckets = (met >> planes.bits << 32) + (met & ((1 << planes.bits) - 1))
        yield pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(seen[met])], ["bucket", "n"])

    counted = rows.mapInArrow(count, "bucket bigint, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def _first(planes: Planes, vectors: np.ndarray, i: np.ndarray, j: np.ndarray, table: int) -> np.ndarray:
    """Which of the pairs agree in no table before this one."""
    at, place = np.unique(np.concatenate([i, j]), return_inverse=True)
    before = planes.signatures(unit(vectors[at]), table)
    new = np.empty(len(i), dtype=bool)
    for low in range(0, len(i), _PAIRS):
        some = slice(low, low + _PAIRS)
        new[some] = (before[place[: len(i)][some]] != before[place[len(i) :][some]]).all(axis=1)
    return new


def candidate_join(
    left: DataFrame,
    right: DataFrame | None = None,
    *,
    threshold: float,
    recall: float = 0.95,
    planes: Planes | None = None,
    id_col: str = "doc_id",
    vec_col: str = "embedding",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Pairs with cosine similarity >= threshold, each found with a chance of ``recall`` or more: (id_a,
    id_b, similarity). Without ``right`` a self join with id_a < id_b. Both inputs have to be stored: they are read
    twice. Vectors without direction are found with none."""

    def side(df: DataFrame, is_right: bool) -> DataFrame:
        return df.select(
            F.lit(is_right).alias("right"),
            F.col(id_col).alias("id"),
            F.col(vec_col).cast("array<float>").alias("vec"),
            F.xxhash64(F.col(id_col)).alias("h"),
        )

    rows = side(left, False) if right is None else side(left, False).unionByName(side(right, True))
    n_rows = rows.count()
    planes = planes or Planes.of(threshold, recall, n_rows, IN_BUCKET)
    heavy = _sizes(rows, planes).where(F.col("n") > bucket_rows).collect()
    full = {r.bucket: math.ceil(r.n / bucket_rows) for r in heavy}
    itself = right is None
    kind = rows.schema["id"].dataType.simpleString()

    def compare(rows_here: pa.Table) -> pa.Table:
        id_kind = rows_here.schema.field("id").type
        rows_here = rows_here.sort_by("bucket")
        bucket = rows_here["bucket"].to_numpy()
        table = int(bucket[0]) >> 32
        low, high = rows_here["low"][0].as_py(), rows_here["high"][0].as_py()
        part, of_right = rows_here["part"].to_numpy(), rows_here["right"].to_numpy()
        if itself:
            pairs = [(part == low, part == high)]
        else:
            pairs = [((part == a) & ~of_right, (part == b) & of_right) for a, b in {(low, high), (high, low)}]
        ids = rows_here["id"].to_numpy()
        vectors = matrix(rows_here["vec"]).astype(np.float32)
        axis = np.zeros(vectors.shape[1], dtype=np.float32)
        borders = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
        found: list[tuple] = []
        for start, end in zip(borders, borders[1:]):
            for mine, theirs in pairs:
                at = np.flatnonzero(mine[start:end]) + start, np.flatnonzero(theirs[start:end]) + start
                if not len(at[0]) or not len(at[1]):
                    continue
                sides = [Block(k, None, vectors[a], axis, math.pi) for k, a in enumerate(at)]
                for i, j, similarity in hits(*sides, threshold):
                    i, j = at[0][i], at[1][j]
                    if itself:
                        once = (ids[i] < ids[j]) if low == high else (ids[i] != ids[j])
                        i, j, similarity = i[once], j[once], similarity[once]
                    first = _first(planes, vectors, i, j, table)
                    a, b = ids[i[first]], ids[j[first]]
                    if itself:
                        a, b = np.where(a < b, a, b), np.where(a < b, b, a)
                    found.append((a, b, similarity[first]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [[], [], []]
        kinds = (id_kind, id_kind, pa.float64())
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["id_a", "id_b", "similarity"])

    return (
        _buckets(rows, planes, full, n_rows)
        .groupBy("unit", "low", "high")
        .applyInArrow(compare, f"id_a {kind}, id_b {kind}, similarity double")
    )
