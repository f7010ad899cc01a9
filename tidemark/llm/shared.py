"""Helpers of the operators in this folder: shared tables, byte batches, hashing."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.

    Only a local master may go without one; it then gets a temporary folder, set for the session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_folder(spark)}/llm/{what}-{uuid.uuid4().hex}"


def cut(df: DataFrame, what: str = "table") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and go on from there: later steps read it
    several times, and a lost executor costs a task of the reader, not the whole history."""
    path = new_folder(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int]:
    """The C library's call that returns free memory to the system; not every one has it."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return lambda pad: 0


def given_back(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` of a task, after which the memory that it freed goes back to the system. Workers wait for
    tasks of other stages, and the allocators would keep the peak of each for as long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        _trim()(0)

    return run


def map_batches(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str,
    text: str = "text", batch_bytes: int = 8 << 20, done: Callable[[], None] | None = None,
) -> DataFrame:
    """``work`` on Arrow batches of about ``batch_bytes`` of text each; one text is never split.
    ``done`` is called at the end of each task: workers are used again, by other stages too, and
    would otherwise hold what a task gathered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in split_batch(batch, text, batch_bytes):
                out = work(part)
                if out is not None and out.num_rows:
                    yield out
        if done is not None:
            done()

    return df.mapInArrow(given_back(run), schema)


def split_batch(batch: pa.RecordBatch, text: str, batch_bytes: int) -> Iterator[pa.RecordBatch]:
    lengths = byte_lengths(batch.column(batch.schema.get_field_index(text)))
    ends = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + batch_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def byte_lengths(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def mix(h: np.ndarray) -> np.ndarray:
    """The finishing steps of a 64-bit hash (wrapping multiplication is meant)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class PrefixHash:
    """64-bit hashes of any ranges of a byte array, from one running sum."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        terms = (mix(data.astype(np.uint64) + np.uint64(1))) * powers(_BASE, n)
        np.cumsum(terms, out=self.sums[1:])
        self.down = powers(_BASE_INVERSE, n + 1)

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
