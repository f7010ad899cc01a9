"""Small plan helpers used by several operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A key is hot with more than HOT_ROWS rows and more than 1/MAX_HOT_KEYS of all rows, so there
# are never more than MAX_HOT_KEYS of them.
HOT_ROWS = 200_000
MAX_HOT_KEYS = 10_000


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Only a local master may go without one; it gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and go on from there.

    Used where several passes read a result that is expensive to work out again. As a Parquet
    table it is read column by column, and its size is known to the planner.
    """
    path = f"{scratch_folder(df.sparkSession).rstrip('/')}/tidemark/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """A frame read straight from storage, over at least as many tasks as there are cores.

    For work that is heavy per row on input of few splits (one large row group, whole-file
    records). Input of many splits is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def merge_rows(*frames: DataFrame) -> DataFrame:
    """Put one-row frames with different columns side by side.

    The rows are stacked and folded with "any non-null value", so no product of frames is needed.
    A frame that happens to be empty leaves nulls.
    """
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])


def _hot_limit(counted: DataFrame, count_col: str, hot_rows: int) -> Column:
    share = counted.agg(F.sum(count_col).alias("rows")).scalar() / F.lit(MAX_HOT_KEYS)
    return F.greatest(F.lit(float(hot_rows)), F.coalesce(share, F.lit(0.0)))


def most_counted(counted: DataFrame, count_col: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The hot keys: never more than MAX_HOT_KEYS rows, whatever the size of the data."""
    return counted.where(F.col(count_col) > _hot_limit(counted, count_col, hot_rows))


def join_counted(
    big: DataFrame,
    counted: DataFrame,
    on: Sequence[str] | str,
    count_col: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Inner join of ``big`` with one row per key, where a key may hold much of ``big``.

    ``counted`` tells how many rows of ``big`` each key has. Hot keys are at most MAX_HOT_KEYS,
    so that side is broadcast and their rows never move; all other keys take the ordinary
    shuffle join.
    """
    keys = [on] if isinstance(on, str) else list(on)
    hot = most_counted(counted, count_col, hot_rows)
    cold = counted.where(F.col(count_col) <= _hot_limit(counted, count_col, hot_rows))
    hot_part = big.join(F.broadcast(hot), keys)
    cold_part = big.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    return hot_part.unionByName(cold_part)


def add_blocks(partial: DataFrame) -> DataFrame:
    """Sums by (key, block) of rows (key, block, rows, sums), element by element.

    Every task of the source gives a row for each key and block; they are added as they arrive, so
    a task holds one sum for each of its blocks, however many rows there are.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("key", "block", "rows"))
            lists = batch.column("sums")
            for at, (key, block, rows) in enumerate(zip(*columns)):
                part = lists[at].values.to_numpy(zero_copy_only=False)
                if (key, block) in held:
                    held[key, block][0] += rows
                    held[key, block][1] += part
                else:
                    held[key, block] = [rows, part.copy()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([key for key, _ in held], pa.int32()),
                pa.array([block for _, block in held], pa.int32()),
                pa.array([rows for rows, _ in held.values()], pa.int64()),
                pa.array([total for _, total in held.values()], pa.list_(pa.float64())),
            ],
            ["key", "block", "rows", "sums"],
        )

    shape = "key int, block int, rows bigint, sums array<double>"
    return partial.repartition("key", "block").mapInArrow(add, shape)
