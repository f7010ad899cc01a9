"""Bring this package to the Python workers of a session that was started anywhere."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent
_ADDED = "tidemark.shipped"


def ship(spark: SparkSession) -> None:
    """Send the package to all workers, once in a session. Spark's driver serves the file."""
    if spark.conf.get(_ADDED, None) == str(PACKAGE):
        return
    path = Path(tempfile.mkdtemp(prefix="tidemark-code-")) / "tidemark_code.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(PACKAGE.rglob("*.py")):
            archive.write(file, file.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(str(path))
    spark.conf.set(_ADDED, str(PACKAGE))


def shipped(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    @functools.wraps(fn)
    def run(spark: SparkSession, *args, **kwargs) -> DataFrame:
        ship(spark)
        return fn(spark, *args, **kwargs)

    return run
