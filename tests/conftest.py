from __future__ import annotations

import os
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = (
        SparkSession.builder.master(os.environ.get("TEST_MASTER", "local[8]"))
        .appName("tidemark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def vectors(spark: SparkSession):
    """Build an embedding frame from a matrix; ids are zero-padded so they sort as numbers."""

    def build(rows: np.ndarray, prefix: str = "d") -> DataFrame:
        data = [
            (f"{prefix}{i:05d}", i, [float(x) for x in row])
            for i, row in enumerate(np.asarray(rows, dtype=np.float32))
        ]
        return spark.createDataFrame(data, "doc_id string, pos bigint, embedding array<float>")

    return build


@pytest.fixture
def docs(spark: SparkSession):
    """Build a document frame from texts (or from (id, text) pairs)."""

    def build(texts: list) -> DataFrame:
        data = [
            (f"d{i:05d}", t, i) if isinstance(t, str) else (t[0], t[1], i)
            for i, t in enumerate(texts)
        ]
        return spark.createDataFrame(data, "doc_id string, content string, pos bigint")

    return build
