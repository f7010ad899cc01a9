"""Recurring checks without a scheduler: the batch operators applied to arriving documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.encoders import Encoder
from tidemark.operators import quality
from tidemark.plans.history import History
from tidemark.sources.embeddings import VectorTable, flat_metadata


def pass_rate_windows(
    checks: DataFrame, width: str = "1 day", late: str = "1 day"
) -> DataFrame:
    """Pass rate per time window of a stream (or batch) of checks; late rows are let in."""
    return (
        checks.withWatermark("checked_at", late)
        .groupBy(F.window("checked_at", width).alias("w"))
        .agg(F.count("passed").alias("total"), F.count_if("passed").alias("passed"))
        .select(
            F.col("w.start").alias("start"),
            "total",
            "passed",
            F.round(F.col("passed") / F.col("total") * 100, 4).alias("pass_rate"),
        )
    )


def watch_documents(
    documents: DataFrame,
    vectors: VectorTable,
    history: History,
    encoder: Encoder,
    checkpoint: str,
    on_checks: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """For every batch of arriving documents: encode and upsert them, check them, keep the result.

    The stream's own id, which its checkpoint keeps, and the batch number name the embedding batch
    and the run. A batch that is tried again after a failure replaces its own output, and no other
    writer's. Beside the vectors the table keeps content, metadata and time of ingestion where
    the documents have them.
    """
    spark = documents.sparkSession

    def handle(batch: DataFrame, number: int) -> None:
        run_id = f"stream-{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{number}"
        encoded = encoder(batch.select("doc_id", "content")).select("doc_id", "embedding")
        whole = {"source_path", "metadata", "ingested_at"} <= set(batch.columns)
        kept = [c for c in ("content", "metadata", "ingested_at") if c in batch.columns]
        described = (flat_metadata(batch) if whole else batch).select("doc_id", *kept)
        vectors.put(described.dropDuplicates(["doc_id"]).join(encoded, "doc_id"), writer=run_id)
        checks = quality.all_checks(batch, checked_at=F.current_timestamp())
        history.replace("quality_checks", checks, run_id)
        if on_checks is not None:
            on_checks(history.of_run("quality_checks", run_id))

    return (
        documents.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def parquet_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)
