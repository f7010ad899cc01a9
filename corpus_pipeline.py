"""From the documents table to a tokenised training set, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it as Parquet below the
shared folder and hands the reread table to the next. All but the last return the columns of
documents. A row is known by its doc_id: rows that repeat one are the same document and stay or go
together; rows with a null doc_id are never a duplicate of another. Null and empty texts do not
pass language identification. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language_id, line_dedup, ngram_join, sentencepiece_codec
from tidemark.llm.shared import cut

#: SQL cannot express the learned and the approximate stages; tests/llm compares each with a
#: brute-force version.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised with a posterior of one half or more."""
    return language_id.keep_identified(docs)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the line blocks that an earlier document has; one that has nothing left
    goes."""
    return line_dedup.keep_rest(docs)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest doc_id."""
    found = cut(ngram_join.join_components(docs), "groups")
    # written first, so that their real size decides whether texts have to be shuffled to leave them out
    copies = cut(found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct(), "copies")
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark table."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids, their number, and whether decoding them gives the text back."""
    return sentencepiece_codec.round_trip(docs).select(
        "doc_id",
        "ids",
        F.size("ids").cast("bigint").alias("n_tokens"),
        (F.col("decoded") == F.col("text")).alias("exact"),
    )


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", remove_repeated_lines),
    ("ngram_join", remove_near_duplicates),
    ("decontamination", remove_contaminated),
    ("sentencepiece", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
