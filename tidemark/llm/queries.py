"""The operators of this folder as queries over whole tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    decontaminate,
    fill_in_middle,
    filter_audit,
    language_id,
    license_scan,
    line_dedup,
    lm_score,
    ngram_join,
    sentencepiece_codec,
    simhash,
    suffix_dedup,
    token_counts,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.op1(table(spark, sf_dir, "documents"))


@query
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_components(table(spark, sf_dir, "documents"))


ORACLES["op2_ngram_join"] = ngram_join.ORACLE


@query
def op3_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.op3(table(spark, sf_dir, "documents"))


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.op4(table(spark, sf_dir, "documents"))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.op6(table(spark, sf_dir, "pages"))


ORACLES["op6_warc"] = warc.ORACLE


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents"))


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.op8(table(spark, sf_dir, "documents"))


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.op10(table(spark, sf_dir, "documents"))


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.op11(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op11_filter_audit"] = filter_audit.ORACLE


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.op12(table(spark, sf_dir, "documents"))


ORACLES["op12_fill_in_middle"] = fill_in_middle.ORACLE


@query
def op13_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.op13(table(spark, sf_dir, "documents"))
