"""The operators as queries over the test tables: name -> (spark, folder) -> DataFrame.

Every query reads whole tables. Results are plain columns (lists joined to text, times as text)
so that they can be compared with ``oracles.ORACLES``, which computes the same in SQL. The tables
hold no English negations, no dates and no blank texts; where an operator looks for those, a
sentence made from the row's own columns is added first, on both sides alike.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import text, vectors
from tidemark.functions.encoders import hashed_terms, term_vector
from tidemark.operators import alerts, drift, quality, rag, risks
from tidemark.operators.candidates import candidate_join
from tidemark.operators.nearest import cell_knn, knn_join, packed_documents
from tidemark.operators.similarity import similarity_join
from tidemark.operators.staging import cut, scratch_folder, spread
from tidemark.params import DriftParams, Params, QualityParams, RagParams, RiskParams
from tidemark.plans import history, report
from tidemark.plans.run import Findings, findings_by_family, measure
from tidemark.sources import alert_sink, files
from tidemark.sources.embeddings import VectorTable, embed_missing, in_window, merge_latest

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.datetime(2024, 1, 31)
WIDTH = 64
SIMILAR = RiskParams(similarity=0.2, radius=0.75, min_neighbors=8)
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, content: str = "text") -> DataFrame:
    """The documents table in the form the operators take."""
    return spread(table(spark, sf_dir, "documents")).select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.expr(content).alias("content"),
        F.col("doc_id").alias("pos"),
        "lang",
        "source",
        "n_chars",
    )


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("doc_id"),
        F.col("vec_id").alias("pos"),
        "embedding",
        "label",
    )


def baseline_and_current(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    vecs = embeddings(spark, sf_dir)
    return (
        vecs.where("label < 5").select("doc_id", "embedding"),
        vecs.where("label >= 5").select("doc_id", "embedding"),
    )


NEGATED = (
    "concat(text, CASE lang WHEN 'fr' THEN ' This is not final.' "
    "WHEN 'de' THEN ' It was Deprecated, it is FALSE and no longer used.' "
    "WHEN 'es' THEN ' Knot and cannotation are plain words.' ELSE '' END)"
)
DATED = (
    "concat(text, CASE lang "
    "WHEN 'en' THEN concat(' Updated 20', 15 + doc_id % 10, '-0', 1 + doc_id % 9, '-', "
    "10 + doc_id % 20, ' and in 2016.') "
    "WHEN 'fr' THEN concat(' Seen on March ', 1 + doc_id % 28, ', 20', 18 + doc_id % 6, '.') "
    "WHEN 'de' THEN concat(' From ', 1 + doc_id % 28, ' sept 20', 20 + doc_id % 4, ', not 2021/02/30.') "
    "ELSE ' Undated.' END)"
)


def joined(c: str | Column) -> Column:
    return F.array_join(F.col(c) if isinstance(c, str) else c, ",")


def stamp(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def check_columns(df: DataFrame) -> DataFrame:
    return df.select("check_name", "dataset", "passed", "metric_value")


# -- document and table quality --------------------------------------------------------------


@query
def doc_length_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.length_profile(documents(spark, sf_dir))


@query
def blank_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    blanked = "CASE WHEN n_chars < 250 THEN repeat(' \t\n', CAST(n_chars AS INT)) ELSE text END"
    found = quality.blank_content(documents(spark, sf_dir, blanked))
    return found.withColumn("empty_doc_ids", joined("empty_doc_ids"))


@query
def duplicate_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.duplicate_content(documents(spark, sf_dir))
    pairs = F.transform("duplicate_pairs", lambda p: F.concat_ws("=", p[0], p[1]))
    return found.withColumn("duplicate_pairs", joined(pairs))


@query
def duplicate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_pairs(documents(spark, sf_dir))


@query
def document_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_columns(quality.document_checks(documents(spark, sf_dir), QualityParams(200, 20_000)))


@query
def table_quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_columns(quality.table_checks(table(spark, sf_dir, "lineitem"), "lineitem"))


@query
def missing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    holes = {
        "l_returnflag": "nullif(l_returnflag, 'R')",
        "l_linenumber": "nullif(l_linenumber, 3)",
        "l_discount": "CASE WHEN l_discount = 0 THEN double('NaN') ELSE l_discount END",
        "l_shipdate": "CASE WHEN l_shipdate < TIMESTAMP'1995-01-01' THEN l_shipdate END",
    }
    rows = table(spark, sf_dir, "lineitem")
    return quality.missing_counts(rows.withColumns({c: F.expr(e) for c, e in holes.items()}))


@query
def duplicate_key_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").selectExpr("nullif(o_custkey % 700, 0) AS key", "*")
    return quality.duplicate_key_count(rows)


# -- text signals ----------------------------------------------------------------------------


@query
def negation_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir, NEGATED).select(
        "doc_id",
        text.negation_count("content").cast("bigint").alias("negations"),
        text.has_negation("content").alias("negated"),
    )


@query
def number_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    priced = "concat(text, ' About ', n_chars, '.5 million, or ', doc_id % 100, ' percent.')"
    return documents(spark, sf_dir, priced).select(
        "doc_id", joined(text.number_mentions("content")).alias("numbers")
    )


@query
def entity_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = documents(spark, sf_dir).select(
        "doc_id", F.array_sort(text.entity_mentions("content")).alias("e")
    )
    return found.select("doc_id", F.size("e").cast("bigint").alias("n"), joined("e").alias("entities"))


@query
def date_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = F.array_sort(text.date_mentions("content"))
    found = documents(spark, sf_dir, DATED).select("doc_id", dates.alias("d"))
    shown = F.transform("d", lambda d: F.date_format(d, "yyyy-MM-dd"))
    return found.select("doc_id", joined(shown).alias("dates"))


@query
def temporal_staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = risks.stale_documents(documents(spark, sf_dir, DATED), dt.date(2024, 6, 30))
    return found.select(
        "doc_id",
        F.date_format("latest", "yyyy-MM-dd").alias("latest"),
        F.col("age_days").cast("bigint").alias("age_days"),
        "severity",
        "confidence",
    )


@query
def temporal_risks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = risks.temporal_risks(documents(spark, sf_dir, DATED), dt.date(2024, 6, 30))
    return found.select("risk_type", "severity", "pos", "doc_id", "description", "confidence")


# -- sources ---------------------------------------------------------------------------------


@query
def doc_id_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.document_id("source", "doc_id").alias("hashed")
    )


@query
def paragraph_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = files.paragraph_rows(documents(spark, sf_dir), "content", "doc_id", separator="\n")
    return rows.select(
        "doc_id",
        F.col("index").cast("bigint").alias("chunk_index"),
        F.col("total").cast("bigint").alias("total_chunks"),
        F.md5("content").alias("content_md5"),
    )


def _json_rows(df: DataFrame, key: str, body: str) -> DataFrame:
    records = df.select(
        F.lit("table").alias("file"),
        F.col(key).alias("index"),
        F.col(body).alias("body"),
        F.parse_json(body).alias("value"),
    )
    entries = F.array_sort(
        F.transform(F.map_entries("metadata"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    )
    return files.json_documents(records).select(
        F.col("index").alias(key), "content", joined(entries).alias("metadata")
    )


@query
def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        "to_json(named_struct('body', text, 'lang', lang, 'long', n_chars > 1000, "
        "'n_chars', n_chars, 'extra', named_struct('source', source))) AS body",
    )
    return _json_rows(nested, "doc_id", "body")


@query
def json_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _json_rows(table(spark, sf_dir, "events"), "event_id", "props")


@query
def table_rows_as_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS key",
        "nullif(c_mktsegment, 'MACHINERY') AS segment",
        "c_name AS name",
        "'table' AS file",
        "c_custkey AS index",
    )
    longest = files.content_column(rows.drop("file", "index"))
    by_column = files.table_documents(rows, longest)
    whole = files.table_documents(rows, None)
    return by_column.select(
        F.col("index").alias("c_custkey"),
        "content",
        joined(F.map_values("metadata")).alias("metadata"),
    ).join(whole.select(F.col("index").alias("c_custkey"), F.col("content").alias("row_text")), "c_custkey")


# -- vectors ---------------------------------------------------------------------------------


@query
def vector_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("a"))
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("a").alias("b"))
    gap = vectors.l2_distance("a", "b")
    return a.join(b, "vec_id").select(
        "vec_id",
        F.round(vectors.norm("a"), 5).alias("length"),
        F.round(vectors.cosine_similarity("a", "b"), 5).alias("similarity"),
        F.round(vectors.cosine_distance("a", "b"), 5).alias("distance"),
        F.round(gap, 5).alias("l2"),
        F.round(vectors.rbf_kernel(gap * gap, 0.5), 5).alias("kernel"),
    )


@query
def similarity_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = embeddings(spark, sf_dir)
    return similarity_join(vecs, threshold=0.2, order_col="pos").withColumn(
        "similarity", vectors.rounded("similarity", 5)
    )


@query
def candidate_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of all pairs at 0.5 the candidate join finds, and that it gives no other."""
    vecs = cut(embeddings(spark, sf_dir))
    every = similarity_join(vecs, threshold=0.5).select("id_a", "id_b", F.lit(1).alias("exact"), F.lit(0).alias("found"))
    found = candidate_join(vecs, threshold=0.5).select("id_a", "id_b", F.lit(0).alias("exact"), F.lit(1).alias("found"))
    pairs = every.unionByName(found).groupBy("id_a", "id_b").agg(F.sum("exact").alias("e"), F.sum("found").alias("f"))
    return pairs.agg(
        F.expr("count_if(e = 1)").alias("pairs"),
        F.expr("count_if(e = 0 OR f > 1)").alias("wrong"),
        F.expr("count_if(e = 1 AND f = 1) >= count_if(e = 1) * 0.9").alias("recall_reached"),
    )


@query
def contradictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = risks.contradiction_pairs(
        documents(spark, sf_dir, NEGATED), embeddings(spark, sf_dir), SIMILAR
    )
    return risks.grade_contradictions(pairs).select(
        "doc_a",
        "doc_b",
        vectors.rounded("similarity", 5).alias("similarity"),
        "negation_divergence",
        "number_conflict",
        "severity",
        "confidence",
    )


@query
def contradiction_risks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = risks.contradictions(
        documents(spark, sf_dir, NEGATED), embeddings(spark, sf_dir), SIMILAR
    )
    return found.select("risk_type", "severity", "pos", "doc_id", "description", "confidence")


@query
def ambiguous_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = risks.ambiguous_entities(documents(spark, sf_dir), embeddings(spark, sf_dir), SIMILAR)
    return found.select("severity", "documents", "pos", "doc_id", "description", "confidence")


@query
def ambiguity_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = risks.ambiguous_entities(documents(spark, sf_dir), embeddings(spark, sf_dir), SIMILAR)
    return risks.findings(found).select("finding_id", "risk_type", "severity", "documents", "confidence")


@query
def entity_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread, _ = risks.entity_spread(documents(spark, sf_dir), embeddings(spark, sf_dir), SIMILAR)
    return spread.select(
        "entity",
        "n_docs",
        F.round("mean_distance", 5).alias("mean_distance"),
        F.round("variance", 5).alias("variance"),
    )


@query
def neighbor_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = risks.neighbor_counts(embeddings(spark, sf_dir), SIMILAR)
    return found.withColumn("mean_distance", F.round("mean_distance", 5))


@query
def sparse_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = risks.sparse_context(documents(spark, sf_dir), embeddings(spark, sf_dir), SIMILAR)
    return found.select("risk_type", "severity", "pos", "doc_id", "description", "confidence")


@query
def sparse_corpus_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = risks.sparse_context(
        documents(spark, sf_dir), embeddings(spark, sf_dir), RiskParams(radius=0.4)
    )
    return found.select("severity", "documents", "doc_id", "description", "confidence")


# -- drift -----------------------------------------------------------------------------------


@query
def drift_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.centroid_test(*baseline_and_current(spark, sf_dir)).drop("p_value")


@query
def drift_ks_by_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drift.ks_by_dimension(*baseline_and_current(spark, sf_dir))
    return found.select(
        F.col("dim").cast("bigint").alias("dim"),
        "n1",
        "n2",
        F.round("statistic", 6).alias("statistic"),
        F.round("p_value", 6).alias("p_value"),
    )


@query
def drift_ks(spark: SparkSession, sf_dir: str) -> DataFrame:
    baseline, current = baseline_and_current(spark, sf_dir)
    moved = current.withColumn(
        "embedding", F.transform("embedding", lambda x: (x + F.lit(0.05)).cast("float"))
    )
    dims = F.transform("top_drifted", lambda t: t["dim"].cast("string"))
    return drift.ks_test(baseline, moved).withColumn("top_drifted", joined(dims))


@query
def drift_mmd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.mmd_test(*baseline_and_current(spark, sf_dir)).drop("p_value")


@query
def drift_mmd_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.mmd_full_test(*baseline_and_current(spark, sf_dir)).drop("p_value")


@query
def drift_ks_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drift.ks_sketch_by_dimension(*baseline_and_current(spark, sf_dir))
    return found.select(
        F.col("dim").cast("bigint").alias("dim"),
        "n1",
        "n2",
        F.round("statistic", 6).alias("statistic"),
        F.round("error", 6).alias("error"),
    )


@query
def drift_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The baseline is too small for its guard, so no test is made."""
    baseline, current = baseline_and_current(spark, sf_dir)
    least = baseline.count() + 1
    found = drift.detect_drift(baseline, current, DriftParams(min_samples=least))
    return found.select("test_name", "statistic", "p_value", "threshold", "is_drifted")


@query
def drift_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    baseline, current = baseline_and_current(spark, sf_dir)
    every = baseline.unionByName(current)
    found = drift.detect_drift(
        every, current, DriftParams(mmd_threshold=0.001), exclude_current=True
    )
    return found.select("test_name", "statistic", "p_value", "threshold", "is_drifted")


@query
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.sample_rows(embeddings(spark, sf_dir), 100).select("doc_id", "label")


# -- retrieval -------------------------------------------------------------------------------


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").cast("string").alias("query_id"),
        term_vector("text", WIDTH).alias("embedding"),
    )


def _encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashed_terms(WIDTH)(documents(spark, sf_dir).select("doc_id", "content"))


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rag.retrieve(_asked(spark, sf_dir), _encoded(spark, sf_dir))


@query
def term_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = _encoded(spark, sf_dir).select(
        "doc_id", F.posexplode_outer("embedding").alias("dim", "w")
    )
    return entries.where("w > 0").select(
        "doc_id",
        F.col("dim").cast("bigint").alias("dim"),
        F.round(F.col("w").cast("double"), 4).alias("weight"),
    )


@query
def knn_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(spark, sf_dir).select(
        "query_id",
        "doc_id",
        F.round("distance", 5).alias("distance"),
        F.col("rank").cast("bigint").alias("rank"),
    )


@query
def knn_by_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same hits, found by visiting the blocks of the documents in the order of their bounds."""
    asked = _asked(spark, sf_dir).select(F.col("query_id").alias("id"), F.col("embedding").alias("vec"))
    cells = packed_documents(_encoded(spark, sf_dir), "doc_id", "embedding", block_rows=256)
    return cell_knn(asked, cells, 5).select(
        "query_id",
        "doc_id",
        F.round("distance", 5).alias("distance"),
        F.col("rank").cast("bigint").alias("rank"),
    )


@query
def label_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten vectors nearest to each label's mean vector."""
    vecs = embeddings(spark, sf_dir)
    means = vecs.select("label", F.posexplode("embedding").alias("dim", "x"))
    means = means.groupBy("label", "dim").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("dim", F.col("x").cast("float").alias("x"))))
    asked = means.groupBy(F.col("label").cast("string").alias("query_id")).agg(
        ordered["x"].alias("embedding")
    )
    return knn_join(asked, vecs, 10).select(
        "query_id",
        "doc_id",
        F.round("distance", 5).alias("distance"),
        F.col("rank").cast("bigint").alias("rank"),
    )


@query
def retrieval_relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = rag.retrieval_relevance(_asked(spark, sf_dir), _hits(spark, sf_dir), RagParams(0.5))
    ids = F.transform("per_document", lambda d: d["doc_id"])
    return scored.select(
        "query_id",
        "score",
        "retrieved_count",
        "mean_similarity",
        "above_threshold",
        "threshold",
        joined(ids).alias("per_document"),
    )


@query
def retrieval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = RagParams(0.5)
    scored = rag.retrieval_relevance(_asked(spark, sf_dir), _hits(spark, sf_dir), params)
    return rag.retrieval_summary(scored, params)


@query
def context_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rag.context_coverage(_asked(spark, sf_dir), _hits(spark, sf_dir))


@query
def context_redundancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rag.context_redundancy(_hits(spark, sf_dir), _encoded(spark, sf_dir))


@query
def chunk_size_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rag.chunk_sizes(documents(spark, sf_dir))
    return found.withColumn("target_tokens", F.col("target_tokens").cast("bigint"))


@query
def chunk_coherence(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = embeddings(spark, sf_dir).withColumn(
        "embedding",
        F.transform("embedding", lambda x: (x * (F.lit(0.55) + F.col("label") * 0.25)).cast("float")),
    )
    return rag.chunk_coherence(documents(spark, sf_dir), scaled)


# -- embedding tables ------------------------------------------------------------------------


@query
def incremental_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents are in the cache already; one in seven of them with an older text."""
    docs = documents(spark, sf_dir).select("doc_id", "content")
    labelled = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("doc_id"))
    before = docs.join(labelled.distinct(), "doc_id", "left_semi").withColumn(
        "content",
        F.when(F.col("doc_id").cast("bigint") % 7 == 0, F.lit("old text")).otherwise(F.col("content")),
    )
    encoder = hashed_terms(WIDTH)
    cached = encoder(before.withColumn("content_hash", F.md5("content"))).withColumn(
        "model_name", F.lit("m")
    )
    every, _ = embed_missing(docs, cached, encoder, "m")
    return every.select(
        "doc_id",
        "from_cache",
        F.size(F.filter("embedding", lambda x: x > 0)).cast("bigint").alias("entries"),
        F.round(F.array_max("embedding").cast("double"), 4).alias("largest"),
    )


@query
def embedding_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = embeddings(spark, sf_dir).select("doc_id", "embedding")
    merged = merge_latest(stored, _encoded(spark, sf_dir))
    return merged.select(
        "doc_id",
        F.round(F.array_max("embedding").cast("double"), 4).alias("largest"),
        F.round(F.array_min("embedding").cast("double"), 4).alias("smallest"),
    )


@query
def embedding_window_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.expr("make_interval(0, 0, 0, 0, int(pos % 240))")
    rows = embeddings(spark, sf_dir).withColumn("ingested_at", F.lit(dt.datetime(2024, 1, 1)) + hour)
    found = in_window(rows, dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 6))
    return found.select("doc_id", "label", stamp("ingested_at").alias("ingested_at"))


@query
def embedding_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings(spark, sf_dir).agg(F.count("*").alias("vectors"))


def _stored(spark: SparkSession, **options) -> VectorTable:
    """A new embedding table in the shared scratch folder."""
    return VectorTable(spark, f"{scratch_folder(spark).rstrip('/')}/tidemark/table-{uuid.uuid4().hex}", **options)


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors that arrived hour by hour over ten days."""
    hour = F.expr("make_interval(0, 0, 0, 0, int(pos % 240))")
    return embeddings(spark, sf_dir).withColumn("ingested_at", F.lit(dt.datetime(2024, 1, 1)) + hour).drop("pos")


@query
def vector_table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors of the table, then those of the documents in three batches, merged on the way."""
    store = _stored(spark, compact_after=2)
    store.put(embeddings(spark, sf_dir).select("doc_id", "embedding"))
    encoded = _encoded(spark, sf_dir)
    for part in range(3):
        store.put(encoded.where(F.pmod(F.col("doc_id").cast("bigint"), F.lit(3)) == part), f"batch-{part}")
    return store.scan().select(
        "doc_id",
        F.round(F.array_max("embedding").cast("double"), 4).alias("largest"),
        F.round(F.array_min("embedding").cast("double"), 4).alias("smallest"),
    )


@query
def vector_table_remove(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _stored(spark)
    rows = _dated(spark, sf_dir)
    store.put(rows)
    store.remove(rows.where("label = 3"))
    store.compact(keep=0)
    store.remove(rows.where("label = 7"))
    return store.scan().select("doc_id", "label", stamp("ingested_at").alias("ingested_at"))


@query
def vector_table_clear(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _stored(spark)
    rows = _dated(spark, sf_dir)
    store.put(rows)
    store.clear()
    store.put(rows.where("label < 4"))
    return store.scan().select("doc_id", "label")


@query
def vector_table_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some days of a table whose odd labels came again a day later."""
    store = _stored(spark)
    rows = _dated(spark, sf_dir)
    store.put(rows)
    store.put(rows.where("label % 2 = 1").withColumn("ingested_at", F.expr("ingested_at + INTERVAL 1 DAY")))
    found = store.window(dt.datetime(2024, 1, 2, 6), dt.datetime(2024, 1, 5))
    return found.select("doc_id", "label", stamp("ingested_at").alias("ingested_at"))


@query
def drift_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last five days of a table against the first five."""
    store = _stored(spark)
    store.put(_dated(spark, sf_dir))
    first = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 5, 23, 59)
    last = dt.datetime(2024, 1, 6), dt.datetime(2024, 1, 10, 23, 59)
    found = drift.window_drift(store, first, last, tests=(drift.centroid_test,))
    return found.select("test_name", "statistic", "threshold", "is_drifted")


@query
def retrieved_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits with content, source and metadata out of an embedding table."""
    store = _stored(spark)
    described = documents(spark, sf_dir).select(
        "doc_id",
        "content",
        F.create_map(F.lit("source_path"), "source", F.lit("lang"), "lang").alias("metadata"),
    )
    store.put(described.join(_encoded(spark, sf_dir), "doc_id"))
    stored = store.scan()
    hits = knn_join(_asked(spark, sf_dir), stored, 5)
    return rag.with_documents(hits, stored).select(
        "query_id",
        F.col("rank").cast("bigint").alias("rank"),
        "doc_id",
        F.md5("content").alias("content_md5"),
        "source_path",
        F.element_at("metadata", "lang").alias("lang"),
        F.size("metadata").cast("bigint").alias("entries"),
    )


# -- history, alerts, reports: each event is one stored result -------------------------------


def _events(spark: SparkSession, sf_dir: str, kind: str, **columns: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").where(F.col("event_type") == kind)
    at = F.col("ts").cast("timestamp")
    return rows.select(
        F.date_format(at, "yyyy-MM-dd").alias("run_id"),
        at.alias("at"),
        "event_id",
        *[F.expr(sql).alias(name) for name, sql in columns.items()],
    )


def runs_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("ts").cast("timestamp")
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.date_format(at, "yyyy-MM-dd").alias("run_id"))
        .agg(
            F.min(at).alias("started_at"),
            F.max(at).alias("completed_at"),
            F.count("*").alias("documents_processed"),
        )
        .withColumn("status", F.lit("completed"))
    )


def drift_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(
        spark,
        sf_dir,
        "view",
        test_name="CASE WHEN user_id % 3 = 0 THEN 'ks_test' WHEN user_id % 3 = 1 THEN 'mmd' "
        "ELSE 'cosine_centroid' END",
        statistic="value",
        threshold="30.0D",
        is_drifted="value > 30",
    ).withColumnRenamed("at", "measured_at")


def risks_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(
        spark,
        sf_dir,
        "error",
        risk_type="CASE WHEN user_id % 4 = 0 THEN 'contradiction' WHEN user_id % 4 = 1 THEN 'ambiguity' "
        "WHEN user_id % 4 = 2 THEN 'temporal' ELSE 'sparse_context' END",
        severity="CASE WHEN value > 60 THEN 'CRITICAL' WHEN value > 20 THEN 'WARNING' "
        "WHEN value > 5 THEN 'INFO' ELSE 'DEBUG' END",
        description="concat('user ', user_id)",
        confidence="least(value / 100, 1.0D)",
    ).withColumnRenamed("at", "detected_at")


def checks_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(
        spark,
        sf_dir,
        "click",
        check_name="CASE WHEN user_id % 2 = 0 THEN 'row_count' ELSE 'empty_content' END",
        dataset="'documents'",
        passed="value < 40",
        metric_value="value",
    ).withColumnRenamed("at", "checked_at")


def metrics_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(
        spark,
        sf_dir,
        "purchase",
        metric_name="CASE WHEN user_id % 2 = 0 THEN 'chunk_coherence' ELSE 'retrieval_relevance' END",
        score="value / 100",
    ).withColumnRenamed("at", "measured_at")


def alerts_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(
        spark,
        sf_dir,
        "signup",
        severity="CASE WHEN value > 60 THEN 'CRITICAL' WHEN value > 20 THEN 'WARNING' "
        "WHEN value > 5 THEN 'INFO' ELSE 'DEBUG' END",
        source_module="'quality'",
        title="concat('user ', user_id)",
        message="concat('value ', CAST(value AS STRING))",
        context="to_json(map('k', get_json_object(props, '$.k')))",
    ).withColumnRenamed("at", "created_at")


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.run_summary(
        runs_table(spark, sf_dir),
        drift_table(spark, sf_dir),
        risks_table(spark, sf_dir),
        checks_table(spark, sf_dir),
        metrics_table(spark, sf_dir),
        alerts_table(spark, sf_dir),
    )


@query
def drift_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = history.drift_history(drift_table(spark, sf_dir), AS_OF, "ks_test", days=10)
    return found.select("event_id", "run_id", "statistic", stamp("measured_at").alias("measured_at"))


@query
def risk_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = history.risk_history(risks_table(spark, sf_dir), AS_OF, days=7)
    return found.select("event_id", "risk_type", "severity", F.round("confidence", 4).alias("confidence"))


@query
def check_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = history.check_history(checks_table(spark, sf_dir), AS_OF, days=14)
    return found.select("event_id", "check_name", "passed", "metric_value")


@query
def rag_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = history.rag_history(metrics_table(spark, sf_dir), AS_OF, days=14)
    return found.select("event_id", "metric_name", F.round("score", 4).alias("score"))


@query
def alert_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = history.alert_history(alerts_table(spark, sf_dir), AS_OF, "CRITICAL")
    return found.select("event_id", "title", "message", stamp("created_at").alias("created_at"))


@query
def alerts_by_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alerts.at_least(alerts_table(spark, sf_dir), "WARNING")
    return found.select(
        "event_id", "severity", schemas.severity_rank("severity").cast("bigint").alias("severity_rank")
    )


@query
def alert_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alerts.with_payload(alerts_table(spark, sf_dir))

    def part(path: str) -> Column:
        return F.get_json_object("payload", f"$.{path}")

    return found.select(
        "event_id",
        part("severity").alias("severity"),
        part("source").alias("source"),
        part("title").alias("title"),
        part("message").alias("message"),
        part("context.k").alias("k"),
        F.substring(part("timestamp"), 1, 19).alias("at"),
    )


@query
def delivered_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts that were written to the sink, and again after their batch was there."""
    folder = f"{scratch_folder(spark).rstrip('/')}/tidemark/alerts-{uuid.uuid4().hex}"
    for _ in range(2):
        alert_sink.deliver_to(alerts_table(spark, sf_dir), folder, "batch-1")
    return spark.read.text(f"{folder}/batch-1").select(
        *[F.get_json_object("value", f"$.{c}").alias(c) for c in ("severity", "source", "title", "message")],
        F.get_json_object("value", "$.context.k").alias("k"),
        F.substring(F.get_json_object("value", "$.timestamp"), 1, 19).alias("at"),
    )


@query
def alerts_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = alerts.derive_alerts(
        drift_table(spark, sf_dir), risks_table(spark, sf_dir), checks_table(spark, sf_dir)
    )
    return derived.select(
        "severity", "source_module", "title", "message", stamp("created_at").alias("created_at")
    )


@query
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = runs_table(spark, sf_dir)
    found = history.of_latest_run(drift_table(spark, sf_dir), runs)
    return found.select("run_id", "event_id", "test_name", "statistic", "is_drifted")


@query
def latest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = history.latest_of(metrics_table(spark, sf_dir), "measured_at")
    return found.select("run_id", "event_id", "metric_name", F.round("score", 4).alias("score"))


@query
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(spark, sf_dir).drop("started_at", "completed_at")


@query
def health_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.health_score(_summary(spark, sf_dir))


@query
def risk_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.risk_breakdown(risks_table(spark, sf_dir))


@query
def pass_rate_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    trend = report.pass_rate_trend(checks_table(spark, sf_dir))
    return trend.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query
def latest_pass_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.latest_pass_counts(checks_table(spark, sf_dir), runs_table(spark, sf_dir))


@query
def metric_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = (
        metrics_table(spark, sf_dir)
        .groupBy("run_id", "metric_name")
        .agg(F.avg("score").alias("score"), F.max("measured_at").alias("measured_at"))
    )
    line = report.metric_series(daily, "metric_name", "score", "measured_at")
    return line.select(
        "series",
        "label",
        "run_id",
        F.round("value", 9).alias("value"),
        F.round("change", 9).alias("change"),
    )


# -- the whole run ---------------------------------------------------------------------------


def corpus_findings(spark: SparkSession, sf_dir: str) -> Findings:
    """Every family over documents, their vectors and the benchmark texts as queries."""
    docs = documents(spark, sf_dir, NEGATED).select("doc_id", "content", "pos")
    vecs = hashed_terms(WIDTH)(docs.select("doc_id", "content"))
    asked = _asked(spark, sf_dir)
    older = cut(
        spread(table(spark, sf_dir, "conversations")).select(
            F.concat_ws("-", "conv_id", "turn").alias("doc_id"),
            term_vector("text", WIDTH).alias("embedding"),
        )
    )
    return measure(
        docs,
        vecs,
        dt.datetime(2024, 6, 30, tzinfo=dt.timezone.utc),
        baseline=older,
        queries=asked,
        params=Params(risk=RiskParams(similarity=0.97, radius=0.1)),
    )


@query
def findings_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All findings of a run, counted by family and name."""
    rows = findings_by_family(corpus_findings(spark, sf_dir))
    return rows.groupBy("family", "name", "severity").agg(
        F.count("*").alias("findings"), F.count_if(~F.col("passed")).alias("failing")
    )
