from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions.encoders import hashed_terms
from tidemark.operators import alerts
from tidemark.params import Params
from tidemark.plans import history, report
from tidemark.plans.history import History
from tidemark.plans.run import Extensions, Stores, findings_by_family, measure, run
from tidemark.sources.embeddings import VectorTable
from tidemark.streaming.stream import parquet_stream, pass_rate_windows, watch_documents

AT = dt.datetime(2024, 6, 1, 12)
CHECKS = "check_name string, dataset string, passed boolean, metric_value double, checked_at timestamp"


def test_settings_file(tmp_path):
    path = tmp_path / "s.yaml"
    path.write_text(
        "drift: {ks_test_alpha: 0.01, baseline_window_days: 30}\n"
        "hallucination: {entity_ambiguity_threshold: 2}\n"
        "rag: {top_k: 3}\nalerts: {severity_threshold: INFO}\n"
        "embeddings: {model_name: m}\npipeline: {data_directories: [a, b]}\n"
    )
    p = Params.from_yaml(path)
    assert (p.drift.ks_alpha, p.drift.min_samples, p.risk.entity_docs) == (0.01, 10, 2)
    assert (p.rag.top_k, p.alerts.min_severity, p.model_name) == (3, "INFO", "m")
    assert p.directories == ("a", "b")
    assert Params.from_mapping({}) == Params()


def drift_row(spark, name="ks_test", statistic=0.15, drifted=True, at=AT):
    return spark.createDataFrame(
        [(name, statistic, 0.1, drifted, at)],
        "test_name string, statistic double, threshold double, is_drifted boolean, measured_at timestamp",
    )


def risk_rows(spark):
    return spark.createDataFrame(
        [("f1", "temporal", "INFO", 1, "old", 0.3, AT), ("f2", "ambiguity", "CRITICAL", 2, "x", 0.9, AT)],
        "finding_id string, risk_type string, severity string, documents long, description string, "
        "confidence double, detected_at timestamp",
    )


def check_rows(spark, *passed):
    rows = [(f"c{i}", "documents", p, float(i), AT) for i, p in enumerate(passed)]
    return spark.createDataFrame(rows, CHECKS)


def test_saved_run_reads_back(spark, tmp_path):
    store = History(spark, str(tmp_path))
    assert store.table("runs").count() == 0
    results = {"drift_results": drift_row(spark), "risks": risk_rows(spark), "quality_checks": check_rows(spark, True, False)}
    store.save_run("r1", AT, results, documents_processed=10, completed_at=AT + dt.timedelta(seconds=90))
    store.save_run("r1", AT, results, documents_processed=10, completed_at=AT + dt.timedelta(seconds=90))
    later = AT + dt.timedelta(days=1)
    store.save_run("r2", later, {"drift_results": drift_row(spark, at=later, drifted=False)})
    assert store.table("runs").count() == 2 and store.table("drift_results").count() == 2
    row = store.of_run("drift_results", "r1").first()
    assert (row.test_name, row.statistic, row.is_drifted, row.measured_at) == ("ks_test", 0.15, True, AT)
    assert history.latest_run(store.table("runs")).first().run_id == "r2"
    found = history.of_latest_run(store.table("drift_results"), store.table("runs")).collect()
    assert [r.run_id for r in found] == ["r2"]
    with pytest.raises(ValueError, match="no such history table"):
        store.replace("unknown", drift_row(spark), "r1")
    # a replay that finds less leaves nothing behind
    store.save_run("r1", AT, {**results, "quality_checks": check_rows(spark, True).limit(0)}, completed_at=AT)
    assert store.of_run("quality_checks", "r1").count() == 0

    tables = [store.table(t) for t in ("runs", "drift_results", "risks", "quality_checks", "rag_metrics", "alerts")]
    summary = {r.run_id: r for r in report.run_summary(*tables).collect()}
    assert (summary["r1"].risks, summary["r1"].serious_risks, summary["r1"].drift_detected) == (2, 1, 1)
    assert (summary["r2"].drift_tests, summary["r2"].risks, summary["r2"].alerts) == (1, 0, 0)


def test_latest_run_prunes_partitions(spark, tmp_path):
    store = History(spark, str(tmp_path))
    for i in range(3):
        store.save_run(f"r{i}", AT + dt.timedelta(days=i), {"drift_results": drift_row(spark)})
    rows = history.of_latest_run(store.table("drift_results"), store.table("runs"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "run_id" in filters and "ubquery" in filters


def test_history_windows(spark):
    days = [drift_row(spark, at=AT - dt.timedelta(days=n)) for n in (0, 5, 40)]
    rows = days[0].unionByName(days[1]).unionByName(days[2]).unionByName(drift_row(spark, "mmd"))
    got = history.drift_history(rows, AT, "ks_test").collect()
    assert [r.measured_at for r in got] == [AT - dt.timedelta(days=5), AT]
    assert history.drift_history(rows, AT, days=50).count() == 4


def test_health_and_breakdown(spark):
    summary = spark.createDataFrame(
        [("a", 3, 1, 5, 2, 4, 1), ("b", 0, 0, 0, 0, 0, 0), ("c", 3, 0, 3, 1, 1, 1)],
        "run_id string, drift_tests long, drift_detected long, quality_checks long, "
        "quality_failures long, risks long, serious_risks long",
    )
    health = {r.run_id: r.health for r in report.health_score(summary).collect()}
    assert health == {"a": 67, "b": 100, "c": 72}
    counts = {(r.dimension, r.value): r.risks for r in report.risk_breakdown(risk_rows(spark)).collect()}
    assert counts == {
        ("risk_type", "temporal"): 1, ("risk_type", "ambiguity"): 1,
        ("severity", "INFO"): 1, ("severity", "CRITICAL"): 1,
    }
    assert tuple(report.pass_counts(check_rows(spark, True, False, True)).first()) == (2, 1)


def test_alerts(spark):
    checks = check_rows(spark, True, False)
    derived = alerts.derive_alerts(drift_row(spark), risk_rows(spark), checks)
    got = {(r.severity, r.source_module): r for r in derived.collect()}
    assert set(got) == {("WARNING", "drift"), ("CRITICAL", "hallucination"), ("WARNING", "quality")}
    assert got["WARNING", "drift"].message == (
        "ks_test detected distribution shift (statistic=0.15, threshold=0.1)"
    )
    assert got["WARNING", "quality"].message == "Check 'c1' on dataset 'documents' failed (value=1.0)"
    sent = []
    alerts.deliver(derived, [lambda df: sent.extend(df.collect())], Params().alerts)
    assert len(sent) == 3 and alerts.at_least(derived, "CRITICAL").count() == 1
    payload = json.loads(alerts.with_payload(derived.where("source_module = 'drift'")).first().payload)
    assert payload["source"] == "drift" and payload["context"] == {}
    assert payload["timestamp"].startswith("2024-06-01T12:00:00")


def corpus(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text(
        "content,kind\nNetworks are inspired by the brain today,x\n"
        "Networks are not inspired by the brain today,y\nSee January 1 2020 for the report,z\n"
    )
    (folder / "b.txt").write_text("A paragraph of text\n\nA paragraph of text\n\nThe last one here")
    return str(folder)


def test_whole_run(spark, tmp_path):
    stores = Stores(spark, str(tmp_path / "store"))
    sent = []
    extensions = Extensions(handlers=[lambda df: sent.extend(df.collect())])
    q = spark.createDataFrame([("0", "text paragraph")], "query_id string, query string")
    options = {"queries": q, "extensions": extensions, "params": Params.from_mapping({"drift": {"min_samples": 3}})}
    first = run(spark, [corpus(tmp_path)], stores, as_of=AT, run_id="one", **options)
    tables = {n: stores.history.of_run(n, first).collect() for n in history.TABLES}
    assert tables["runs"][0].documents_processed == 6 and tables["runs"][0].status == "completed"
    assert tables["drift_results"] == []
    kinds = sorted(r.risk_type for r in tables["risks"])
    assert kinds.count("contradiction") == 1 and kinds.count("temporal") == 1
    failed = [r.check_name for r in tables["quality_checks"] if not r.passed]
    assert failed == ["duplicate_content"]
    assert len(tables["rag_metrics"]) == 4
    assert len(sent) == len(tables["alerts"]) > 0
    assert stores.vectors.count() == 6

    run(spark, [str(tmp_path / "in")], stores, as_of=AT + dt.timedelta(days=1), run_id="two",
        exclude_current=False, **options)
    second = stores.history.of_run("drift_results", "two").collect()
    assert [r.test_name for r in second] == ["ks_test", "mmd", "cosine_centroid"]
    assert not any(r.is_drifted for r in second)
    assert stores.vectors.count() == 6


def test_run_without_documents(spark, tmp_path):
    stores = Stores(spark, str(tmp_path / "store"))
    run_id = run(spark, [str(tmp_path / "nothing")], stores, as_of=AT)
    assert stores.history.of_run("runs", run_id).first().documents_processed == 0


def test_findings_in_one_frame(spark, docs):
    d = docs(["one text here now", "one text here now", "and another one here"])
    found = measure(d, hashed_terms(8)(d.select("doc_id", "content")), AT)
    families = {r.family for r in findings_by_family(found).collect()}
    assert families == {"quality", "rag"}


def test_stream_of_documents_equals_batch(spark, docs, tmp_path):
    d = docs(["some text here", "some text here", "", "other text here"])
    source = str(tmp_path / "docs")
    d.write.parquet(source)
    table = VectorTable(spark, str(tmp_path / "v"))
    store = History(spark, str(tmp_path / "h"))
    seen = []
    stream = parquet_stream(spark, source, "doc_id string, content string, pos bigint")
    watch_documents(
        stream, table, store, hashed_terms(8), str(tmp_path / "cp"), lambda df: seen.append(df.count())
    ).awaitTermination()
    got = {r.check_name: r.metric_value for r in store.table("quality_checks").collect()}
    assert got["row_count"] == 4 and got["duplicate_content"] == 1 and got["empty_content"] == 1
    assert table.count() == 4 and seen == [7]
    # another stream into the same table starts at batch 0 again and adds to what is there
    more = d.withColumn("doc_id", F.concat(F.lit("x"), "doc_id"))
    more.write.parquet(str(tmp_path / "more"))
    again = parquet_stream(spark, str(tmp_path / "more"), "doc_id string, content string, pos bigint")
    watch_documents(again, table, store, hashed_terms(8), str(tmp_path / "cp2")).awaitTermination()
    assert table.count() == 8 and {"content", "embedding"} <= set(table.scan().columns)
    assert store.table("quality_checks").select("run_id").distinct().count() == 2


def test_pass_rate_windows_batch_and_stream(spark, tmp_path):
    days = [check_rows(spark, True, False), check_rows(spark, True).withColumn("checked_at", F.lit(AT + dt.timedelta(days=1)))]
    rows = days[0].unionByName(days[1])
    batch = {r.start: (r.total, r.pass_rate) for r in pass_rate_windows(rows).collect()}
    assert batch == {dt.datetime(2024, 6, 1): (2, 50.0), dt.datetime(2024, 6, 2): (1, 100.0)}
    trend = {r.day: (r.total, r.pass_rate) for r in report.pass_rate_trend(rows).collect()}
    assert trend == {k.date(): v for k, v in batch.items()}
    rows.write.parquet(str(tmp_path / "c"))
    stream = parquet_stream(spark, str(tmp_path / "c"), CHECKS)
    out = (
        pass_rate_windows(stream).writeStream.outputMode("complete").format("memory")
        .queryName("rates").trigger(availableNow=True).start()
    )
    out.awaitTermination()
    streamed = {r.start: (r.total, r.pass_rate) for r in spark.table("rates").collect()}
    assert streamed == batch


def test_alert_numbers_and_console(spark, capsys):
    values = [0.0, 1.0, 12000000.0, 0.00034, 1e16, 2.5e-05, 123456789.125, 1e-4, -5e20, 9999999.0, 0.1 + 0.2]
    rows = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    got = [r.t for r in rows.select(alerts._number("v").alias("t")).collect()]
    assert got == [*[repr(v) for v in values], "None"]
    many = spark.range(45).selectExpr(
        "'WARNING' AS severity", "'drift' AS source_module", "concat('t', id) AS title", "repeat('m', 200) AS message"
    )
    alerts.console(many)
    assert capsys.readouterr().out.count("m" * 200) == 45
