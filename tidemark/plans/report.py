"""Questions asked of the history: summaries, health, breakdowns, trends."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.history import of_latest_run


def run_summary(
    runs: DataFrame,
    drift: DataFrame,
    risks: DataFrame,
    checks: DataFrame,
    metrics: DataFrame,
    alerts: DataFrame,
) -> DataFrame:
    """Counts per run, zero where a family has no rows.

    Each table is counted before anything is joined, so one row per run and table moves.
    """

    def count(df: DataFrame, **measures) -> DataFrame:
        return df.groupBy("run_id").agg(*[c.alias(n) for n, c in measures.items()])

    families = [
        count(drift, drift_tests=F.count("*"), drift_detected=F.count_if("is_drifted")),
        count(
            risks,
            risks=F.count("*"),
            serious_risks=F.count_if(F.col("severity").isin("WARNING", "CRITICAL")),
        ),
        count(checks, quality_checks=F.count("*"), quality_failures=F.count_if(~F.col("passed"))),
        count(metrics, rag_metrics=F.count("*")),
        count(alerts, alerts=F.count("*")),
    ]
    out = runs.select("run_id", "started_at", "completed_at", "documents_processed")
    for family in families:
        out = out.join(family, "run_id", "left")
    seconds = F.col("completed_at").cast("double") - F.col("started_at").cast("double")
    counted = [c for f in families for c in f.columns if c != "run_id"]
    return out.withColumn("duration_seconds", F.round(seconds, 1)).fillna(0, subset=counted)


def health_score(summary: DataFrame) -> DataFrame:
    """100 minus the share of findings that are issues, per run."""
    findings = F.greatest(
        F.col("drift_tests") + F.col("quality_checks") + F.col("risks"), F.lit(1)
    )
    issues = F.col("drift_detected") + F.col("quality_failures") + F.col("serious_risks")
    score = F.lit(100) - F.floor(issues / findings * 100)
    return summary.select(
        "run_id",
        findings.alias("findings"),
        issues.alias("issues"),
        F.greatest(F.lit(0), score).cast("bigint").alias("health"),
    )


def risk_breakdown(risks: DataFrame) -> DataFrame:
    """Counts by type and by severity from one aggregation: (dimension, value, risks)."""
    return (
        risks.groupingSets([["risk_type"], ["severity"]], "risk_type", "severity")
        .agg(F.count("*").alias("risks"), F.grouping("risk_type").alias("by_severity"))
        .select(
            F.when(F.col("by_severity") == 1, F.lit("severity"))
            .otherwise(F.lit("risk_type"))
            .alias("dimension"),
            F.when(F.col("by_severity") == 1, F.col("severity"))
            .otherwise(F.col("risk_type"))
            .alias("value"),
            "risks",
        )
        .orderBy("dimension", F.col("risks").desc(), "value")
    )


def pass_rate_trend(checks: DataFrame) -> DataFrame:
    """Per day: checks, passed ones and their percentage."""
    return (
        checks.groupBy(F.to_date("checked_at").alias("day"))
        .agg(F.count("passed").alias("total"), F.count_if("passed").alias("passed"))
        .withColumn("pass_rate", F.round(F.col("passed") / F.col("total") * 100, 4))
        .orderBy("day")
    )


def pass_counts(checks: DataFrame) -> DataFrame:
    """Passed and failed checks of the rows given (those of one run, usually)."""
    return checks.agg(
        F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed")
    )


def latest_pass_counts(checks: DataFrame, runs: DataFrame) -> DataFrame:
    return pass_counts(of_latest_run(checks, runs))


def metric_series(rows: DataFrame, name: str, value: str, time: str) -> DataFrame:
    """One line per metric: (series, label, at, value, change since the point before).

    A series has one point per run, so it is small even where the corpora are not.
    """
    line = Window.partitionBy(name).orderBy(time, "run_id")
    before = F.lag(value).over(line)
    return rows.select(
        F.col(name).alias("series"),
        F.initcap(F.replace(F.col(name), F.lit("_"), F.lit(" "))).alias("label"),
        "run_id",
        F.col(time).alias("at"),
        F.col(value).alias("value"),
        (F.col(value) - before).alias("change"),
    )
