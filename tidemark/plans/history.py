"""Results of all runs, kept as seven Parquet tables partitioned by run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas

_RUN = "run_id string, "
TABLES: dict[str, str] = {
    "runs": schemas.RUNS,
    "drift_results": _RUN + schemas.DRIFT,
    "risks": _RUN + schemas.RISK,
    "risk_members": _RUN + schemas.RISK_MEMBER,
    "quality_checks": _RUN + schemas.CHECK,
    "rag_metrics": _RUN + schemas.RAG,
    "alerts": _RUN + schemas.ALERT,
}


def since(time: str, as_of: dt.datetime, days: int) -> Column:
    """Rows of the last ``days`` days; a plain comparison, so it reaches the Parquet scan."""
    return F.col(time) >= F.lit(as_of - dt.timedelta(days=days))


def drift_history(
    drift: DataFrame, as_of: dt.datetime, test_name: str | None = None, days: int = 30
) -> DataFrame:
    rows = drift.where(since("measured_at", as_of, days))
    if test_name:
        rows = rows.where(F.col("test_name") == test_name)
    return rows.orderBy("measured_at")


def risk_history(risks: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    return risks.where(since("detected_at", as_of, days)).orderBy("detected_at")


def check_history(checks: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    return checks.where(since("checked_at", as_of, days)).orderBy("checked_at")


def rag_history(metrics: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    return metrics.where(since("measured_at", as_of, days)).orderBy("measured_at")


def alert_history(
    alerts: DataFrame, as_of: dt.datetime, severity: str | None = None, days: int = 7
) -> DataFrame:
    """Newest first."""
    rows = alerts.where(since("created_at", as_of, days))
    if severity:
        rows = rows.where(F.col("severity") == severity)
    return rows.orderBy(F.col("created_at").desc())


def latest_run(runs: DataFrame) -> DataFrame:
    """The run that started last, as one row."""
    return runs.orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(1)


def of_latest_run(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """A child table's rows of the latest run.

    The run id arrives as a scalar subquery, so only that run's partition is read.
    """
    return rows.where(F.col("run_id") == latest_run(runs).select("run_id").scalar())


def latest_of(rows: DataFrame, time: str) -> DataFrame:
    """Rows of the run that owns the newest row of the table itself."""
    newest = rows.agg(F.max(F.struct(time, "run_id"))["run_id"].alias("r"))
    return rows.where(F.col("run_id") == newest.scalar())


@dataclass(frozen=True)
class History:
    """The tables under one folder of a shared file system."""

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def table(self, name: str) -> DataFrame:
        """A history table; without rows when nothing has been saved yet."""
        try:
            stored = self.spark.read.parquet(self.path(name))
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error.getCondition()):
                raise
            return self.spark.createDataFrame([], TABLES[name])
        return schemas.conform(stored, TABLES[name])

    def of_run(self, name: str, run_id: str) -> DataFrame:
        return self.table(name).where(F.col("run_id") == run_id)

    def replace(self, name: str, rows: DataFrame, run_id: str) -> None:
        """Store a run's rows of one table; an earlier attempt's rows go.

        Just the run's own folder is overwritten, so a replay with fewer or no rows is right too.
        """
        if name not in TABLES:
            raise ValueError(f"no such history table: {name}")
        rows = schemas.conform(rows.withColumn("run_id", F.lit(run_id)), TABLES[name])
        target = f"{self.path(name)}/run_id={run_id}"
        rows.drop("run_id").write.mode("overwrite").parquet(target)

    def finish(
        self,
        run_id: str,
        started_at: dt.datetime,
        documents_processed: int = 0,
        completed_at: dt.datetime | None = None,
    ) -> None:
        status = "completed" if completed_at else "running"
        row = [(run_id, started_at, completed_at, documents_processed, status)]
        runs = self.spark.createDataFrame(row, schemas.RUNS)
        self.replace("runs", runs, run_id)

    def save_run(
        self,
        run_id: str,
        started_at: dt.datetime,
        results: Mapping[str, DataFrame],
        *,
        documents_processed: int = 0,
        completed_at: dt.datetime | None = None,
    ) -> None:
        """Store a whole run; saving it again replaces it. The run row comes last."""
        for name, rows in results.items():
            self.replace(name, rows, run_id)
        self.finish(run_id, started_at, documents_processed, completed_at)
