"""Row types shared by all families."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DOCUMENT = (
    "doc_id string, content string, source_path string, "
    "metadata map<string,string>, ingested_at timestamp, pos bigint"
)
EMBEDDING = "doc_id string, embedding array<float>, model_name string, created_at timestamp"

RUNS = (
    "run_id string, started_at timestamp, completed_at timestamp, "
    "documents_processed bigint, status string"
)
DRIFT = (
    "test_name string, statistic double, p_value double, threshold double, "
    "is_drifted boolean, details string, measured_at timestamp"
)
# A finding is one row whatever it covers; its documents are rows of their own, in the order of pos.
RISK = (
    "finding_id string, risk_type string, severity string, documents bigint, description string, "
    "confidence double, detected_at timestamp"
)
RISK_MEMBER = "finding_id string, pos bigint, doc_id string"
RISK_ROW = RISK + ", pos bigint, doc_id string"
CHECK = (
    "check_name string, dataset string, passed boolean, metric_value double, "
    "details string, checked_at timestamp"
)
RAG = "metric_name string, score double, details string, measured_at timestamp"
ALERT = (
    "severity string, source_module string, title string, message string, "
    "context string, created_at timestamp"
)

# Severities from lowest to highest.
SEVERITIES = ("DEBUG", "INFO", "WARNING", "CRITICAL")


def severity_rank(severity: Column | str) -> Column:
    """0 for DEBUG up to 3 for CRITICAL."""
    name = F.col(severity) if isinstance(severity, str) else severity
    return F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), name) - F.lit(1)


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Cast and order the columns of ``df`` as ``ddl`` lists them; absent ones become null."""
    wanted = [part.strip().split(" ", 1) for part in _split_ddl(ddl)]
    have = set(df.columns)
    return df.select(
        *[(F.col(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in wanted]
    )


def _split_ddl(ddl: str) -> list[str]:
    parts, depth, start = [], 0, 0
    for i, ch in enumerate(ddl):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            parts.append(ddl[start:i])
            start = i + 1
    return [*parts, ddl[start:]]
