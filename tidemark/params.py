"""Thresholds of every check family."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any


@dataclass(frozen=True)
class DriftParams:
    ks_alpha: float = 0.05
    ks_drifted_share: float = 0.10
    cosine_threshold: float = 0.85
    mmd_threshold: float = 0.1
    mmd_sample: int = 500
    min_samples: int = 10


@dataclass(frozen=True)
class RiskParams:
    similarity: float = 0.8
    entity_docs: int = 3
    staleness_days: int = 365
    min_neighbors: int = 2
    radius: float = 0.5


@dataclass(frozen=True)
class QualityParams:
    min_length: int = 10
    max_length: int = 50_000
    listed_ids: int = 20


@dataclass(frozen=True)
class RagParams:
    relevance: float = 0.7
    target_tokens: int = 512
    coverage_min: float = 0.6
    top_k: int = 5


@dataclass(frozen=True)
class AlertParams:
    min_severity: str = "WARNING"


# Configuration keys understood in a settings file, by family and field.
CONFIG_KEYS = {
    "drift": {
        "ks_test_alpha": "ks_alpha",
        "cosine_sim_threshold": "cosine_threshold",
        "mmd_threshold": "mmd_threshold",
        "min_samples": "min_samples",
    },
    "hallucination": {
        "contradiction_sim_threshold": "similarity",
        "entity_ambiguity_threshold": "entity_docs",
        "temporal_staleness_days": "staleness_days",
        "sparse_context_min_neighbors": "min_neighbors",
        "sparse_context_radius": "radius",
    },
    "rag": {
        "relevance_threshold": "relevance",
        "chunk_size_target": "target_tokens",
        "context_coverage_min": "coverage_min",
        "top_k": "top_k",
    },
    "alerts": {"severity_threshold": "min_severity"},
}
FAMILY_FIELD = {"drift": "drift", "hallucination": "risk", "rag": "rag", "alerts": "alerts"}


@dataclass(frozen=True)
class Params:
    drift: DriftParams = field(default_factory=DriftParams)
    risk: RiskParams = field(default_factory=RiskParams)
    quality: QualityParams = field(default_factory=QualityParams)
    rag: RagParams = field(default_factory=RagParams)
    alerts: AlertParams = field(default_factory=AlertParams)
    model_name: str = "hashed-terms"
    directories: tuple[str, ...] = ()

    @classmethod
    def from_mapping(cls, settings: dict[str, Any]) -> "Params":
        """Build from a nested mapping; absent keys keep their defaults, others are ignored."""
        defaults = cls()
        made: dict[str, Any] = {}
        for family, names in CONFIG_KEYS.items():
            given = settings.get(family) or {}
            target = FAMILY_FIELD[family]
            current = getattr(defaults, target)
            values = {f.name: getattr(current, f.name) for f in fields(current)}
            values.update({names[k]: v for k, v in given.items() if k in names})
            made[target] = type(current)(**values)
        embeddings = settings.get("embeddings") or {}
        folders = (settings.get("pipeline") or {}).get("data_directories") or ()
        return cls(
            **made,
            model_name=embeddings.get("model_name", defaults.model_name),
            directories=tuple(folders),
        )

    @classmethod
    def from_yaml(cls, path: str | Path) -> "Params":
        try:
            import yaml
        except ImportError as error:
            raise RuntimeError("reading a settings file needs PyYAML") from error
        return cls.from_mapping(yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {})
