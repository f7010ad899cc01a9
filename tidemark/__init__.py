"""Corpus and embedding quality monitoring as Spark DataFrame operators."""

from tidemark.params import Params

__all__ = ["Params"]
