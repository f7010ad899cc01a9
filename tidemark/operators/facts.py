"""What the checks need to know about each text, worked out in one scan of the corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators.staging import cut

FACTS = {
    "length": F.length,
    "blank": text.is_blank,
    "words": text.word_count,
    "text_key": text.normalized_hash,
    "negated": text.has_negation,
    "numbers": text.number_mentions,
    "entities": text.entity_mentions,
    "latest_date": lambda c: F.array_max(text.date_mentions(c)),
}


def fact(docs: DataFrame, name: str) -> Column:
    """A fact column where ``docs`` has it already, else the expression on its content."""
    return F.col(name) if name in docs.columns else FACTS[name](F.col("content"))


def with_facts(docs: DataFrame, *names: str) -> DataFrame:
    """(doc_id, pos, facts...), written out unless ``docs`` holds these facts already.

    Written out because the texts would otherwise be scanned again by every reader of the
    result, and once more for each filter on a fact that the optimizer moves into the scan.
    """
    if set(names) <= set(docs.columns):
        return docs
    return cut(docs.select("doc_id", "pos", *[fact(docs, n).alias(n) for n in names]))


def document_facts(docs: DataFrame) -> DataFrame:
    """All facts. Operators take this in place of the documents."""
    return with_facts(docs, *FACTS)
