"""Fill-in-middle against a plain version by string slices, and exact round trips."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.compare import connect, difference
from tests.llm.test_llm import EDGES, FOLDER, SCHEMA, needs_tables, table
from tidemark.llm import fill_in_middle as fim
from tidemark.llm import queries

TEXTS = st.text(alphabet="aé😀 \t\n<>PSM", max_size=40)


def plain(text: str, key: str, rate: int = 50, spm: int = 80):
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = hashlib.sha256(f"42:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= rate:
        return text, "plain", n, None, None
    if h4 % 100 < spm:
        return f"<S>{suffix}<P>{prefix}<M>{middle}", "spm", n, len(prefix), len(middle)
    return f"<P>{prefix}<S>{suffix}<M>{middle}", "psm", n, len(prefix), len(middle)


@settings(max_examples=400, deadline=None)
@given(TEXTS, st.integers(0, 10**6))
def test_equals_slices_and_comes_back(text, key):
    output, form, *rest = fim.rearrange(text.encode(), str(key), fim.Draws(rate=100, spm=50))
    assert (output.decode(), form, *rest) == plain(text, str(key), 100, 50)
    assert fim.put_back(output, form) == text.encode()


@pytest.mark.parametrize("sizes", [(0, 5), (5, 0), (1, 1), (200_001, 70_000), (65_536, 131_073)])
def test_rotation_of_long_blocks(sizes):
    a, b = (np.random.RandomState(s % 97).bytes(s) for s in sizes)
    data = bytearray(b"x" + a + b + b"y")
    fim.rotate(data, 1, 1 + len(a), 1 + len(a) + len(b))
    assert bytes(data) == b"x" + b + a + b"y"


def test_edges(spark):
    docs = spark.createDataFrame(EDGES, SCHEMA).selectExpr(
        "*", "'mine' AS output", "'x' AS form", "1 AS n", "'y' AS restored", "2 AS key"
    )
    rows = fim.restore(fim.fill_in_middle(docs)).collect()
    texts = [(r[0], r[1] or "") for r in EDGES]
    assert sorted((r.doc_id or -1, r.restored) for r in rows) == sorted((k or -1, t) for k, t in texts)
    for row in rows:
        key = "" if row.doc_id is None else str(row.doc_id)
        assert (row.output, row.form, row.n, row.prefix_chars, row.middle_chars) == plain(row.restored, key)
    assert {r.n for r in rows if r.doc_id in (1, 2)} == {0}
    again = fim.restore(fim.fill_in_middle(docs).selectExpr("*", "1 AS restored"))
    assert {r.restored for r in again.collect()} == {t for _, t in texts}


def test_empty_table(spark):
    assert fim.op12(spark.createDataFrame([], SCHEMA)).count() == 0


@needs_tables
def test_equals_sql(spark):
    name = "op12_fill_in_middle"
    mine = queries.QUERIES[name](spark, FOLDER).toArrow()
    assert difference(mine, connect(FOLDER).sql(queries.ORACLES[name]).to_arrow_table()) is None
    assert {r.form for r in fim.fill_in_middle(table(spark, "documents")).collect()} == {"plain", "psm", "spm"}
