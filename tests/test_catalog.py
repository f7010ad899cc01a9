"""Every catalog query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, difference
from tidemark.plans.catalog import QUERIES
from tidemark.plans.oracles import ORACLES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


def test_every_query_with_sql_has_a_counterpart():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) - set(ORACLES) == {"findings_overview"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, database, name):
    mine = queries()[name](spark, FOLDER).toArrow()
    theirs = database.sql(oracle_sql()[name]).to_arrow_table()
    assert difference(mine, theirs) is None


def test_entry(spark):
    families = {r.family for r in entry(spark).collect()}
    assert families == {"drift", "risk", "quality", "rag"}
