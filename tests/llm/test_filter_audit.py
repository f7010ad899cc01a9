"""The filter audit against a plain version over lists, and against SQL."""

from __future__ import annotations

import random
import re
from itertools import permutations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.compare import connect, difference
from tests.llm.test_llm import EDGES, FOLDER, SCHEMA, needs_tables
from tidemark.llm import filter_audit, queries
from tidemark.llm.text_trie import TextTrie

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def fails(text: str) -> set[str]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    found = set()
    found |= {"A"} if len(words) < 200 else set()
    found |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
    found |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else set()
    found |= {"D"} if re.search(r"[#$%&*|]", text) else set()
    return found


def plain(rows, labels):
    """rows: (doc_id, source, text); labels: (doc_id, quality, toxic)."""
    marked = []
    for key, part, text in rows:
        text, part = text or "", part or ""
        failed = fails(text)
        if key is not None and any(k is not None and k < key and (t or "") == text for k, _, t in rows):
            failed.add("E")
        good = any(k == key and q == 1 for k, q, _ in labels if k is not None)
        toxic = any(k == key and x == 1 for k, _, x in labels if k is not None)
        marked.append((part, failed, good, toxic))
    out = {}
    for part in {m[0] for m in marked}:
        removed_by = dict.fromkeys("ABCDE", 0)
        mine = [m[1:] for m in marked if m[0] == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [m for m in left if f in m[0]]
                failing = [m for m in mine if f in m[0]]
                left = [m for m in left if f not in m[0]]
                removed_by[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(failing) - len(gone), sum(m[0] == {f} for m in mine),
                    sum(m[1] for m in gone), sum(m[2] for m in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed_by[order[step - 1]])
    return out


def got(spark, rows, labels, **kw):
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    docs = docs.selectExpr("*", "'x' AS part", "7 AS mask", "8 AS n", "'k' AS key", "'p' AS prefix", "true AS good")
    named = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").selectExpr("*", "9 AS n")
    found = filter_audit.audit(filter_audit.flags(docs, **kw), named).collect()
    return {(r.part, r.filter_order, r.step): [*(r[c] for c in COUNTS), r.shapley] for r in found}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=6), st.integers(0, 9)), max_size=40))
def test_trie_keeps_least_ids(rows):
    trie = TextTrie()
    ends = [trie.insert(text, key) for text, key in rows]
    least = {}
    for text, key in rows:
        least[text] = min(key, least.get(text, key))
    assert dict(trie.terminals()) == least
    assert [text for text, _ in trie.terminals()] == sorted(least)
    assert [end.least for end in ends] == [least[text] for text, _ in rows]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_version(spark, seed):
    rng = random.Random(seed)
    pool = ["w%d " % rng.randrange(9) * rng.choice([1, 30, 220]) for _ in range(6)]
    pool += [" ".join(f"v{i}" for i in range(220)) + end for end in ("", " #", " A" * 99, " a")]
    pool += ["shared start " * 900 + str(i) for i in range(5)] + ["", None]
    rows = [(rng.choice([None, *range(60)]), rng.choice(["s", "t", None, ""]), rng.choice(pool)) for _ in range(150)]
    rows += [(7, "s", pool[0])] * 40 + [(1000 + i, "hot", pool[6]) for i in range(80)]
    labels = [(rng.choice([None, *range(70)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(80)]
    assert got(spark, rows, labels, range_bytes=20_000, local_bytes=3000) == plain(rows, labels)


def test_heavy_prefixes_get_longer_keys(spark):
    texts = ["shared start " * 100 + str(i) for i in range(50)] + ["other", ""]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    keyed, ranges = filter_audit.with_key(frame, 16_000)
    keys = {r.text: r.key for r in keyed.collect()}
    assert len({keys[t] for t in texts[:50]}) == 50 and keys["other"] == "other" and keys[""] == ""
    assert ranges >= 8 and all(t.startswith(k) for t, k in keys.items())


def test_edges(spark):
    rows = [(r[0], r[3], r[1]) for r in EDGES]
    assert got(spark, rows, [(5, 1, 0), (6, 0, 1)]) == plain(rows, [(5, 1, 0), (6, 0, 1)])
    assert got(spark, [], [(1, 1, 1)]) == {}
    assert got(spark, rows, []) == plain(rows, [])
    assert {len(r.asDict()) for r in filter_audit.flags(spark.createDataFrame(EDGES, SCHEMA)).collect()} == {4}


def test_long_texts_are_read_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 700}" for i in range(3000)).encode()
    whole = filter_audit.own_mask(text)
    monkeypatch.setattr(filter_audit, "_STRIDE", 7)
    assert filter_audit.own_mask(text) == whole == 2


@needs_tables
def test_equals_sql(spark):
    name = "op11_filter_audit"
    mine = queries.QUERIES[name](spark, FOLDER).toArrow()
    assert difference(mine, connect(FOLDER).sql(queries.ORACLES[name]).to_arrow_table()) is None
