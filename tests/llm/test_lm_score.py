"""Scores against counts and sums worked out plainly, and held-out likelihood."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.test_llm import EDGES, FOLDER, SCHEMA, needs_tables, table
from tidemark.llm import lm_score
from tidemark.llm.log_bilinear import Plan, Scorer, Trainer, contexts, pack, start, unpack

SMALL = dict(head=40, single=10, classes=20, plan=Plan(width=6, noise=8, batch=64, rounds=1))


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def is_out(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 7 == 2


def base_scores(rows):
    counts = Counter(t for key, text in rows if not is_out(key) for t in words(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for key, text in rows:
        found = [counts[t] for t in words(text)]
        base = sum(math.log10((c + 1) / (n + v + 1)) for c in found)
        out.append((key, is_out(key), len(found), sum(c > 0 for c in found), n, round(base, 6)))
    return sorted(out, key=repr)


def shown(frame):
    return sorted(
        ((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in frame), key=repr
    )


def test_scorer_is_a_softmax():
    rng = np.random.default_rng(0)
    net = {n: v * 3 for n, v in start(np.log(rng.dirichlet(np.ones(30))), Plan(width=5)).items()}
    net["Q"][4] += 60  # far beyond the range of a float
    scorer = Scorer(net)
    for first, second in [(0, 0), (30, 30), (4, 17), (29, 4)]:
        raw = (net["R"][first] @ net["C1"] + net["R"][second] @ net["C2"]) @ net["Q"].T + net["b"]
        raw = raw.astype(np.float64)
        direct = raw - raw.max() - np.log(np.exp(raw - raw.max()).sum())
        every = np.arange(30)
        got = scorer.log_probs(np.full(30, first), np.full(30, second), every)
        assert np.exp(got).sum() == pytest.approx(1, abs=1e-3)
        assert got == pytest.approx(direct, rel=1e-4, abs=1e-3)


def test_contexts_do_not_cross_texts():
    first, second = contexts(np.array([1, 2, 3, 4, 5]), np.array([0, 3, 4]), 9)
    assert first.tolist() == [9, 1, 2, 9, 9] and second.tolist() == [9, 9, 1, 9, 9]


def test_training_learns_what_follows_what():
    rng = np.random.default_rng(1)
    sequence = [0]
    for _ in range(60_000):
        sequence.append((sequence[-1] * 3 + 1) % 11 if rng.random() < 0.8 else int(rng.integers(11)))
    ids = np.array(sequence, dtype=np.int32)
    share = np.log(np.bincount(ids, minlength=11) / len(ids))
    plan = Plan(width=8, noise=16, batch=256)
    trainer = Trainer(start(share, plan), share, plan, 0)
    around = contexts(ids, np.array([0]), 11)
    for _ in range(3):
        trainer.learn(*around, ids)
    net = unpack(pack(trainer.net), 11, 8)
    assert Scorer(net).log_probs(*around, ids).mean() > share[ids].mean() + 0.8


def test_masses_add_up(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.7))}" for _ in range(60))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    given = docs.select("doc_id", lm_score.held_out().alias("held_out"), "text")
    counts = lm_score.count_tokens(given).cache()
    head = lm_score.Head(counts, 40, 10, 20)
    everything = [r.c for r in counts.where("c > 0").collect()]
    assert head.mass.sum() == pytest.approx(sum(everything) + len(everything) + 1) == head.total
    assert 11 < len(head.mass) <= 20 and (head.mass > 0).all()
    for k in range(head.rare):
        inside = [c + 1 for c, g in zip(head.counts, head.classes) if g == k]
        assert sum(inside) == pytest.approx(head.mass[k])


def test_base_equals_plain_sums(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(200)]), " ".join(f"W{int(rng.paretovariate(0.6))}" for _ in range(rng.randrange(40)))) for _ in range(150)]
    rows += [(i, "unseen only here " + "x" * 70 + " " + "x" * 71) for i in range(300) if is_out(i)]
    rows += [(501, "y" * 90), (502, "Y" * 90), (503, "y" * 91)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = lm_score.score(docs, **SMALL).collect()
    assert shown(found) == base_scores(rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)


def test_edges(spark):
    extra = spark.createDataFrame(EDGES, SCHEMA).selectExpr(
        "*", "'x' AS token", "1 AS c", "2 AS `row`", "3 AS ids", "'y' AS held_out", "4 AS tail", "5 AS score"
    )
    assert shown(lm_score.score(extra, **SMALL).collect()) == base_scores([(r[0], r[1]) for r in EDGES])
    assert lm_score.score(spark.createDataFrame([], SCHEMA), **SMALL).count() == 0
    only_out = next(i for i in range(100) if is_out(i))
    rows = lm_score.score(spark.createDataFrame([(only_out, "a b")], "doc_id bigint, text string"), **SMALL).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows] == [(3, 0, 0, 0.0, 0.0)]


@needs_tables
def test_network_beats_the_base_on_held_out_documents(spark):
    docs = table(spark, "documents").unionByName(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    found = lm_score.op13(docs).toPandas()
    out = found[found.held_out]
    assert out.score.sum() / out.n_tokens.sum() > out.base_score.sum() / out.n_tokens.sum() + 0.02
