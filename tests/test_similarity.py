"""Similarity joins against brute force, with and without pivot pruning."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from tidemark.operators import block_pairs, candidates, nearest, similarity
from tidemark.operators.nearest import knn_join
from tidemark.operators.similarity import radius_counts, similarity_join


def clustered(seed: int, n: int = 300, width: int = 8) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(12, width))
    rows = centers[rng.integers(0, 12, n)] + 0.15 * rng.normal(size=(n, width))
    rows[min(5, n - 1)] = rows[min(17, n - 1)]  # an exact copy
    rows[min(9, n - 1)] = 0.0  # a vector without direction
    return rows.astype(np.float32)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    def unit(m):
        m = m.astype(float)
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, n, out=np.zeros_like(m), where=n > 0)

    return unit(a) @ unit(b).T


LAYOUTS = [
    {},
    {"block_rows": 40},
    {"block_rows": 16, "rows_per_pivot": 25},
    {"block_rows": 500, "rows_per_pivot": 10},
]


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("threshold", [0.95, 0.6, -0.1])
def test_self_join_gives_each_pair_once(vectors, layout, threshold):
    rows = clustered(1)
    sims = cosine(rows, rows)
    got = similarity_join(vectors(rows), threshold=threshold, order_col="pos", **layout).collect()
    pairs = [(int(r.id_a[1:]), int(r.id_b[1:])) for r in got]
    i, j = np.nonzero(np.triu(sims >= threshold, 1))
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == set(zip(i.tolist(), j.tolist()))
    assert all(abs(r.similarity - sims[p]) < 1e-9 for r, p in zip(got, pairs))


@pytest.mark.parametrize("layout", LAYOUTS)
def test_two_sided_join(vectors, layout):
    a, b = clustered(2, 120), clustered(2, 260)
    got = similarity_join(vectors(a, "a"), vectors(b, "b"), threshold=0.9, **layout).collect()
    pairs = sorted((int(r.id_a[1:]), int(r.id_b[1:])) for r in got)
    assert pairs == sorted(zip(*(x.tolist() for x in np.nonzero(cosine(a, b) >= 0.9))))


def test_order_column_decides_the_direction(vectors, spark):
    rows = clustered(3, 60)
    frame = vectors(rows).selectExpr("doc_id", "60 - pos as pos", "embedding")
    got = similarity_join(frame, threshold=0.8, order_col="pos", block_rows=16).collect()
    assert got and all(r.id_a > r.id_b for r in got)


@pytest.mark.parametrize("layout", LAYOUTS)
def test_radius_counts(vectors, layout):
    rows = clustered(4)
    sims = cosine(rows, rows)
    got = {r.id: r for r in radius_counts(vectors(rows), 0.2, **layout).collect()}
    for i in range(len(rows)):
        others = np.delete(np.arange(len(rows)), i)
        near = others[sims[i, others] >= 0.8]
        if len(near) == 0:
            assert f"d{i:05d}" not in got
            continue
        row = got[f"d{i:05d}"]
        gaps = 1 - sims[i, near]
        assert row.neighbors == len(near)
        assert row.apart == (gaps > 1e-12).sum()
        assert row.distance_sum == pytest.approx(gaps[gaps > 1e-12].sum(), abs=1e-9)


@pytest.mark.parametrize("bound", [16_384, 3])
def test_nearest_documents(vectors, bound):
    documents, queries = clustered(5, 200), clustered(6, 20)
    q = vectors(queries, "q").withColumnRenamed("doc_id", "query_id")
    got = knn_join(q, vectors(documents), 4, broadcast_rows=bound, block_rows=64).collect()
    distance = np.round(1 - cosine(queries, documents), 9)
    for i in range(len(queries)):
        mine = sorted((r for r in got if r.query_id == f"q{i:05d}"), key=lambda r: r["rank"])
        best = np.lexsort((np.arange(len(documents)), distance[i]))[:4]
        assert [int(r.doc_id[1:]) for r in mine] == best.tolist()
        assert [r.distance for r in mine] == pytest.approx(distance[i, best].tolist(), abs=1e-8)


def test_fewer_documents_than_k(vectors):
    q = vectors(clustered(7, 3), "q").withColumnRenamed("doc_id", "query_id")
    assert knn_join(q, vectors(clustered(8, 300)[:2]), 5).count() == 6
    assert knn_join(q, vectors(clustered(8, 20)).limit(0), 5).count() == 0
    assert knn_join(q.limit(0), vectors(clustered(8, 20)), 5).count() == 0


def test_empty_inputs(vectors):
    none = vectors(clustered(1, 20)).limit(0)
    assert similarity_join(none, threshold=0.5).count() == 0
    assert radius_counts(none, 0.5).count() == 0


# -- blocks, bounds and schedules ------------------------------------------------------------


def stored(frame, **layout):
    rows = frame.selectExpr("doc_id AS id", "embedding AS vec", "xxhash64(doc_id) AS h")
    return block_pairs.pack(rows, **layout)


def tight_clusters(seed: int, clusters: int, each: int = 40, width: int = 16) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(clusters, width))
    return (np.repeat(centers, each, axis=0) + 0.02 * rng.normal(size=(clusters * each, width))).astype(np.float32)


def test_blocks_hold_every_row_once_and_keep_their_spread(vectors):
    rows = np.vstack([clustered(9, 400), np.tile(clustered(9, 1), (300, 1))])
    packed = stored(vectors(rows), block_rows=25)
    seen = []
    for row in packed.frame.collect():
        mine = np.frombuffer(row.vectors, np.float32).reshape(row.rows, -1)
        assert [rows[int(i[1:])].tolist() for i in row.id] == mine.tolist()
        lengths = np.linalg.norm(mine, axis=1)
        cosine = mine[lengths > 0] @ np.array(row.center) / lengths[lengths > 0]
        assert (np.arccos(np.clip(cosine, -1, 1)) <= row.spread + 2e-3).all()
        assert row.rows <= 60  # about a block; equal rows are split by hash
        seen += row.id
    assert sorted(seen) == [f"d{i:05d}" for i in range(700)]


@pytest.mark.parametrize("threshold", [0.9, 0.5])
def test_schedule_leaves_out_no_pair_that_matters(vectors, monkeypatch, threshold):
    rows, others = clustered(10), clustered(11, 120)
    monkeypatch.setattr(block_pairs, "GROUP", 5)
    a, b = stored(vectors(rows), block_rows=12), stored(vectors(others), block_rows=12)
    theta = float(np.arccos(threshold))
    home = {int(i[1:]): r.block for r in a.frame.collect() for i in r.id}
    guest = {int(i[1:]): r.block for r in b.frame.collect() for i in r.id}
    pairs = [tuple(r) for r in block_pairs.schedule(a, None, theta).collect()]
    assert len(pairs) == len(set(pairs)) and all(x <= y for x, y in pairs)
    needed = {tuple(sorted((home[i], home[j]))) for i, j in zip(*np.nonzero(cosine(rows, rows) >= threshold))}
    assert needed <= set(pairs)
    across = {tuple(r) for r in block_pairs.schedule(a, b, theta).collect()}
    assert {(home[i], guest[j]) for i, j in zip(*np.nonzero(cosine(rows, others) >= threshold))} <= across
    if threshold == 0.9:
        assert len(across) < 0.7 * a.blocks * b.blocks


def test_copies_grow_with_the_data_where_it_is_clustered(vectors):
    counts = {}
    for clusters in (10, 40):
        packed = stored(vectors(tight_clusters(12, clusters)), block_rows=40)
        counts[clusters] = packed.blocks, block_pairs.schedule(packed, None, float(np.arccos(0.9))).count()
    # four times the rows: every pair of blocks would be sixteen times as many
    assert counts[40][1] < 6 * counts[10][1]
    assert counts[40][1] < 0.2 * counts[40][0] ** 2 / 2


@pytest.mark.parametrize("width", [32, 96])
def test_bound_from_some_dimensions_loses_nothing(width):
    rng = np.random.default_rng(13)
    scale = np.linspace(1, 0.02, width)
    sides = []
    for k in range(2):
        m = (rng.normal(size=(700, width)) * scale).astype(np.float32)
        m[:50] = m[50:100] * 2 if k else m[:50]
        sides.append(block_pairs.Block(k, None, m, np.eye(width, dtype=np.float32)[0], np.pi))
    sides[1].vectors[:300] = sides[0].vectors[:300] + 0.05 * rng.normal(size=(300, width)).astype(np.float32)
    found = {(i, j) for ii, jj, _ in similarity.hits(*sides, 0.95) for i, j in zip(ii.tolist(), jj.tolist())}
    expected = np.nonzero(cosine(sides[0].vectors, sides[1].vectors) >= 0.95)
    assert found == set(zip(*(x.tolist() for x in expected))) and len(found) > 100


def test_search_by_cells_visits_few_and_finds_all(vectors):
    documents = tight_clusters(14, 30)
    queries = np.vstack([documents[::97] + 0.01, clustered(15, 5, 16)])
    asked = vectors(queries, "q").selectExpr("doc_id AS id", "embedding AS vec")
    search = nearest.Search()
    packed = nearest.packed_documents(vectors(documents), "doc_id", "embedding", block_rows=40)
    got = nearest.cell_knn(asked, packed, 7, search).collect()
    distance = np.round(1 - cosine(queries, documents), 9)
    for i in range(len(queries)):
        mine = sorted((r for r in got if r.query_id == f"q{i:05d}"), key=lambda r: r["rank"])
        best = np.lexsort((np.arange(len(documents)), distance[i]))[:7]
        assert [int(r.doc_id[1:]) for r in mine] == best.tolist()
    assert search.queries == len(queries) and search.blocks == packed.blocks
    assert 0 < search.share < 0.5 and search.visits[0] == len(queries)


def test_search_by_cells_on_odd_inputs(vectors):
    asked = vectors(clustered(16, 4)).selectExpr("doc_id AS id", "embedding AS vec")
    few = nearest.packed_documents(vectors(clustered(16, 30)), "doc_id", "embedding", block_rows=7)
    assert nearest.cell_knn(asked, few, 50).count() == 4 * 30
    none = nearest.packed_documents(vectors(clustered(16, 30)).limit(0), "doc_id", "embedding")
    assert nearest.cell_knn(asked, none, 3).count() == 0
    assert nearest.cell_knn(asked.limit(0), few, 3).count() == 0


def test_angles_are_held_for_a_few_rows_at_a_time(monkeypatch):
    units = block_pairs.unit(clustered(23, 400)).astype(np.float32)
    places = block_pairs._Places(units[:50])
    whole = places.keys(units)
    monkeypatch.setattr(block_pairs, "ANGLES", 350)
    assert block_pairs.rows_at_once(50) == 7 and block_pairs.rows_at_once(10**6) == 1
    assert (places.keys(units) == whole).all()
    batch = pa.record_batch({"vec": [[1.0], None, [2.0], [3.0], [4.0]]})
    assert [b.num_rows for b in block_pairs.with_vectors([batch], 3)] == [3, 1]


@pytest.mark.parametrize("layout", [{}, {"block_rows": 30}])
def test_what_a_pair_of_blocks_gives_goes_out_in_pieces(vectors, layout):
    packed = stored(vectors(clustered(18, 90)), **layout)

    def work(a, b, same):
        for _ in range(3):
            yield pa.table({"a": [a.number], "b": [b.number]})

    met = block_pairs.meet(packed, None, np.pi, work, "a bigint, b bigint").groupBy("a", "b").count().collect()
    assert len(met) == packed.blocks * (packed.blocks + 1) // 2 and {r["count"] for r in met} == {3}


def test_pairs_bring_the_columns_asked_for(vectors):
    rows = clustered(19, 120)
    frame = vectors(rows).selectExpr("*", "array(doc_id) AS names")
    got = similarity_join(frame, threshold=0.9, give=["names"], block_rows=30).collect()
    assert len(got) > 100 and all((r.names_a, r.names_b) == ([r.id_a], [r.id_b]) for r in got)


def test_few_pairs_of_blocks_are_dealt_to_all_cores():
    together, tasks = block_pairs.dealing(136, 6)
    assert 136 / together >= 6 * 6 and tasks >= 136 / together
    assert block_pairs.dealing(10**6, 6) == (block_pairs.PARTNERS, block_pairs.MAX_TASKS)
    assert block_pairs.dealing(0, 6)[1] == 1


def test_a_small_table_is_cut_into_several_blocks(vectors, monkeypatch):
    monkeypatch.setattr(block_pairs, "SINGLE_ROWS", 100)
    monkeypatch.setattr(block_pairs, "LEAST_ROWS", 10)
    assert stored(vectors(clustered(26, 320))).blocks >= block_pairs.LEAST_BLOCKS


@pytest.mark.parametrize("threshold", [0.9, 0.0])
def test_products_are_held_for_a_few_rows_at_a_time(monkeypatch, threshold):
    monkeypatch.setattr(similarity, "_CELLS", 2000)
    rows = clustered(27, 300)
    sides = [block_pairs.Block(k, None, m, rows[0], np.pi) for k, m in enumerate((rows, rows[:200]))]
    given = list(similarity.hits(*sides, threshold))
    assert len(given) == 30 and max(len(i) for i, _, _ in given) <= 2000
    found = {(i, j): s for part in given for i, j, s in zip(*(x.tolist() for x in part))}
    sims = cosine(*(s.vectors for s in sides))
    assert set(found) == set(zip(*(x.tolist() for x in np.nonzero(sims >= threshold)))) and len(found) > 2000
    assert all(abs(s - sims[pair]) < 1e-9 for pair, s in found.items())


def test_rows_of_a_piece_leave_the_task_once():
    rows = pa.table({"id": ["a", "b", "c", "d"], "names": [["x"], [], ["z"], None]})
    out = similarity._listed(rows, np.array([3, 1, 3]), np.array([1, 0, 0]), np.array([0.5, 0.25, 1.0]))
    assert out.to_pylist() == [
        {
            "id": ["a", "b", "d"],
            "names": [["x"], [], None],
            "place_a": [2, 1, 2],
            "place_b": [1, 0, 0],
            "similarity": [0.5, 0.25, 1.0],
        }
    ]


# -- candidates by random planes -------------------------------------------------------------


def found_pairs(frame):
    pairs = [(r.id_a, r.id_b) for r in frame.collect()]
    assert len(pairs) == len(set(pairs))  # every pair once, whatever the tables
    return set(pairs)


@pytest.mark.parametrize("bucket_rows", [4096, 40])
def test_candidates_reach_their_recall_and_are_exact(vectors, bucket_rows):
    rows = np.vstack([clustered(20, 500, 12), tight_clusters(21, 3, 90, 12)])
    sims = cosine(rows, rows)
    expected = {(f"d{i:05d}", f"d{j:05d}") for i, j in zip(*np.nonzero(np.triu(sims >= 0.85, 1)))}
    got = candidates.candidate_join(vectors(rows), threshold=0.85, recall=0.95, bucket_rows=bucket_rows).collect()
    pairs = {(r.id_a, r.id_b): r.similarity for r in got}
    assert len(pairs) == len(got) and set(pairs) <= expected
    assert len(pairs) >= 0.93 * len(expected)
    assert all(abs(s - sims[int(a[1:]), int(b[1:])]) < 1e-9 for (a, b), s in pairs.items())


@pytest.mark.parametrize("bucket_rows", [4096, 25])
def test_candidates_of_two_sides(vectors, bucket_rows):
    a, b = clustered(22, 150), clustered(22, 260)
    expected = {(f"a{i:05d}", f"b{j:05d}") for i, j in zip(*np.nonzero(cosine(a, b) >= 0.9))}
    found = found_pairs(
        candidates.candidate_join(vectors(a, "a"), vectors(b, "b"), threshold=0.9, bucket_rows=bucket_rows)
    )
    assert found <= expected and len(found) >= 0.93 * len(expected)


def test_planes_follow_from_recall():
    planes = candidates.Planes.of(0.8, 0.95, 1_000_000)
    assert planes.bits == 14 and planes.recall(0.8) >= 0.95 > planes.recall(0.5)
    assert candidates.Planes.of(0.2, 0.95, 10**9).tables <= candidates.MAX_TABLES
    with pytest.raises(ValueError):
        candidates.Planes.of(0.8, 1.0, 100)


def test_planes_are_made_once_for_a_worker(monkeypatch):
    made, draw = [], np.random.default_rng
    monkeypatch.setattr(np.random, "default_rng", lambda seed: made.append(seed) or draw(seed))
    planes, units = candidates.Planes(7, 20, seed=91), block_pairs.unit(clustered(25, 700, 33))
    whole = planes.signatures(units)
    for at in range(0, 700, 100):
        assert (planes.signatures(units[at : at + 100]) == whole[at : at + 100]).all()
    assert made.count(91) == 1 and whole.max() < 1 << 7
    assert (planes.signatures(units, 5) == whole[:, :5]).all()


def test_candidates_of_nothing(vectors):
    none = vectors(clustered(1, 20)).limit(0)
    assert candidates.candidate_join(none, threshold=0.5).count() == 0
