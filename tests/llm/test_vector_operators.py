"""Near-duplicate vectors and nearest neighbours against brute force and awkward rows."""

import numpy as np
import pytest
from brute import vector_links

from gleanery.llm import collision_search, pq_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, list int, a string, vector int"


def awkward_vectors():
    rng = np.random.default_rng(3)
    base = rng.standard_normal((6, 16))
    rows = []
    for i in range(150):  # chains of near vectors around the threshold, copies, scaled copies
        v = base[i % 6] + rng.standard_normal(16) * (0.02 + 0.001 * i)
        rows.append((i, (v * (1 + i % 5)).tolist(), i % 3))
    rows += [(200 + i, rows[5][1], 2) for i in range(30)]
    rows += [
        (300, None, 1),
        (301, [], 1),
        (302, [0.0] * 16, 1),
        (303, [float("nan")] + [1.0] * 15, 1),
        (304, [float("inf")] + [1.0] * 15, 1),
        (305, [None] + [1.0] * 15, 1),
        (306, rows[5][1], None),
        (307, [1e-30] * 16, 0),
        (308, [1e-30] * 16, 0),
        (309, [1.0, 2.0], 0),
        (310, [2.0, 4.0], 0),
        (311, [3e38] * 16, 0),
    ]
    return rows


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame([(i, v, label, 1, "x", 2) for i, v, label in awkward_vectors()], SCHEMA)


@pytest.mark.parametrize("block", [8, 1024])
def test_links_against_brute_force(spark, vectors, monkeypatch, block):
    monkeypatch.setattr(pq_dedup, "BLOCK", block)
    monkeypatch.setattr(pq_dedup, "VECTORS_PER_CENTRE", 16)
    wanted = vector_links([(i, None if v is None else [None if x is None else np.float32(x) for x in v], label) for i, v, label in awkward_vectors()], 0.98)
    rows = pq_dedup.linked(vectors).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in rows} == wanted
    assert all(r.kept == (r.component_id == r.vec_id) for r in rows)
    assert max(n for n, _ in wanted.values()) > 30


def test_links_of_repeated_and_nameless_rows(spark, vectors):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (None, [0.0, 1.0], 1), (2, [0.0, 1.0], 2)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in pq_dedup.linked(table).collect())
    assert found == [("1", 2, "1", True), ("1", 2, "1", True), ("2", 0, "2", True), ("None", 0, "None", True), ("None", 2, "1", False)]
    assert pq_dedup.linked(vectors.limit(0)).count() == 0


def nearest(rows, queries, k):
    usable = {i: np.array(v, np.float32).astype(float) for i, v, _ in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    found = {}
    for q in queries:
        if q in usable:
            near = [(-float(usable[q] @ v), i) for i, v in usable.items() if i != q and len(v) == len(usable[q])]
            found[q] = [i for _, i in sorted(near)[:k]]
    return found


def test_search_on_awkward_rows(spark, vectors):
    rows = [row for row in awkward_vectors() if row[0] != 311]
    found = {}
    for r in collision_search.search(vectors.filter("vec_id <> 311"), vectors.filter("vec_id % 20 = 0")).collect():
        found.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    wanted = nearest(rows, range(0, 400, 20), 20)
    assert {q: [own[i + 1][0] for i in range(len(own))] for q, own in found.items()} == {q: own for q, own in wanted.items() if own}
    assert collision_search.search(vectors.limit(0), vectors.limit(0)).count() == 0
    assert collision_search.search(vectors, vectors.limit(0)).count() == 0


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_recall(spark, folder, monkeypatch):
    monkeypatch.setattr(collision_search, "SHARD", 400)
    table = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet")
    own = table.toPandas()
    matrix = np.stack(own["embedding"]).astype(float)
    found = collision_search.search(table, table.filter("vec_id % 20 = 0")).toPandas()
    hits = total = 0
    for place in np.flatnonzero(own["vec_id"] % 20 == 0):
        scores = matrix @ matrix[place]
        scores[place] = -np.inf
        wanted = set(own["vec_id"].to_numpy()[np.argsort(-scores)[:20]])
        got = found[found.query_id == own["vec_id"][place]].sort_values("rank")
        assert np.allclose(got["score"], np.sort(scores)[::-1][:20], rtol=0, atol=0.2) and (np.diff(got["score"]) <= 0).all()
        hits, total = hits + len(wanted & set(got["vec_id"])), total + 20
    assert hits >= 0.98 * total
