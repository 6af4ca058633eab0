"""Nearest vectors against brute force: exact at factor one, recall at the registered factor."""

import numpy as np
import pytest

from tagloom.llm import vector_search as vs
from tagloom.llm.queries import RELAX
from tagloom.llm.vector_search import exact_cosine, first_of_equal, nearest


def brute(rows, every=50, k=5):
    usable = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v is not None and None not in v]
    usable = [(i, v) for i, v in usable if len(v) and np.isfinite(v).all() and v.any()]
    out = []
    asked = {}
    for i, v in usable:
        if i % every == 0:
            asked.setdefault(i, v)
    for i, v in asked.items():
        others = [(j, w) for j, w in usable if j != i and len(w) == len(v)]
        if others:
            ids = np.array([j for j, _ in others])
            score = exact_cosine(v[None, :], np.stack([w for _, w in others]))
            for rank, at in enumerate(np.lexsort((ids, -score))[:k], 1):
                out.append((i, rank, int(ids[at]), float(score[at])))
    return sorted(out)


def run(spark, rows, **more):
    frame = spark.createDataFrame([(*r, 7) for r in rows], "vec_id long, embedding array<float>, score int").repartition(3)
    got = nearest(frame, **more)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, got.collect()))


def as_float(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


def test_planted(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(1, 120)]
    same = rng.normal(size=4).tolist()
    rows += [(i, same) for i in range(200, 460)]  # a large tie
    rows += [(600, None), (650, [0.0] * 4), (700, [float("nan"), 1, 1, 1]), (750, [None, 1, 1, 1]), (800, [float("inf"), 1, 1, 1]),
             (850, [1.0, 2.0]), (851, [2.0, 1.0]), (None, same), (900, []), (950, [1.0, 2.0, 3.0])]
    rows = as_float(rows)
    assert run(spark, rows) == brute(rows)


def test_copies(spark):
    """Half of the rows share one vector, some ids repeat; a few rows of a group of copies decide."""
    rng = np.random.default_rng(5)
    same = rng.normal(size=8).tolist()
    rows = [(i, same if i % 2 else rng.normal(size=8).tolist()) for i in range(1, 800)]
    rows += [(100 * i, same) for i in range(1, 8)] + [(300, same), (300, same), (7, same), (7, same), (7, rng.normal(size=8).tolist())]
    rows = as_float(rows)
    # Which of the rows of a repeated id asks is open, so those ids do not ask here.
    want = [r for r in brute(rows) if r[0] % 100]
    assert [r for r in run(spark, rows) if r[0] % 100] == want and want
    raw = np.repeat(np.array([same, same[::-1], same]), [9000, 3, 9000], axis=0)
    assert first_of_equal(raw, 6).tolist() == [0, 1, 2, 3, 4, 5, 9000, 9001, 9002]


def test_empty(spark):
    assert run(spark, []) == []


@pytest.fixture(scope="module")
def vectors(spark):
    return [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()]


def test_exact_at_one(spark, vectors):
    assert run(spark, vectors) == brute(vectors)


def test_recall(spark, vectors):
    want = {(q, v) for q, _, v, _ in brute(vectors)}
    for relax in (RELAX, 1.5, 2.0):
        got = {(q, v) for q, _, v, _ in run(spark, vectors, relax=relax)}
        print(relax, len(want & got) / len(want))
        assert relax > RELAX or len(want & got) >= 0.9 * len(want)


def test_routes(monkeypatch, spark):
    """Clustered vectors over many small leaves: exact at one, most leaves are left out, a hot leaf is cut."""
    monkeypatch.setattr(vs, "SHARD_VECTORS", 64)
    monkeypatch.setattr(vs, "QUERY_BLOCK", 16)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 6)) * 10
    rows = [(i, (centres[i % 12] + rng.normal(size=6) * 0.2).tolist()) for i in range(1, 1501)]
    rows += [(i, centres[0].tolist()) for i in range(2000, 2700)]  # a third share one vector
    rows += [(50, centres[1].tolist()), (7, centres[2].tolist()), (7, centres[2].tolist())]
    rows = as_float(rows)
    assert [r for r in run(spark, rows) if r[0] != 50] == [r for r in brute(rows) if r[0] != 50]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    usable = vs._usable(frame, "vec_id", "embedding")
    routes = vs.fit_routes(usable, usable.count())
    assert routes[6].leaves > 8
    dealt = vs.deal(usable, routes, 5).collect()
    assert len(dealt) < len(rows) - 500
    units = vs.unit(np.array([v for _, v in rows if v], np.float64))
    at, leaf = routes[6].reach(units, np.full(len(units), 0.05), 1.0)
    assert len(at) < len(units) * routes[6].leaves / 4
    own = routes[6].home(units)
    reached = set(zip(at.tolist(), leaf.tolist()))
    assert all((i, int(own[i])) in reached for i in range(len(units)))
    for i in range(0, len(units), 97):  # whatever lies within the limit is in a leaf that is visited
        assert all((i, int(own[j])) in reached for j in np.flatnonzero(vs.chord(units[i: i + 1], units)[0] <= 0.05))


def test_one_id_in_many_rows(spark):
    """An id of a third of the rows neither finds itself nor takes memory for each of its rows."""
    rng = np.random.default_rng(9)
    rows = as_float([(50, rng.normal(size=4).tolist()) for _ in range(400)] + [(i, rng.normal(size=4).tolist()) for i in range(1000, 1800)])
    got, want = ([r for r in x if r[0] != 50] for x in (run(spark, rows), brute(rows)))
    assert got == want
    found = [r for r in run(spark, rows) if r[0] == 50]
    assert len(found) == 5 and all(r[2] != 50 for r in found)


def test_first_of_equal_ids():
    raw = np.array([[1.0], [2.0], [1.0], [1.0], [1.0], [2.0], [1.0]])
    ids = np.array([9, 1, 4, 4, 4, 1, 7])
    assert vs.first_of_equal(raw, 2, ids, 2).tolist() == [1, 2, 3, 5, 6]
