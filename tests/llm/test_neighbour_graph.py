"""Nearest neighbours through graphs against all pairs."""

import math

import numpy as np
import pytest
from conftest import clashing

from __spark_entry__ import queries
from playbeat.llm import neighbour_graph as G

SF = "/root/testdata/sf0.1"


def brute(rows, asked, k):
    """(query, rank) to (vec_id, score) over all (vec_id, vector)."""
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in {i for i, _ in good if asked(i)}:
        score = {}
        for own in (v for i, v in good if i == q):
            for i, v in good:
                if i != q and len(v) == len(own):
                    score[i] = max(score.get(i, -math.inf), math.fsum(a * b for a, b in zip(own, v)))
        for rank, (i, s) in enumerate(sorted(score.items(), key=lambda r: (-r[1], r[0]))[:k], 1):
            out[q, rank] = (i, s)
    return out


def check(df, k=4, **more):
    """Few vectors: the beam holds all, so the result is exact."""
    rows = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]
    got = G.nearest_neighbours(df, df.where("vec_id % 2 = 0"), k=k, **more).collect()
    want = brute(rows, lambda i: i % 2 == 0, k)
    assert {(r.query_id, r.rank): r.vec_id for r in got} == {key: i for key, (i, _) in want.items()} and len(got) == len(want)
    assert all(math.isclose(r.score, want[r.query_id, r.rank][1], rel_tol=1e-12, abs_tol=1e-300) for r in got)


def test_recall_on_the_whole_table(spark):
    found = {}
    for r in queries()["op12_nearest_neighbours"](spark, SF).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    hits = 0
    for q in np.flatnonzero(ids % 20 == 0):
        own = found[ids[q]]
        score = x @ x[q]
        assert sorted(own) == list(range(1, 21)) and ids[q] not in {i for i, _ in own.values()}
        assert all(own[k] != own[k + 1] and (-own[k][1], own[k][0]) < (-own[k + 1][1], own[k + 1][0]) for k in range(1, 20))
        assert np.allclose([s for _, s in own.values()], [score[np.flatnonzero(ids == i)[0]] for i, _ in own.values()], rtol=1e-12)
        score[q] = -np.inf
        hits += len({i for i, _ in own.values()} & set(ids[np.argsort(-score)[:20]].tolist()))
    assert len(found) == (ids % 20 == 0).sum() and hits >= 0.95 * 20 * len(found)


@pytest.mark.parametrize("norms", ["equal", "spread"])
def test_recall_in_clusters_and_of_vectors_of_any_length(norms):
    """Also where a third of all rows is one tight cluster, and where lengths differ tenfold."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((20, 24))
    x = np.concatenate([centres[rng.integers(0, 20, 2000)] + 0.4 * rng.standard_normal((2000, 24)), centres[0] + 0.05 * rng.standard_normal((1000, 24))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if norms == "spread":
        x *= rng.uniform(0.1, 1, (3000, 1))
    squares = (x * x).sum(1)
    long = np.concatenate([x, np.sqrt(squares.max() - squares)[:, None]], axis=1).astype(np.float32)
    graph, entries = G.build(long, G.Shape(), 1)
    near, _ = G.search(x.astype(np.float32), graph, entries, x[::20].astype(np.float32), G.Shape().beam)
    like = x[::20] @ x.T
    least = np.sort(like, axis=1)[:, -20]
    found = [(like[i][row[row >= 0]] >= least[i] - 1e-6).sum() for i, row in enumerate(near)]
    assert np.minimum(found, 20).mean() >= 0.95 * 20
    assert (graph >= 0).sum(1).max() <= G.Shape().degree and graph.max() < 3000
    assert all(i not in row for i, row in enumerate(graph.tolist()))


def test_pruning_keeps_directions():
    """Of two neighbours in one direction only the nearer stays, unless the other is not much nearer to it than to the point."""
    angle = lambda degrees: [math.cos(math.radians(degrees)), math.sin(math.radians(degrees))]
    x = np.array([angle(d) for d in (0, 10, 14, -20, 40)], np.float32)
    kept = G.prune(x, np.array([0]), np.array([[4, 2, 3, 1, 1, -1, 0]], np.int32), 1.0, 4, 1.2)
    assert kept.tolist() == [[1, 3, -1, -1]]


def test_shards_lanes_and_ties(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(-2, 3, 3).astype(float).tolist()) for i in range(90)]
    check(clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).repartition(5), shard_rows=20, lane_queries=9)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.9, 0.1]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [inf, 1.0]),
        (10, [None, 1.0]), (None, [1.0, 0.5]), (12, [1.0, 2.0, 3.0]), (14, [3.0, 1.0, 1.0]), (16, [5.0]), (18, [1e150, 2.0]), (20, [-1e-200, 1e-200]), (2, [0.0, 4.0]),
    ]
    rows += [(100 + i, [0.5, 0.5]) for i in range(40)] * 2
    check(clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), shard_rows=3)


def test_floats_and_whole_numbers(spark):
    rows = [(i, [i % 5, 1, i % 3]) for i in range(30)]
    check(spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<float>"))
    check(spark.createDataFrame(rows, "vec_id int, embedding array<int>"))


def test_no_rows_and_one(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert G.nearest_neighbours(none, none).collect() == []
    one = spark.createDataFrame([(2, [1.0])], "vec_id long, embedding array<float>")
    assert G.nearest_neighbours(one, one).collect() == []
