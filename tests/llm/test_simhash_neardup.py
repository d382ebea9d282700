import numpy as np
import pytest
import xxhash
from conftest import rows_of
from pyspark.sql import functions as F

from playbeat.llm import simhash_neardup as H
from playbeat.llm.components import connected_components, roots


def one(text, shingle=3):
    w = (text or "").encode().lower().split()
    parts = [b" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] if len(w) >= shingle else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def grouped(rows, distance):
    """Smallest id reachable for (id, fingerprint) rows; rows of one id are one node."""
    ids = sorted({i for i, _ in rows})
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in rows:
        for j, b in rows:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_brute_force(request, table):
    df = request.getfixturevalue(table)
    source = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    rows = [(d, one(t)) for d, t in source]
    groups = grouped([r for r in rows if r[0] is not None], 3)
    want = sorted(((d, f - (1 << 64) if f >> 63 else f, groups.get(d)) for d, f in rows), key=lambda r: tuple((v is None, str(v)) for v in r))
    assert rows_of(H.simhash_components(df)) == want


def test_no_rows(empty):
    assert rows_of(H.simhash_components(empty)) == []


@pytest.mark.parametrize("distance", [0, 1, 3, 5])
def test_index_finds_every_pair(spark, distance):
    rng = np.random.default_rng(distance)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 8), False)) for b in base for _ in range(12)]
    fps = sorted(set(near) | set(map(int, base)))
    rows = list(enumerate(fps))
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for i, f in rows], "fp long, node long")
    found = {r.node: r.component for r in connected_components(H.near_edges(df, distance)).collect()}
    assert {i: found.get(i, i) for i, _ in rows} == grouped(rows, distance)


def test_hot_root_over_many_tasks(spark):
    """All fingerprints share three blocks, so one root holds them all and spans tasks."""
    rng = np.random.default_rng(5)
    fps = sorted({int(x) for x in rng.integers(0, 1 << 12, 900)})
    df = spark.createDataFrame(list(zip(fps, range(len(fps)))), "fp long, node long")
    found = {r.node: r.component for r in connected_components(H.near_edges(df, 1)).collect()}
    assert {i: found.get(i, i) for i in range(len(fps))} == grouped(list(enumerate(fps)), 1)


def test_gray_rank_orders_like_gray_code(spark):
    codes = [i ^ i >> 1 for i in range(64)]
    got = [r.x for r in spark.createDataFrame([(c,) for c in codes], "x long").orderBy(H.gray_rank(F.col("x"))).collect()]
    assert got == codes


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 2000 + i) for i in range(500)] + [(5, 5), (None, 3), (4000, 3999), (3999, 4000)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(9)
    found = {r.node: r.component for r in connected_components(df).collect()}
    assert {found[i] for i in range(301)} == {0} and {found[2000 + i] for i in range(500)} == {1000} and found[4000] == 3999
    assert len(found) == 301 + 501 + 2


def test_roots():
    nodes, root = roots(np.array([5, 3, 9]), np.array([3, 1, 8]))
    assert dict(zip(nodes.tolist(), root.tolist())) == {1: 1, 3: 1, 5: 1, 8: 8, 9: 8}
