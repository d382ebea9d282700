import math

import numpy as np
from conftest import clashing, rows_of

from playbeat.llm import embedding_neardup as E


def brute(rows, threshold=0.9):
    good = []
    for i, v in rows:
        ok = i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        good.append(np.array(v, dtype=float) if ok else None)
    n = [0] * len(rows)
    parent = {i: i for i, _ in rows if i is not None}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, x in enumerate(good):
        for b, y in enumerate(good):
            if a != b and x is not None and y is not None and len(x) == len(y) and x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= threshold:
                n[a] += 1
                lo, hi = sorted((find(rows[a][0]), find(rows[b][0])))
                parent[hi] = lo
    out = [(i, k, None if i is None else find(i), None if i is None else find(i) == i) for (i, _), k in zip(rows, n)]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def check(df, **more):
    rows = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]
    assert rows_of(E.embedding_links(df, **more)) == brute(rows)


def clusters(seed, sizes, dim=16, spread=0.1):
    rng = np.random.default_rng(seed)
    out = []
    for size in sizes:
        centre = rng.standard_normal(dim)
        out += [(centre + spread * rng.standard_normal(dim)).tolist() for _ in range(size)]
    return out


def test_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet"))


def test_groups_larger_than_windows_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 16)
    vectors = clusters(1, [70, 25, 9, 3, 1, 1, 2])
    df = clashing(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").repartition(5))
    check(df, reach=8)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.9, 0.1]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [inf, 1.0]),
        (9, [None, 1.0]), (None, [1.0, 0.0]), (10, [1.0, 0.0, 0.0]), (11, [5.0]), (12, [2.0]), (13, [-1.0]), (14, [-0.0, 3.0]), (15, [0.0, 4.0]), (-1, [1.0, 0.01]),
    ]
    check(clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))


def test_no_rows(spark):
    assert rows_of(E.embedding_links(spark.createDataFrame([], "vec_id long, embedding array<float>"))) == []


def test_recall_of_the_passes_alone(spark):
    """Before any completion the windows alone connect the clusters of a table much larger than a window."""
    vectors = clusters(3, [2] * 700, dim=32, spread=0.12)
    found = E.embedding_links(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>"), reach=8)
    x = np.array(vectors)
    x /= np.linalg.norm(x, axis=1)[:, None]
    pairs = int(((x @ x.T) >= 0.9).sum() - len(x))
    assert found.agg({"n_links": "sum"}).first()[0] >= 0.97 * pairs


def test_more_passes_for_larger_tables():
    assert E.passes_for(10**9, 0.9, 256, 0.99) > E.passes_for(10**6, 0.9, 256, 0.99) >= 12


def test_linked_pairs_within_a_dense_cone(spark):
    """A third of the rows in a cone below the threshold: bits hardly split them, so windows miss the links between them."""
    rng = np.random.default_rng(5)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    n, dim = 6000, 64
    axis = unit(rng.standard_normal(dim))
    away = rng.standard_normal((n // 3, dim))
    cone = np.sqrt(0.75) * axis + np.sqrt(0.25) * unit(away - (away @ axis)[:, None] * axis)
    apart = rng.standard_normal((300, dim))
    near = cone[:300]
    apart = unit(apart - (apart * near).sum(1)[:, None] * near)
    vectors = np.concatenate([cone, 0.905 * near + np.sqrt(1 - 0.905**2) * apart, unit(rng.standard_normal((n - n // 3 - 300, dim)))])
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    found = E.embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), reach=8)
    got = dict(found.select("vec_id", "n_links").collect())
    want = ((vectors @ vectors.T) >= 0.9).sum(1) - 1
    assert want.sum() >= 600
    assert sum(got.values()) >= 0.99 * want.sum()


def test_sureness_counts_only_what_a_window_holds():
    marks = np.array([0, 1, 2, 3, 1 << 62, (1 << 62) + 1], np.int64)
    whole = E.sureness(marks, 2, 0.5, 0, 6, True, True)
    cut = E.sureness(marks, 2, 0.5, 0, 6, False, False)
    assert whole[0] == -math.log1p(-(0.5**63)) and (cut <= whole).all()
    assert E.sureness(np.zeros(9, np.int64), 2, 0.5, 4, 5, True, True)[0] == 0
    assert E.sureness(np.zeros(2, np.int64), 2, 0.5, 0, 2, True, True).min() > 20


def test_vectors_of_extreme_length(spark):
    """Finite vectors link by their angle however large or small they are."""
    near, far = [1.0, 1.0, 1.0001], [1.0, -1.0, 0.5]
    rows = [(10 * i + j, [x * s for x in v]) for i, s in enumerate((1e160, 1e-170, 1e-200, 3.0, 1e307)) for j, v in enumerate(([1.0, 1.0, 1.0], near, far))]
    got = {r.vec_id: (r.n_links, r.component_id) for r in E.embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {i: (9, 0) if i % 10 < 2 else (4, 2) for i, _ in rows}
