"""The manifest against a tree built in plain Python, and its proofs."""

import hashlib
import random

import pytest
from conftest import clashing, rows_of
from pyspark.sql import functions as F

from playbeat.llm import merkle as M


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def climb(nodes):
    """Root and the siblings of every leaf."""
    ways, under = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(i, min(i + 2, len(nodes))) for i in range(0, len(nodes), 2)]
        for run in runs:
            for i in run:
                for leaf in under[i]:
                    ways[leaf] += [nodes[j] for j in run if j != i]
        nodes, under = [h("".join(nodes[i] for i in run)) for run in runs], [sum((under[i] for i in run), []) for run in runs]
    return nodes[0], ways


def brute(rows):
    """(group, rank, leaf) to (rank, leaf, subroot, root, digest of siblings), sorted."""
    names = sorted({r[0] for r in rows}, key=lambda n: (n is not None, (n or "").encode()))
    own = {n: sorted((r[1:] for r in rows if r[0] == n), key=lambda r: (r[0] is not None, r)) for n in names}
    trees = {n: climb([r[1] for r in own[n]]) for n in names}
    root, above = climb([trees[n][0] for n in names])
    return sorted(((rank, leaf, trees[n][0], root, h("".join(way + above[i]))) for i, n in enumerate(names) for (rank, leaf), way in zip(own[n], trees[n][1])), key=str)


def check(spark, rows):
    df = clashing(spark.createDataFrame(rows, "lang string, doc_id long, leaf string")).repartition(3)
    got = M.fold_proofs(M.merkle_proofs(df)).collect()
    assert all(r.verified and r.folded_root == r.root for r in got)
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256) for r in got), key=str) == brute(rows)


@pytest.mark.parametrize("levels", [2, 10])
def test_trees_of_many_sizes(spark, monkeypatch, levels):
    monkeypatch.setattr(M, "LEVELS", levels)
    r = random.Random(levels)
    sizes = {"a": 1, "b": 2, "ä": 3, None: 37, "": 64, "z": 65, "c": 1}
    rows = [(name, i, h(f"{name}{i}")) for name, n in sizes.items() for i in range(n)]
    r.shuffle(rows)
    check(spark, rows)


def test_one_row_one_group_and_one_group_a_row(spark):
    check(spark, [("x", 5, h("5"))])
    check(spark, [("x", i, h(str(i))) for i in range(5)])
    check(spark, [(f"g{i}", i, h(str(i))) for i in range(9)])


def test_repeated_rows_are_leaves_of_their_own(spark):
    check(spark, [("en", 7, h("7"))] * 300 + [("en", None, h("none"))] * 2 + [("en", 7, h("other"))] + [("de", 1, h("1"))])


def test_ancestors_of_many_leaves_are_looked_up_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(M, "LEVELS", 3)
    check(spark, [("en" if i % 3 else "fr", i, h(str(i))) for i in range(1500)])


def test_a_changed_leaf_a_missing_one_and_a_wrong_proof_do_not_verify(spark):
    rows = spark.createDataFrame([("en", i, h(str(i))) for i in range(6)], "lang string, doc_id long, leaf string")
    proofs = M.merkle_proofs(rows)
    shown = F.when(F.col("doc_id") == 2, h("forged")).when(F.col("doc_id") != 3, F.col("leaf"))
    got = {r.doc_id: r for r in M.fold_proofs(proofs.withColumn("shown", shown), leaf="shown").collect()}
    assert [i for i in range(6) if not got[i].verified] == [2, 3] and got[3].folded_root is None
    assert M.fold(h("1"), bytes(got[0].proof))[0] != got[0].root


def test_odd_rows_and_none(spark, odd, empty):
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    df = odd.withColumn("leaf", M.row_digest(columns))
    got = M.fold_proofs(M.merkle_proofs(df, keep=["doc_id"])).collect()
    text = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaves = [(r.lang, r.doc_id, h("".join(text(r[c]) for c in columns))) for r in odd.collect()]
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256) for r in got), key=str) == brute(leaves)
    none = M.fold_proofs(M.merkle_proofs(empty.withColumn("leaf", M.row_digest(columns))))
    assert rows_of(none) == [] and {"subroot", "root", "proof", "verified"} <= set(none.columns)
