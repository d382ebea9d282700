"""The conversation trie against plain Python, and the double array."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from conftest import clashing
from pyspark.sql import functions as F

from playbeat.llm import prefix_trie as P


def key(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()


def brute(rows, rebuilt=True):
    """All nodes of (conv, turn, role, text), by plain dictionaries."""
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, key(role or "", text or ""), (role or "", text or "")))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in turns.items()}
    heads = {c: zlib.crc32(str(c).encode()) % 4 if rebuilt else 0 for c in own}
    back = lambda c: c - (abs(c) % 20) * (1 if c >= 0 else -1)
    whole = {c: own.get(back(c), [])[:h] + own[c][h:] for c, h in heads.items()}
    nodes = {}
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    leaves, saved, children = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for path in nodes:
        if path:
            children[path[:-1]] += 1
    for path, members in nodes.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += children[path] == 0
            saved[path[:d]] += (len(members) - 1) * len(path[-1][1].split()) if path else 0
    out = []
    for path, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(whole[c]) == len(path))))
        up = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), up, len(members), children[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, rebuilt=True):
    df = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).repartition(3)
    more = {"base": F.expr("conv - conv % 20"), "head": F.crc32(F.col("conv").cast("string")) % 4, "most": 3} if rebuilt else {}
    got = P.conversation_trie(df, **more)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, rebuilt)


def talks(seed, convs, most, words=3):
    r = random.Random(seed)
    return [(c, i, r.choice(["user", "assistant"]), " ".join(r.choice(["a", "b", "c d"]) for _ in range(r.randint(0, words)))) for c in range(convs) for i in range(r.randint(1, most))]


@pytest.mark.parametrize("rebuilt", [True, False])
def test_random_talks(spark, rebuilt):
    check(spark, talks(1, 120, 6, words=1), rebuilt)


def test_long_talks_go_over_blocks_and_stretches(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 3)
    monkeypatch.setattr(P, "STRETCH", 2)
    same = [(c, i, "user", f"turn {i if i < 17 + c % 3 else (i, c % 4)}") for c in (3, 5, 8, 11, 40, 44) for i in range(29 + c % 3)]
    check(spark, [*same, *talks(2, 25, 9, words=1)])


def test_ids_without_a_start_and_odd_rows(spark):
    rows = [
        (21, 1, "user", "no conversation 20 here"), (22, 1, "user", "x"), (40, 0, None, None), (40, 0, None, None), (41, 0, "", ""), (47, 5, "user", "one  two\tthree"),
        (47, None, "user", "first, as null is"), (None, 0, "user", "of no conversation"), (-3, 0, "user", "a"), (-3, 0, "user", "b"), (0, 0, "us", "er x"), (1, 0, "user", " x"),
        (9, 1, "user", "w " * 50_000), (9, 0, "user", "w"),
    ]
    check(spark, rows)
    check(spark, rows, rebuilt=False)


def test_many_copies_of_one_talk(spark, monkeypatch):
    monkeypatch.setattr(P, "CHUNK", 7)
    copies = [(c, i, "user", f"same {i}") for c in range(100, 700) for i in range(3)]
    check(spark, [*copies, *[(c, 0, "user", f"other {c}") for c in range(700, 1100)]], rebuilt=False)


def test_no_rows(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert P.conversation_trie(none).collect() == []


def test_double_array():
    r = np.random.default_rng(4)
    rows = np.zeros((900, 6), np.int64)
    for i, n in enumerate(r.integers(1, 7, 900)):
        rows[i, :n] = r.integers(1, 40, n)
    trie = P.DoubleArray(rows)
    states = trie.walk(rows)
    assert ((states >= 0) == (rows > 0)).all()
    paths = {}
    for row, own in zip(rows.tolist(), states.tolist()):
        for d in range(6):
            if row[d]:
                assert paths.setdefault(own[d], tuple(row[: d + 1])) == tuple(row[: d + 1])
    assert len(paths) == len({tuple(row[: d + 1]) for row in rows.tolist() for d in range(6) if row[d]})
    assert len(trie.check) <= 4 * len(paths) + 1024
    other = r.integers(1, 60, (500, 6))
    known = {p for p in paths.values()}
    for row, own in zip(other.tolist(), trie.walk(other).tolist()):
        for d in range(6):
            assert (own[d] >= 0) == (tuple(row[: d + 1]) in known)
