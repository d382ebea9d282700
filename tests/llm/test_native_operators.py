"""Licence scans and source mixing against plain Python; both are DataFrame operations alone."""

import hashlib
import math
import random
import re
from collections import defaultdict

import pytest
from conftest import clashing, rows_of
from pyspark.sql import functions as F

from playbeat.llm import license_scan as S
from playbeat.llm import mixing as M


def scanned(text):
    lowered = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    hits = [(i, label) for phrase, label in S.PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in hits]
    return (len(words), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in hits})))


def base(df):
    return rows_of(df.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"))


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_base_labels(request, table):
    df = request.getfixturevalue(table)
    got = S.scan_licenses(df)
    want = [(r.doc_id, *scanned(r.text)) for r in df.select("doc_id", "text").collect()]
    assert base(got) == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))
    assert got.where("n_base > 0 AND score <> 1").count() == 0 and got.where("labels = '' AND score <> 0").count() == 0
    assert got.where("n_base > 0 AND NOT array_contains(split(labels, ','), split(base_labels, ',')[0])").count() == 0


def test_strange_texts(spark):
    rnd = random.Random(2)
    parts = ["mit", "MIT", "License", "license", "apache", "general", "PUBLIC", "public", "x", "é", "mİt", "Kit", "K", "licensé"]
    rows = [(i, rnd.choice([" ", "-", "\x00", "\n"]).join(rnd.choice(parts) for _ in range(rnd.randint(0, 40)))) for i in range(300)]
    df = spark.createDataFrame([*rows, (5, "mit license " * 4000), (5, "mit license " * 4000), (6, None)], "doc_id long, text string")
    assert base(S.scan_licenses(df)) == sorted(((d, *scanned(t)) for d, t in [*rows, *[(5, "mit license " * 4000)] * 2, (6, None)]), key=lambda r: tuple((v is None, str(v)) for v in r))


def test_templates_with_changes(spark):
    mit = S.TEMPLATES["mit"]
    words = mit.split()
    rows = [
        (1, "x y " + mit + " z"), (2, " ".join([*words[:8], "new", *words[8:]])), (3, " ".join(words[:10] + words[12:])),
        (4, " ".join(words[:10])), (5, "Licensed under CC BY-NC 4.0."), (6, "GNU General Public License, version 3"), (7, " ".join(reversed(words))),
        (8, "gnu general public license version"),
    ]
    got = {r.doc_id: r for r in S.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].labels for i in (1, 2, 3, 4)] == ["mit", "mit", "mit", ""]
    assert got[1].spans[0].first == 2 and got[1].spans[0].end == 2 + len(words) and got[1].score == 1.0
    assert 0.8 <= got[3].score < 1 and got[4].score == 0
    assert got[5].labels == "cc-by-nc-4.0" and got[6].labels == "gpl,gpl-3.0" and got[7].labels == "" and got[8].labels == "gpl"


GPL = "GNU General Public License as published by the Free Software Foundation, either version"
CC = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."


@pytest.mark.parametrize("text, labels", [
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2.0"),
    ("This source code is subject to all the terms of the Mozilla Public License, v. 2.0.", "mpl-2.0"),
    (f"under the terms of the {GPL} 3 of the License", "gpl,gpl-3.0"),
    (f"under the terms of the {GPL} 2 of the License", "gpl,gpl-2.0"),
    (f"{GPL} 4", "gpl"),
    ("the GNU General Public License just as published by the Free Software Foundation, either version 3", "gpl,gpl-3.0"),
    (GPL.replace("General", "Lesser General") + " 3", "gpl,lgpl"),
    ("Licensed under the new Apache License, Version 2.0", "apache,apache-2.0"),
    ("Licensed under the Apache License, Version 1.0 (the License); you may not use this file except in compliance with the License.", "apache"),
    ("Licensed under Apache License, Version 2.0 (the License), and you may not use this file but in compliance with it.", "apache,apache-2.0"),
    (CC.format(""), "cc-by-4.0,creative-commons"),
    (CC.format("-ShareAlike"), "cc-by-sa-4.0,creative-commons"),
    (CC.format("-NonCommercial").replace("licensed", "hereby licensed"), "cc-by-nc-4.0,creative-commons"),
])
def test_notices(spark, text, labels):
    rows = [(1, f"Some words first. {text} And others after it."), (2, " ".join(reversed(text.split())))]
    got = {r.doc_id: r.labels for r in S.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == labels and not set(got[2].split(",")) - {"gpl", "mit", "apache", ""}


def test_scan_without_rows(empty):
    assert rows_of(S.scan_licenses(empty)) == []


def test_short_templates_are_refused(spark, odd):
    with pytest.raises(ValueError):
        S.scan_licenses(odd, phrases={"mit": "mit"})


def poured(room, weight, above):
    """Budgets of siblings, by raising the level until nothing is left or nobody has room."""
    low, high = 0.0, max((r / w for r, w in zip(room, weight) if w > 0), default=0)
    if sum(r for r, w in zip(room, weight) if w > 0) <= above:
        return [r if w > 0 else 0 for r, w in zip(room, weight)]
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(r, w * mid) for r, w in zip(room, weight)) < above else (low, mid)
    return [min(r, w * low) for r, w in zip(room, weight)]


def budgets(tree, weights, total, epochs, level=0):
    """{leaf path: budget} of {path: tokens}, weights by level."""
    groups = defaultdict(dict)
    for path, n in tree.items():
        groups[path[level]][path] = n
    usable = lambda path: all(weights[i].get(path[i], 1.0) > 0 for i in range(len(path)))
    names = sorted(groups)
    room = [sum(n * epochs for p, n in groups[x].items() if usable(p)) for x in names]
    shares = poured(room, [weights[level].get(x, 1.0) for x in names], total)
    out = {}
    for x, b in zip(names, shares):
        out |= {p: b for p in groups[x]} if level == len(weights) - 1 else budgets(groups[x], weights, b, epochs, level + 1)
    return out


@pytest.mark.parametrize("share,epochs", [(0.3, 1), (0.9, 1), (1.4, 2), (9.0, 3)])
def test_budgets(spark, share, epochs):
    rnd = random.Random(epochs)
    tree = {(d, la, f"s{s}"): rnd.choice([0, 3, 50, 1000, 40_000]) for d in "abc" for la in ("en", "de") for s in range(4)}
    weights = [{"a": 5, "b": 3}, {"en": 0.7, "de": 0.3}, {"s0": 0.0, "s1": 2.5}]
    leaves = spark.createDataFrame([(*p, n) for p, n in tree.items()], "a string, b string, c string, tokens long")
    total = math.floor(share * sum(tree.values()))
    got = {(r.a, r.b, r.c): r for r in M.leaf_budgets(leaves, ["a", "b", "c"], weights, total, epochs).collect()}
    want = budgets(tree, weights, total, epochs)
    for p, b in want.items():
        assert abs(got[p].budget - b) <= 1 and got[p].budget <= tree[p] * epochs
        assert got[p].epochs * got[p].tokens + got[p].rest == got[p].budget or got[p].tokens == 0
    assert sum(r.budget for r in got.values()) <= total


def chosen(rows, path, plan, seed):
    """(id, epoch) of the rows, from the leaves' budgets."""
    out, leaves = [], defaultdict(list)
    for r in rows:
        leaves[path(r)].append(r)
    for p, own in leaves.items():
        tokens, budget = sum(r[1] for r in own), plan[p]
        if budget <= 0 or tokens <= 0:
            continue
        whole, rest = divmod(budget, tokens)
        key = lambda r: hashlib.md5("|".join([str(seed), str(whole), *([] if r[0] is None else [str(r[0])])]).encode()).hexdigest()  # noqa: B023,E731
        seen = 0
        upto = {}
        for k in sorted({key(r) for r in own}):
            seen += sum(r[1] for r in own if key(r) == k)
            upto[k] = seen
        for r in own:
            out += [(r[0], e) for e in range(whole + (rest > 0 and upto[key(r)] <= rest))]
    return sorted(out, key=str)


@pytest.mark.parametrize("share,epochs", [(0.5, 1), (1.5, 3)])
def test_selection(spark, share, epochs):
    rnd = random.Random(7)
    rows = [(i, rnd.choice([0, 1, 5, 200]), rnd.choice(["en", "de", None]), f"s{min(rnd.randint(0, 9), 3)}") for i in range(700)]
    rows += [(5, 5, "en", "s3"), (5, 5, "en", "s3"), (None, 9, "de", "s1")]
    df = clashing(spark.createDataFrame(rows, "doc_id long, size long, lang string, source string").withColumn("text", F.lit("x"))).repartition(6)
    path = {"lang": F.col("lang"), "source": F.col("source")}
    mixed = M.mix_sources(df, path, {"lang": {"en": 3, "de": 1}}, share=share, most_epochs=epochs, tokens=F.col("size"), seed=3)
    got = sorted(((r.doc_id, r.epoch) for r in mixed.collect()), key=str)
    tree = defaultdict(int)
    where = lambda r: (r[2] or "", r[3])
    for r in rows:
        tree[where(r)] += r[1]
    leaves = spark.createDataFrame([(*p, n) for p, n in tree.items()], "a string, b string, tokens long")
    plan = {(r.a, r.b): r.budget for r in M.leaf_budgets(leaves, ["a", "b"], [{"en": 3, "de": 1}, {}], math.floor(share * sum(tree.values())), epochs).collect()}
    assert got == chosen(rows, where, plan, 3)
    assert set(mixed.columns) == {*df.columns, "epoch"}


def test_mixing_edge_rows(odd, empty):
    path = {"lang": F.col("lang"), "source": F.col("source")}
    assert M.mix_sources(empty, path, {}).count() == 0
    whole = M.mix_sources(odd, path, {}, share=1.0, most_epochs=1)
    words = odd.withColumn("n_", M.word_count(F.col("text")))
    assert whole.where(M.word_count(F.col("text")) > 0).count() == words.where("n_ > 0").count()
    none = M.mix_sources(odd, path, {"lang": {"en": 0.0}}, share=1.0, most_epochs=1)
    assert none.where("lang = 'en'").count() == 0 and none.count() > 0


def test_plans_have_no_python(spark, documents):
    for df in (S.scan_licenses(documents), M.mix_sources(documents, {"lang": F.col("lang")}, {})):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)
