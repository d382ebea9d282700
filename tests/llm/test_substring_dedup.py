import hypothesis.strategies as st
import numpy as np
from conftest import rows_of  # noqa: F401  (the nearest conftest)
from hypothesis import given, settings

from playbeat.llm import substring_dedup as S


def brute(rows, window=13):
    words = [((t or "").encode().split(), d) for d, t in rows]
    least = {}
    for w, d in words:
        if d is not None:
            for i in range(len(w) - window + 1):
                g = tuple(w[i : i + window])
                least[g] = min(d, least.get(g, d))
    out = []
    for w, d in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1 if d is not None else 0):
            if least[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        out.append((d, b" ".join(x for x, g in zip(w, gone) if not g).decode(), len(w), sum(gone)))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def check(df, window=13, **more):
    got = rows_of(S.remove_repeated_windows(df, window=window, **more))
    assert got == brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], window)


def test_documents(documents):
    check(documents)


def test_small_windows_and_many_buckets(documents):
    check(documents, window=5, minimiser=2, buckets=97)


def test_odd_rows(odd):
    check(odd)


def test_no_rows(empty):
    assert rows_of(S.remove_repeated_windows(empty)) == []


def test_carried_columns(odd):
    got = S.remove_repeated_windows(odd, keep=["lang", "key", "text"])
    assert got.columns == ["doc_id", "lang", "key", "text", "kept_text", "n_words", "n_removed"]
    assert got.where("n_removed = 0 AND text IS NOT NULL AND kept_text = text").count() > 5


def test_hot_passage(spark):
    passage = " ".join(f"hot{i}" for i in range(60))
    df = spark.range(600).selectExpr("id AS doc_id", f"concat('own', id, ' ', '{passage}', if(id % 3 = 0, ' tail', concat(' end', id))) AS text").repartition(7)
    check(df)


def test_equal_hashes_are_settled_by_words():
    body = np.frombuffer(b"a b c d x y ", np.uint8)
    at = np.array([0, 4, 8])
    found = S._settle(np.array([0]), np.array([0, 0, 0]), np.array([1, 2, 3]), body, at, np.array([3, 3, 3]))
    assert found.tolist() == []
    found = S._settle(np.array([0]), np.array([0, 0]), np.array([1, 2]), np.frombuffer(b"a b a b ", np.uint8), np.array([0, 4]), np.array([3, 3]))
    assert found.tolist() == [1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=40), st.integers(1, 12))
def test_sliding_min(values, width):
    x = np.array(values)
    want = [x[i : i + width].min() for i in range(len(x) - width + 1)]
    if want:
        assert S.sliding_min(x, width).tolist() == want


def test_texts_that_lose_nothing_stay_as_they_are(spark, odd):
    source = sorted(((r.doc_id, r.text) for r in odd.collect()), key=str)
    got = S.remove_repeated_windows(odd, as_is=True).collect()
    assert sorted(((r.doc_id, r.kept_text) for r in got if not r.n_removed), key=str) == [x for x in source if x in {(r.doc_id, r.kept_text) for r in got}]
    assert sum(not r.n_removed for r in got) >= len(source) - 3 and any(r.kept_text is None for r in got)


def frequent_part(n):
    """Texts that share a 3-word part, the least hash among all parts, each with neighbours of its own but for every tenth."""
    words = [f"q{i}" for i in range(3000)]
    buf = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, _ = S.A.word_bounds(buf, np.array([0, len(buf)]))
    hashes = S.A.Rolling(S.A.word_hashes(buf, starts, ends)).hashes(np.arange(2998), np.arange(3, 3001))
    at = int(hashes.argmin())
    part = " ".join(words[at : at + 3])
    return [(i, " ".join([*(f"a{j}x{i - i % 10 // 9}" for j in range(12)), part, *(f"b{j}x{i - i % 10 // 9}" for j in range(12))])) for i in range(n)]


def test_windows_of_a_frequent_part_are_split(spark, monkeypatch):
    monkeypatch.setattr(S, "SPLIT_ABOVE", 500)
    monkeypatch.setattr(S, "COUNT_EVERY", 1)
    monkeypatch.setattr(S, "BUCKET_WINDOWS", 2000)
    rows = frequent_part(1500)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    texts = df.selectExpr("doc_id AS doc", "cast(hash(text) AS long) AS key", "text")
    buckets, hot, splits = S.layout(texts, 13, 3, 4)
    assert len(hot) >= 1 and splits.max() >= 20 and buckets >= 10
    shipped = texts.mapInArrow(S._ship(13, 3, 64, hot, splits), "bucket long, packed binary").where("bucket >= 0").collect()
    sizes = {}
    for bucket, blob in shipped:
        size = S._unpack(bytes(blob))[0][3]
        sizes[bucket] = sizes.get(bucket, 0) + int((size - 12).sum())
    assert max(sizes.values()) <= 0.1 * sum(sizes.values())
    check(df)
