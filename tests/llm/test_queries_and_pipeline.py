"""The registered queries on whole tables, and the pipeline against the same stages in plain Python."""

import hashlib

import corpus_pipeline
import numpy as np
import pytest
from compare import connect, difference
from test_simhash_neardup import grouped, one
from test_substring_dedup import brute

from __spark_entry__ import oracle_sql, queries
from playbeat.llm import arrays as A
from playbeat.llm.queries import QUERIES, SQL, piece_model
from playbeat.llm.sentencepiece_codec import Codec

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    assert difference(queries()[name](spark, SF), connect(SF), SQL[name]) is None


def test_operators_and_the_pipeline_are_registered():
    assert [f"op{n}_" for n in range(1, len(QUERIES) + 1)] == sorted({q.split("_")[0] + "_" for q in QUERIES}, key=lambda q: int(q[2:-1]))
    assert {*QUERIES, "pipeline"} <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", ["op2_document_fingerprints", "op4_language_id", "op5_token_counts", "op6_simhash_neardup", "op8_sentencepiece", "op10_quality_classifier"])
def test_one_row_per_document(spark, documents, name):
    got = queries()[name](spark, SF)
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == sorted(r.doc_id for r in documents.select("doc_id").collect())


def test_digests_of_ids(spark, documents):
    own = Codec(piece_model())
    texts = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    for r in queries()["op8_sentencepiece"](spark, SF).collect():
        ids = own.encode(texts[r.doc_id].encode()).tolist()
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())


def test_near_counts_of_asked_ids(spark):
    got = queries()["op2_document_fingerprints"](spark, SF).collect()
    bits = [int(r.fingerprint, 16) for r in got]
    for r in got:
        asked = r.doc_id % 100 == 0
        assert r.n_near == (sum((int(r.fingerprint, 16) ^ b).bit_count() <= 3 for b in bits) if asked else None)


def test_pipeline_stages(spark, documents, tmp_path):
    assert len(corpus_pipeline.STAGES) == 5
    docs, seen = documents, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        seen.append([r.asDict() for r in docs.collect()])
        if i < 4:
            assert docs.columns == documents.columns
    good, single, cut, mixed, encoded = seen
    ids = lambda rows: {r["doc_id"] for r in rows}
    # near duplicates: the first of each group
    groups = grouped([(r["doc_id"], one(r["text"])) for r in good], 3)
    assert ids(single) == {i for i, g in groups.items() if i == g}
    # repeated passages: of what the stage before kept
    want = {d: (kept, gone) for d, kept, _, gone in brute([(r["doc_id"], r["text"]) for r in single])}
    source = {r["doc_id"]: r for r in single}
    for r in cut:
        kept, gone = want[r["doc_id"]]
        assert r["text"] == (kept if gone else source[r["doc_id"]]["text"]) and (gone or r == source[r["doc_id"]])
    assert ids(cut) == {d for d, (kept, _) in want.items() if kept or not source[d]["text"].split()}
    # mixing only chooses and repeats
    assert all(r in cut for r in mixed) and 0 < len(mixed)
    own = Codec(piece_model())
    assert sorted((r["doc_id"], tuple(r["ids"])) for r in encoded) == sorted((r["doc_id"], tuple(own.encode(r["text"].encode()).tolist())) for r in mixed)


def test_pipeline_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_stages_of_odd_and_no_rows(spark, odd, empty, tmp_path):
    """Every stage takes documents with nulls, repeats and long texts, and a table without rows."""
    for df in (odd, empty):
        docs = df.select("doc_id", "text", "lang", "source", "n_chars")
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, SF).count() <= 2 * docs.count()


def test_words_and_hashes():
    texts = [b" a  bb\tc", b"", b"c", b"\n", "é x".encode()]
    buf, at = np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum([len(t) for t in texts]))
    starts, ends, first = A.word_bounds(buf, at)
    assert [buf[s:e].tobytes() for s, e in zip(starts, ends)] == [w for t in texts for w in t.split()]
    assert np.diff(first).tolist() == [len(t.split()) for t in texts]
    body, offsets = A.spaced_words(buf, starts, ends)
    assert body.tobytes() == b"".join(w + b" " for t in texts for w in t.split()) and offsets[-1] == len(body)
    hashes = A.word_hashes(buf, starts, ends, block=3)
    assert (hashes == A.word_hashes(buf, starts, ends)).all() and hashes[2] == hashes[3] and len(set(hashes.tolist())) == len(hashes) - 1


def test_repeated_ids_leave_one_row_of_each_text_of_a_group(spark):
    text = " ".join(f"w{i}" for i in range(40))
    other = " ".join(f"z{i}" for i in range(40))
    rows = [(1, text), (1, text), (1, text), (2, text), (3, other), (3, other + " more of it"), (None, text), (None, text)]
    docs = spark.createDataFrame([(i, t, "en", "s1", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, docs.repartition(3), SF).collect()
    assert sorted(r.doc_id or 0 for r in got) == [0, 0, 1, 3, 3]
    assert {r.text for r in got if r.doc_id == 3} == {other, other + " more of it"}
    assert all(r.n_chars == len(r.text) for r in got)
