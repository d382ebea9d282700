"""Token counts, SentencePiece, language ID, quality and fingerprints against the libraries, brute force or held-out rows."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import rows_of
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer, models

from playbeat.llm import document_fingerprints as D
from playbeat.llm import language_id as L
from playbeat.llm import quality as Q
from playbeat.llm.pieces import CharacterMap, Memory, Pieces, Table
from playbeat.llm.queries import graded, piece_model
from playbeat.llm.sentencepiece_codec import Codec, decode_ids, encode_texts
from playbeat.llm.token_counts import Automaton, Viterbi, token_counts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return piece_model()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def strange_texts(n=400):
    rnd = random.Random(3)
    letters = "abcdeéàß漢😀 ▁\n\t.,01<>sth 　 \x00"
    out = ["", " ", "  ", "a", "▁", " ▁ a▁▁b", "<s> <0x41> <unk>", "a" * 200, " " * 50 + "x", "𝒳é漢字‍😀 ́x\t\n\r\n  x"]
    out += ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 80))) for _ in range(n)]
    return out + ["".join(rnd.choice("ab t") for _ in range(rnd.randint(0, 300))) for _ in range(100)]


def test_codec_equals_library(model, library, documents):
    own = Codec(model)
    texts = strange_texts() + [r.text for r in documents.select("text").collect()]
    ids = [own.encode(t.encode()) for t in texts]
    assert all(library.encode(t) == i.tolist() for t, i in zip(texts, ids))
    body, at = own.decode(np.concatenate(ids), np.append(0, np.cumsum([len(i) for i in ids])))
    assert all(library.decode(i.tolist()) == body[a:b].tobytes().decode() for i, a, b in zip(ids, at[:-1], at[1:]))


def test_spans_equal_library(model, library):
    own = Codec(model)
    for t in strange_texts():
        begins, ends = own.spans(t.encode(), own.encode(t.encode()))
        assert [(p.begin, p.end) for p in library.encode(t, return_type="proto").pieces] == list(zip(begins.tolist(), ends.tolist()))


def test_decoding_any_ids(model, library):
    own, rnd = Codec(model), random.Random(4)
    for _ in range(1500):
        ids = np.array([rnd.choice([0, 1, 2, *range(3, 259), 29871, 29900, 278, 262, 259]) for _ in range(rnd.randint(0, 12))], np.int32)
        body, _ = own.decode(ids, np.array([0, len(ids)]))
        assert library.decode(ids.tolist()) == body.tobytes().decode()


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf"])
def test_normaliser_takes_longest_prefixes(rule, model):
    """A public normaliser with a compiled map, put into the model: normal form and alignment as the library's."""
    spec = sentencepiece_model_pb2.NormalizerSpec()
    spec.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_normalizer_spec())
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    proto.normalizer_spec.CopyFrom(spec)
    changed = proto.SerializeToString()
    library, own = sentencepiece.SentencePieceProcessor(model_proto=changed), Codec(changed)
    assert own.pieces.map.units
    for t in [*strange_texts(150), "ﬁ  Ⅷ ｱ ", "  ", "①②ガギ  ﷺ　x", "Ａ​B­C"]:
        ids = own.encode(t.encode())
        assert library.encode(t) == ids.tolist(), t
        begins, ends = own.spans(t.encode(), ids)
        assert [(p.begin, p.end) for p in library.encode(t, return_type="proto").pieces] == list(zip(begins.tolist(), ends.tolist())), t


def test_encoding_rows(spark, odd, empty, model, library):
    assert encode_texts(empty, model).count() == 0
    rows = decode_ids(encode_texts(odd, model, spans=True), model).select("doc_id", "lang", "ids", "begins", "ends", "decoded").collect()
    source = odd.select("doc_id", "text").collect()
    want = sorted(((r.doc_id, library.encode(r.text or ""), library.decode(library.encode(r.text or ""))) for r in source), key=str)
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in rows), key=str) == want
    assert all(len(r.ids) == len(r.begins) == len(r.ends) for r in rows)
    null = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.decoded for r in decode_ids(null, model).collect()] == ["", ""]


def test_character_map_without_entries():
    assert CharacterMap(b"").longest(b"abc", 0) == (0, b"")


def unigram(model):
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    return proto


def test_token_counts_equal_two_libraries(model, documents):
    proto = unigram(model)
    vocabulary = [("<unk>", 0.0)] + [(f"<0x{i:02X}>", 0.0) for i in range(256)] + [(p.piece, p.score) for p in proto.pieces if p.type == 1]
    other, own = Tokenizer(models.Unigram(vocabulary, 0, True)), Viterbi(model)
    texts = [t for t in strange_texts() if t] + [r.text for r in documents.select("text").collect()]
    for t in texts:
        assert len(other.encode("▁" + t.replace(" ", "▁")).ids) == own.total(t.encode())[1]
    proto.trainer_spec.model_type = 1
    for p in proto.pieces:
        if p.type == 1:
            p.score = max(p.score, -31900) / 1024  # sums stay exact in the library's single precision
    library, own = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString()), Viterbi(proto.SerializeToString())
    for t in (t for t in texts if len(t) < 1000):
        assert len(library.encode(t)) == own.total(t.encode())[1]


def test_token_count_rows(odd, empty, model):
    assert token_counts(empty, model).count() == 0
    own = Viterbi(model)
    got = rows_of(token_counts(odd, model))
    want = sorted(((r.doc_id, *reversed(own.total((r.text or "").encode()))) for r in odd.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
    assert got == want


def test_languages_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    filters = L.learn_languages(docs.where(~held))
    assert filters.langs == ["de", "en", "es", "fr"] and (filters.false < 0.01).all()
    found = L.predict_language(docs.where(held), filters).join(docs, "doc_id")
    assert found.where("lang = lang_pred").count() >= 0.98 * found.count()


def test_filters_contain_what_was_learned(spark):
    rows = [("aaa bbb", f"l{i:02d}") for i in range(70)] + [("zzzz yyyy", "z")]
    filters = L.learn_languages(spark.createDataFrame(rows, "text string, lang string"))
    assert len(filters.langs) == 71 and filters.slots.shape[1] == 2
    marks, at = L.grams(np.frombuffer(b"aaa", np.uint8), np.array([0, 3]))
    votes = filters.votes(marks, at)[0]
    assert (votes[:70] == 1).all() and votes[70] < 0.1


def test_language_edge_rows(spark, odd, empty, documents):
    filters = L.learn_languages(documents)
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.predict_language(odd, filters).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[12][0] != "und" and None in got
    assert L.predict_language(odd, filters).count() == odd.count() and L.predict_language(empty, filters).count() == 0
    digits = spark.createDataFrame([(1, "123 !?"), (2, "漢字"), (3, "éé")], "doc_id long, text string")
    assert [r.lang_pred == "und" for r in L.predict_language(digits, filters).orderBy("doc_id").collect()] == [True, False, False]
    nothing = L.learn_languages(empty)
    assert {r.lang_pred for r in L.predict_language(odd, nothing).collect()} == {"und"}


def test_quality_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = Q.fit_quality(docs, graded(labels).where(~held), sample=4096)
    assert (np.diff(model.thresholds) > 0).all()
    found = Q.predict_quality(docs.where(held), model).join(graded(labels), "doc_id").withColumn("top", F.element_at("tails", -1))
    share = {r.grade: r.kept for r in found.groupBy("grade").agg(F.avg((F.col("top") >= 0.5).cast("int")).alias("kept")).collect()}
    assert share[2] >= 0.97 and share[1] <= 0.15 and share[0] <= 0.1
    mean = {r.grade: r.e for r in found.groupBy("grade").agg(F.avg("expected_grade").alias("e")).collect()}
    assert mean[0] < mean[1] < mean[2]


def test_quality_edge_rows(spark, odd, empty):
    ratings = spark.createDataFrame([(4, 2), (5, 2), (9, 0), (None, 1), (3, None), (1, 1), (99, 0)], "doc_id long, grade int")
    model = Q.fit_quality(odd, ratings)
    got = Q.predict_quality(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= t <= 1 for r in got for t in r.tails) and all(len(r.tails) == 2 for r in got)
    assert {c for c in odd.columns} <= set(got[0].asDict())
    assert Q.predict_quality(empty, model).count() == 0
    nothing = Q.fit_quality(odd, ratings.limit(0))
    assert {r.tails[-1] >= 0.5 for r in Q.predict_quality(odd, nothing).collect()} == {True}


def test_ordinal_fit_finds_the_order():
    rng = np.random.default_rng(1)
    grade = rng.integers(0, 4, 600)
    text, feature = np.arange(600).repeat(2), np.column_stack([grade, np.full(600, 9)]).ravel()
    model = Q.fit(text, feature, np.ones(1200), grade, least=3)
    assert (np.diff(model.weights[:4]) > 0).all() and (np.diff(model.thresholds) > 0).all()


def edited(rows):
    rows = sorted(((d if d is not None else -(1 << 63), t or "") for d, t in rows), key=lambda r: (r[0], r[1].encode()))
    out = []
    for (d, a), (_, b) in zip(rows, rows[1:] + rows[:1]):
        e = a[: len(a) - len(a) // 4] + b[: len(a) // 4]
        prints = [D.prints([x.encode()]) for x in (a, e, b)]
        out.append((None if d == -(1 << 63) else d, len(a), hashlib.sha256(e.encode()).hexdigest(), prints[0].tobytes().hex(), prints[1].tobytes().hex(),
                    float(D.likeness(prints[0], prints[1])[0]), float(D.likeness(prints[0], prints[2])[0])))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_fingerprints_beside_the_next(request, table):
    df = request.getfixturevalue(table)
    want = edited([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    assert rows_of(D.fingerprints_with_next(df.repartition(5))) == want


def test_fingerprints_of_few_rows(spark, empty):
    assert rows_of(D.fingerprints_with_next(empty)) == []
    one = spark.createDataFrame([(7, "a b c d")], "doc_id long, text string")
    assert rows_of(D.fingerprints_with_next(one)) == edited([(7, "a b c d")])


def test_simhash_is_the_weighted_vote():
    text = b"alpha beta gamma alpha beta"
    whole = D.simhash(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert (whole == D.prints([text, b"", b"x"])[0]).all() and not D.prints([b""]).any() and D.prints([b"x"]).any()
    edited_text = D.prints([b" ".join(b"word%d" % i for i in range(400)), b" ".join(b"word%d" % i for i in range(40, 400))])
    assert D.likeness(edited_text[:1], edited_text[1:])[0] > 0.8


def test_block_tables_find_all_within_the_radius(spark, documents):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 256, (30, D.BITS // 8), dtype=np.uint8)
    near = base.repeat(10, 0)
    for row in near:
        for bit in rng.choice(D.BITS, rng.integers(0, 7), False):
            row[bit // 8] ^= 1 << (bit % 8)
    hexes = [r.tobytes().hex() for r in np.concatenate([base, near, near[:5]])]
    df = spark.createDataFrame([(h,) for h in hexes] + [(None,)], "fingerprint string")
    got = {r.fingerprint: r.n_near for r in D.near_fingerprints(df, df, 3).collect()}
    bits = [int(h, 16) for h in hexes]
    assert got == {h: sum((int(h, 16) ^ b).bit_count() <= 3 for b in bits) for h in set(hexes)}
    added = D.fingerprint_texts(documents).select("text", "fingerprint").collect()
    assert all(r.fingerprint == D.prints([r.text.encode()]).tobytes().hex() for r in added[:20])


def test_pieces_refuse_models_they_cannot_treat(model):
    proto = unigram(model)
    proto.pieces[300].type = 4
    with pytest.raises(ValueError):
        Pieces(proto.SerializeToString())


def test_repeated_ids_do_not_fill_the_sample(spark, monkeypatch):
    from playbeat.llm import quality

    seen = []
    monkeypatch.setattr(quality, "fit", lambda owner, feature, value, grades, **more: seen.append(grades.tolist()))
    ratings = spark.createDataFrame([(1, 0)] * 50 + [(2, 1), (3, 2)], "doc_id long, grade int")
    docs = spark.createDataFrame([(1, f"poor text number {i}") for i in range(40)] + [(2, "fair text"), (3, "good text")], "doc_id long, text string")
    quality.fit_quality(docs.repartition(4), ratings, sample=3)
    assert sorted(seen[0]) == [0, 1, 2]


def test_memory_is_bounded_and_keeps_what_is_met_again():
    worked = []
    seen = Memory(lambda parts: worked.extend(parts) or [p.upper() for p in parts], most=4, longest=3)
    for part in ("ab", "cd", "ef", "gh", "ij", "kl"):
        assert seen.all(["a", part, part, "long one"]) == ["A", part.upper(), part.upper(), "LONG ONE"]
    assert worked.count("a") == 1 and worked.count("long one") == 6
    assert len(seen.new) <= 7 and len(seen.old) <= 7


def test_many_parts_side_by_side_equal_each_alone(model):
    """Merges and paths of many stretches at once, with odd characters, are those of each stretch by itself."""
    r = random.Random(6)
    letters = "▁▁eeennnaatrsidl" + "éü漢😀\x00"
    units = ["".join(r.choice(letters) for _ in range(r.randint(1, 30))) for _ in range(2000)]
    own, path = Codec(model), Viterbi(model)
    ids, begin = own.merge_all(units)
    scores, counts = path.best_all(units)
    for i, u in enumerate(units[:300]):
        assert ids[begin[i] : begin[i + 1]].tolist() == own.merge(u)
        score, count = path.best_all([u])
        assert (scores[i], counts[i]) == (score[0], count[0])


def test_automaton_steps_many_texts_at_once():
    r = random.Random(5)
    pieces = list(dict.fromkeys("".join(r.choice("abcé") for _ in range(r.randint(1, 5))) for _ in range(60)))
    found, texts = Automaton(pieces), ["".join(r.choice("abcé?") for _ in range(20)) for _ in range(50)]
    state = np.zeros(len(texts), np.int64)
    for k in range(20):
        state = found.step(state, found.number[[ord(t[k]) for t in texts]])
        for t, at in zip(texts, found.matched[state].tolist()):
            ends = []
            while at:
                ends.append(pieces[found.piece[at]])
                assert found.size[at] == len(ends[-1])
                at = found.shorter[at]
            assert ends == sorted((p for p in pieces if t[: k + 1].endswith(p)), key=len, reverse=True)


def test_memory_works_repeated_parts_once():
    calls = []
    memory = Memory(lambda parts: calls.append(parts) or [p.upper() for p in parts], most=2, longest=3)
    assert memory.all(["a", "bb", "a", "long", "a", "long"]) == ["A", "BB", "A", "LONG", "A", "LONG"]
    assert memory.all(["c", "a", "c"]) == ["C", "A", "C"] and memory.all([]) == []
    assert calls == [["a", "bb", "long"], ["c"]] and "long" not in {*memory.new, *memory.old}


def test_table_finds_its_keys_and_no_others():
    r = np.random.default_rng(4)
    keys = np.unique(r.integers(0, 1 << 40, 3000))
    table = Table(keys[::2], np.arange(len(keys[::2])), -7)
    assert table.get(keys[::2]).tolist() == list(range(len(keys[::2]))) and set(table.get(keys[1::2])) == {-7}
    assert Table(keys[:0], keys[:0], -7).get(keys[:3]).tolist() == [-7] * 3


def test_spans_of_many_texts_are_those_of_each(model):
    own = Codec(model)
    texts = [t.encode() for t in ["", "a b", "\U0001F9FFx\u4e00", " ", "\u2581a  b", "\U0001F9FF", "end"]] + [b"\xff \xfe"]
    ids, offsets = own.encode_all(texts)
    begins, ends = own.spans_all(texts, ids, offsets)
    for t, lo, hi in zip(texts, offsets[:-1], offsets[1:]):
        b, e = own.spans(t, ids[lo:hi])
        assert begins[lo:hi].tolist() == b.tolist() and ends[lo:hi].tolist() == e.tolist()
