"""The registered queries of the operators, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playbeat.llm.components import kept
from playbeat.llm.document_fingerprints import fingerprints_with_next, near_fingerprints
from playbeat.llm.embedding_neardup import embedding_links
from playbeat.llm.language_id import learn_languages, predict_language
from playbeat.llm.license_scan import scan_licenses
from playbeat.llm.merkle import fold_proofs, merkle_proofs, row_digest
from playbeat.llm.mixing import mix_sources, word_count
from playbeat.llm.neighbour_graph import nearest_neighbours
from playbeat.llm.prefix_trie import conversation_trie
from playbeat.llm.quality import fit_quality, predict_quality
from playbeat.llm.sentencepiece_codec import decode_ids, encode_texts
from playbeat.llm.simhash_neardup import simhash_components
from playbeat.llm.substring_dedup import remove_repeated_windows
from playbeat.llm.token_counts import token_counts
from playbeat.llm.workers import send_code


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model(name: str = "piece_bpe_32k.model") -> bytes:
    """Content of a public tokenizer's model file, which goes to the tasks with their code."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op1_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_near, for ids divisible by 100: how many of all documents have a fingerprint within 3 bits, the own one included."""
    rows = kept(fingerprints_with_next(table(spark, sf_dir, "documents")))
    asked = F.col("doc_id") % 100 == 0
    near = near_fingerprints(rows.where(asked), rows, radius=3)
    joined = rows.where(asked).join(near, "fingerprint", "left").select(*rows.columns, "n_near")
    return joined.unionAll(rows.where(F.coalesce(~asked, F.lit(True))).select(*rows.columns, F.lit(None).cast("long").alias("n_near")))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out.alias("held_out"))
    filters = learn_languages(docs.where("NOT held_out"))
    found = predict_language(docs, filters)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), piece_model())


def op6_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash_components(table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeated_windows(table(spark, sf_dir, "documents"), window=13)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """spans_hash stands for the source bytes of every piece."""
    model = piece_model()
    rows = encode_texts(table(spark, sf_dir, "documents"), model, keep=["doc_id"], spans=True)
    rows = decode_ids(rows.select("doc_id", "ids", F.xxhash64("begins", "ends").alias("spans_hash")), model)
    return rows.select(
        "doc_id",
        "spans_hash",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def mix_path() -> dict[str, Column]:
    """A tree of domain, language and source: sources belong to one of three domains by their number."""
    domain = "concat('d', coalesce(try_cast(regexp_extract(source, '[0-9]+', 0) AS int), 0) % 3)"
    return {"domain": F.expr(domain), "lang": F.col("lang"), "source": F.col("source")}


MIX_WEIGHTS = {"domain": {"d0": 50, "d1": 30, "d2": 20}, "lang": {"en": 30, "de": 15, "fr": 15, "es": 40}}


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """60 % of all words at the target weights, at most two epochs of any leaf."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", word_count(F.col("text")).alias("n_tokens"))
    mixed = mix_sources(docs, mix_path(), MIX_WEIGHTS, share=0.6, most_epochs=2, seed=17, tokens=F.col("n_tokens"))
    return mixed.select("doc_id", "epoch", "lang", "source", "n_tokens")


def graded(labels: DataFrame) -> DataFrame:
    """Grades from the labels: 0 toxic, 1 poor, 2 good."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade"))


def judged(docs: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    """Expected grade and tails of all documents, from a model of the rated ones, and whether grade 2 is the likelier side."""
    model = fit_quality(docs, graded(labels))
    top = F.element_at("tails", -1)
    return predict_quality(docs, model, keep=keep).withColumn("accepted", top >= 0.5)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])
    return rows.select("doc_id", "expected_grade", F.element_at("tails", -1).alias("p_good"), "accepted")


MANIFEST = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, folded from a leaf whose n_chars is one too large where 7 divides the id's CRC."""
    docs = table(spark, sf_dir, "documents")
    changed = row_digest([F.expr("try_add(n_chars, 1)") if c == "n_chars" else c for c in MANIFEST])
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, changed).alias("tampered")
    proofs = merkle_proofs(docs.select("doc_id", "lang", row_digest(MANIFEST).alias("leaf"), tampered), keep=["doc_id", "tampered"])
    folded = fold_proofs(proofs.withColumn("shown", F.coalesce("tampered", "leaf")), leaf="shown")
    return folded.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nearest_neighbours(rows, rows.where("vec_id % 20 = 0"), k=20)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each rebuilt upon the first turns of the first one of its twenty."""
    turns = table(spark, sf_dir, "conversations")
    head = F.crc32(F.col("conv").cast("string")) % 4
    return conversation_trie(turns, base=F.col("conv") - F.col("conv") % 20, head=head, most=3)


def _sent(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        send_code(spark)
        return fn(spark, sf_dir)

    return run


QUERIES = {
    name: _sent(fn)
    for name, fn in {
        "op1_embedding_neardup": op1_embedding_neardup,
        "op2_document_fingerprints": op2_document_fingerprints,
        "op3_license_scan": op3_license_scan,
        "op4_language_id": op4_language_id,
        "op5_token_counts": op5_token_counts,
        "op6_simhash_neardup": op6_simhash_neardup,
        "op7_substring_dedup": op7_substring_dedup,
        "op8_sentencepiece": op8_sentencepiece,
        "op9_source_mixing": op9_source_mixing,
        "op10_quality_classifier": op10_quality_classifier,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_nearest_neighbours": op12_nearest_neighbours,
        "op13_conversation_trie": op13_conversation_trie,
    }.items()
}


def _crc32(column: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of a whole number's decimal digits."""
    digits = f"list_transform(string_split(CAST({column} AS VARCHAR), ''), lambda ch: ascii(ch)::BIGINT)"
    bits = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), lambda c, b: {bits}), 4294967295::BIGINT)"


def _fields(*columns: str) -> str:
    """DuckDB SQL for the digest of a manifest leaf."""
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns) + ")"


SQL = {
    "op11_merkle_manifest": f"""
WITH RECURSIVE d AS (SELECT doc_id, lang, {_fields(*MANIFEST)} AS leaf,
    {_fields("doc_id", "source", "lang", "(n_chars + 1)", "text")} AS changed, {_crc32("doc_id")} AS crc FROM documents),
gr AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, count(*) AS n FROM d GROUP BY lang),
a AS (SELECT d.*, gr.g, gr.n, row_number() OVER (PARTITION BY gr.g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p
      FROM d JOIN gr ON d.lang IS NOT DISTINCT FROM gr.lang),
t AS (SELECT g, 0 AS l, p, n, leaf AS h FROM a UNION ALL
      SELECT g, l + 1, p // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY p)) FROM t WHERE n > 1 GROUP BY g, l, p // 2, n),
s AS (SELECT g, h AS subroot, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS l, g AS p, n, subroot AS h FROM s UNION ALL
      SELECT l + 1, p // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY p)) FROM u WHERE n > 1 GROUP BY l, p // 2, n),
steps AS (SELECT a.g, a.p, v.l AS o, (a.p >> v.l) & 1 AS odd, b.h AS sib
          FROM a JOIN (SELECT DISTINCT g, l FROM t WHERE n > 1) v USING (g)
          LEFT JOIN t b ON b.g = a.g AND b.l = v.l AND b.p = xor(a.p >> v.l, 1)
          UNION ALL
          SELECT a.g, a.p, 100 + v.l, (a.g >> v.l) & 1, b.h FROM a JOIN (SELECT DISTINCT l FROM u WHERE n > 1) v ON TRUE
          LEFT JOIN u b ON b.l = v.l AND b.p = xor(a.g >> v.l, 1)),
w AS (SELECT g, p, list(CASE WHEN sib IS NULL THEN '-' WHEN odd = 1 THEN '<' || sib ELSE '>' || sib END ORDER BY o) AS steps,
             coalesce(string_agg(sib, '' ORDER BY o), '') AS siblings FROM steps GROUP BY g, p),
f AS (SELECT a.doc_id, a.leaf, s.subroot, (SELECT h FROM u WHERE n = 1) AS root, sha256(coalesce(w.siblings, '')) AS proof_sha256,
             list_reduce(list_prepend(CASE WHEN a.crc % 7 = 0 THEN a.changed ELSE a.leaf END, coalesce(w.steps, [])), lambda x, y:
                 CASE y[1] WHEN '-' THEN sha256(x) WHEN '<' THEN sha256(y[2:] || x) ELSE sha256(x || y[2:]) END) AS folded_root
      FROM a JOIN s USING (g) LEFT JOIN w ON a.g = w.g AND a.p = w.p)
SELECT *, folded_root = root AS verified FROM f
""",
    "op13_conversation_trie": rf"""
WITH r AS (SELECT conv_id, turn, md5(strlen(role) || ':' || role || text) AS k, CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT) AS w
           FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS i FROM r),
c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base, {_crc32("conv_id")} % 4 AS h FROM t),
b AS (SELECT c.conv_id, t.i AS pos, t.k, t.w FROM c JOIN t ON t.conv_id = c.base AND t.i <= c.h),
m AS (SELECT c.conv_id, c.h, count(b.pos) AS m FROM c LEFT JOIN b USING (conv_id) GROUP BY c.conv_id, c.h),
s AS (SELECT * FROM b UNION ALL SELECT t.conv_id, t.i - m.h + m.m, t.k, t.w FROM t JOIN m USING (conv_id) WHERE t.i > m.h),
l AS (SELECT conv_id, list(k ORDER BY pos) AS k, list(w ORDER BY pos) AS w FROM s GROUP BY conv_id),
q AS (SELECT c.conv_id, coalesce(l.k, []) AS k, l.w FROM c LEFT JOIN l USING (conv_id)),
p AS (SELECT q.conv_id, d, k[1:d] AS pre, CASE WHEN d = 0 THEN 0 ELSE w[d] END AS w, len(k) = d AS ends FROM q, unnest(range(0, len(k) + 1)) AS u(d)),
n AS (SELECT d, pre, min(conv_id) AS conv_id, count(*) AS n, max(w) AS w,
             coalesce(string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ids FROM p GROUP BY d, pre),
f AS (SELECT d - 1 AS d, pre[1:d - 1] AS pre, count(*) AS f FROM n WHERE d > 0 GROUP BY ALL),
o AS (SELECT n.*, coalesce(f.f, 0) AS f FROM n LEFT JOIN f ON n.d = f.d AND n.pre = f.pre),
a AS (SELECT u.a AS d, o.pre[1:u.a] AS pre, sum(CASE WHEN o.f = 0 THEN 1 ELSE 0 END) AS leaves, sum((o.n - 1) * o.w) AS saved
      FROM o, unnest(range(0, o.d + 1)) AS u(a) GROUP BY ALL)
SELECT o.conv_id, CAST(o.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, o.n AS n_convs, CAST(o.f AS BIGINT) AS n_children,
       CAST(a.leaves AS BIGINT) AS n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens, sha256(o.ids) AS ends_sha256
FROM o JOIN a ON o.d = a.d AND o.pre = a.pre LEFT JOIN n up ON up.d = o.d - 1 AND up.pre = o.pre[1:o.d - 1]
""",
    "op7_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
      FROM d, unnest(range(1, len(w) - 11)) AS u(i) WHERE len(w) >= 13),
m AS (SELECT g, min(doc_id) AS least FROM g GROUP BY g),
gone AS (SELECT DISTINCT g.doc_id, u.p FROM g JOIN m USING (g), unnest(range(g.i, g.i + 13)) AS u(p)
         WHERE g.doc_id > m.least),
p AS (SELECT d.doc_id, u.p, d.w[u.p] AS w FROM d, unnest(range(1, len(d.w) + 1)) AS u(p)),
s AS (SELECT p.doc_id, count(gone.p) AS n_removed,
             string_agg(p.w, ' ' ORDER BY p.p) FILTER (WHERE gone.p IS NULL) AS kept
      FROM p LEFT JOIN gone ON p.doc_id = gone.doc_id AND p.p = gone.p GROUP BY p.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(s.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(s.kept, '')) AS kept_sha256
FROM d LEFT JOIN s ON d.doc_id = s.doc_id
""",
    "op9_source_mixing": r"""
WITH d AS (SELECT doc_id, lang, source, coalesce(lang, '') AS l, coalesce(source, '') AS s,
                  'd' || (coalesce(TRY_CAST(regexp_extract(source, '[0-9]+') AS INT), 0) % 3) AS m,
                  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n FROM documents),
leaf AS (SELECT m, l, s, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n) * 2 AS DOUBLE) AS room FROM d GROUP BY m, l, s),
m0 AS (SELECT m, sum(room) AS room,
              CASE m WHEN 'd0' THEN 50.0::DOUBLE WHEN 'd1' THEN 30.0::DOUBLE WHEN 'd2' THEN 20.0::DOUBLE ELSE 1.0::DOUBLE END AS w
       FROM leaf GROUP BY m HAVING sum(room) > 0),
m1 AS (SELECT *, ((SELECT floor(CAST(sum(n) AS DOUBLE) * 0.6::DOUBLE) FROM d)
                  - coalesce(sum(room) OVER (ORDER BY room / w, m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / sum(w) OVER (ORDER BY room / w, m ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM m0),
m2 AS (SELECT m, CASE WHEN room <= lev * w THEN room
                 ELSE greatest(max(lev) FILTER (WHERE NOT room <= lev * w) OVER () * w, 0) END AS b FROM m1),
l0 AS (SELECT m, l, sum(room) AS room, any_value(b) AS b,
              CASE l WHEN 'en' THEN 30.0::DOUBLE WHEN 'de' THEN 15.0::DOUBLE WHEN 'fr' THEN 15.0::DOUBLE
                     WHEN 'es' THEN 40.0::DOUBLE ELSE 1.0::DOUBLE END AS w
       FROM leaf JOIN m2 USING (m) GROUP BY m, l HAVING sum(room) > 0),
l1 AS (SELECT *, (b - coalesce(sum(room) OVER (PARTITION BY m ORDER BY room / w, l ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / sum(w) OVER (PARTITION BY m ORDER BY room / w, l ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM l0),
l2 AS (SELECT m, l, CASE WHEN room <= lev * w THEN room
                    ELSE greatest(max(lev) FILTER (WHERE NOT room <= lev * w) OVER (PARTITION BY m) * w, 0) END AS b FROM l1),
s0 AS (SELECT m, l, s, n, room, b, 1.0::DOUBLE AS w FROM leaf JOIN l2 USING (m, l) WHERE room > 0),
s1 AS (SELECT *, (b - coalesce(sum(room) OVER (PARTITION BY m, l ORDER BY room / w, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / sum(w) OVER (PARTITION BY m, l ORDER BY room / w, s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM s0),
s2 AS (SELECT m, l, s, n AS a, CAST(floor(CASE WHEN room <= lev * w THEN room
          ELSE greatest(max(lev) FILTER (WHERE NOT room <= lev * w) OVER (PARTITION BY m, l) * w, 0) END) AS BIGINT) AS b FROM s1),
k AS (SELECT d.*, b // a AS whole, b % a AS rest, md5(concat_ws('|', '17', CAST(b // a AS VARCHAR), CAST(doc_id AS VARCHAR))) AS key
      FROM d JOIN s2 USING (m, l, s) WHERE b > 0),
c AS (SELECT *, sum(n) OVER (PARTITION BY m, l, s ORDER BY key) AS upto FROM k),
t AS (SELECT *, whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS times FROM c)
SELECT doc_id, CAST(u.e AS BIGINT) AS epoch, lang, source, n AS n_tokens FROM t, unnest(range(0, times)) AS u(e)
""",
}
