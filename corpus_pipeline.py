"""The corpus pipeline: five stages, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of documents;
`run` writes each stage's rows as Parquet in the shared checkpoint folder and reads them back for the next.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playbeat.llm.components import ensure_checkpoint_dir
from playbeat.llm.mixing import mix_sources
from playbeat.llm.queries import MIX_WEIGHTS, judged, mix_path, piece_model, table
from playbeat.llm.sentencepiece_codec import encode_texts
from playbeat.llm.simhash_neardup import simhash_components
from playbeat.llm.substring_dedup import remove_repeated_windows
from playbeat.llm.workers import send_code

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good; it learns from the rated ones among them."""
    send_code(spark)
    return judged(docs, table(spark, sf_dir, "labels"), COLUMNS).where("accepted").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the rows of its smallest id.

    Rows with one id and one text are one document, of which one row stays; an id with different texts keeps one row of
    each. Rows without an id are not compared, not even with equal texts, and all stay.
    """
    send_code(spark)
    groups = simhash_components(docs, shingle=3, distance=3)
    stay = groups.where("doc_id = component_id").select("doc_id").distinct()
    mark = F.xxhash64("text").alias("mark")
    named = docs.where("doc_id IS NOT NULL")
    # the ids meet the narrow rows; texts travel once, by id and mark, after equal ones of a task have become one
    stay = named.select("doc_id", mark).distinct().join(stay, "doc_id", "left_semi")
    single = named.groupBy("doc_id", mark).agg(F.min(F.struct(*COLUMNS[1:])).alias("row"))
    single = single.join(stay, ["doc_id", "mark"], "left_semi").select("doc_id", *(F.col(f"row.{c}") for c in COLUMNS[1:]))
    return single.select(*COLUMNS).unionByName(docs.where("doc_id IS NULL").select(*COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 13-word windows that an earlier one has; where nothing goes the text stays as it is.

    A document that had words and has none left goes.
    """
    send_code(spark)
    cut = remove_repeated_windows(docs, window=13, keep=["lang", "source", "n_chars"], as_is=True)
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    left = cut.where("n_removed < n_words OR n_words = 0")
    return left.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", n_chars.alias("n_chars"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many words as there are, at the target weights; leaves that are short come a second time."""
    send_code(spark)
    return mix_sources(docs, mix_path(), MIX_WEIGHTS, share=1.0, most_epochs=2, seed=17).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document's text, and the source bytes of each."""
    send_code(spark)
    rows = encode_texts(docs, piece_model(), keep=["doc_id", "lang", "source"], spans=True)
    return rows.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "begins", "ends")


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing sources to target weights", mixture),
    ("SentencePiece encoding", encoded),
]

#: SQL has no counterpart for the fitted classifier, the fingerprints and the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the documents table."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4()}"
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        out = f"{folder}/{i}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
