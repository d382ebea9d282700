import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
#: Names that the operators use inside; tables may have them too.
CLASHING = ["fp", "key", "bucket", "node", "component", "ids", "epoch", "hash", "w", "at", "doc", "mark", "spans", "n", "score", "tails", "order", "id", "tokens"]


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    from playbeat.llm.workers import send_code

    send_code(spark)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def clashing(df):
    for name in CLASHING:
        df = df.withColumn(name, F.lit("x"))
    return df


@pytest.fixture(scope="session")
def odd(spark):
    """Null and empty texts, blanks, a missing id, repeated rows and ids, ties, a very long text, names used inside."""
    long_text = " ".join(f"w{i % 977} v{i % 31}" for i in range(60_000))
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [
        (1, None, "en", "src1", None), (2, "", "en", "src1", 0), (3, " \t\n ", None, None, 4), (None, "no id here at all", "de", "src2", 17),
        (4, "same text twice over", "en", "src1", 20), (5, "same text twice over", "en", "src1", 20), (5, "same text twice over", "en", "src1", 20),
        (6, long_text, "en", "src3", len(long_text)), (7, long_text + " end", "en", "src3", len(long_text) + 4), (6, "another text of id six", "fr", "src9", 22),
        (8, "a" * 300_000, "xx", "src1", 300_000), (9, passage, "en", "src4", 1), (10, "before " + passage + " after", "en", "src4", 1),
        (11, "MIT License mit license", "en", "src5", 1), (12, "émile Ünï 漢字 😀 ▁x\x00y", "fr", "src6", 1), (13, "one", "en", "src7", 3), (-5, "negative id", "es", "odd", 11),
    ]
    return clashing(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))


@pytest.fixture(scope="session")
def empty(spark):
    return clashing(spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long"))
