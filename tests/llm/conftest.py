import pytest
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
DATA = "/root/testdata/sf0.01"

DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # extra columns whose names the operators use themselves
    T.StructField("score", T.StringType()), T.StructField("key", T.StringType()),
    T.StructField("kept", T.StringType()), T.StructField("_b", T.StringType()),
])

LONG = "lorem ipsum dolor sit amet " * 6000
ODD_TEXTS = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, "   \n\t ", None, None), (4, "word", "en", "b"),
    (5, "one two three four", "en", "b"), (6, LONG, "en", "b"), (7, LONG, "en", "b"),
    (8, "same text of six words here", "en", "b"), (8, "same text of six words here", "en", "b"),
    (None, "no id but text of seven words here", "en", None), (9, "x" * 50_000, None, "c"),
    (10, "naïve Straße 中文 😀   \x1c <|endoftext|>", "de", "c"), (11, "!!! ??? 123", "en", "c"),
]


def frame(spark, rows):
    return spark.createDataFrame(
        [(d, t, lang, s, None if t is None else len(t), "x", "y", "z", "w") for d, t, lang, s in rows], DOC_SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, ODD_TEXTS)


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")
