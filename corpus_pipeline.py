"""The corpus pipeline: quality rules, toxicity, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's ``docs``. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldspot.llm import neardup, packing, quality, secrets, toxicity
from coldspot.llm.common import stored, table, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the quality rules keep. The model is trained on ``documents``
    and ``labels``."""
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.filtered(docs, model)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that are not predicted toxic."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.filtered(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the one of the smallest doc_id, of each group of near-duplicates;
    of rows that repeat a doc_id, one."""
    return neardup.deduplicated(docs)


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document; secrets in its text are masked and n_chars follows."""
    language, forest = secrets.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))
    masked = secrets.mask(docs, language, forest)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into windows."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("near_dedup", near_dedup),
    ("secrets", secret_masking),
    ("packing", packed),
]

# Trained models and the tokenizer cannot be written in SQL; the stages are tested against
# brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
