"""Corpus pipeline: quality rules, n-gram Jaccard join, benchmark
decontamination, redaction of personal data, best-fit packing.

Each stage takes (spark, docs, sf_dir); ``docs`` is what its predecessor kept.
All but the last return the columns of documents. SQL cannot express the
stages, so ``ORACLE_SQL`` is None; tests hold them against brute force.

No documents, or none left, give no rows in any stage. Columns beside those of
documents pass through all stages but the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomelab.llm import decontam, jaccard, packing, pii, quality
from outcomelab.llm.common import stored

ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject. NULL, empty and short
    texts fail the base rule and go; without labels only the base rules drop."""
    model = quality.fit(spark, docs, _table(spark, sf_dir, "labels"))
    return docs.where(quality.verdict(model, F.col("text")))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, that with the smallest
    id. Texts without words are no copies of each other; rows that repeat an id
    and its text stay once."""
    return jaccard.one_per_group(spark, docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item. NULL and empty texts hold
    none; without items every document stays."""
    return docs.where(decontam.clean(spark, F.col("text"), _table(spark, sf_dir, "benchmark")))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts; ``n_chars`` follows the new text.
    NULL and empty texts stay as they are (``n_chars`` of a NULL text is NULL)."""
    model = pii.fit(spark, docs)
    return docs.withColumn("text", pii.redacted(spark, F.col("text"), model)).withColumn(
        "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents, packed into sequences. A NULL or empty text
    is one piece, its end token; rows that repeat are packed each."""
    return packing.pack(spark, docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", redact_pii),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
