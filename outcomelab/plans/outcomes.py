"""The labelled rows of the model keys: ``labels`` joined to ``documents``.

One row per labelled document. The ordered class is the label pair (quality x
toxic); the numbers are counts and shares of the text in Spark expressions, the
category is the source. Documents are read once, texts do not leave their task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The ordered classes: quality 1 or 0, toxic 0 or 1.
CLASSES = ("good", "good toxic", "poor", "poor toxic")
NUMERIC = ("log_chars", "log_words", "chars_per_word", "distinct_share", "capital_share", "digit_share",
           "symbol_share", "exclaim_share", "stop_share", "vowel_share", "log_lines")
CATEGORICAL = "source"
TARGET = "outcome"
WORD = r"[^\x20\x09-\x0D]+"
# Share of the id range, in percent: the split by order of arrival.
TRAIN_LAST, VAL, TEST_FIRST = 79, 80, 81


def _share(pattern: str, chars):
    return F.coalesce(F.regexp_count("text", F.lit(pattern)) / chars, F.lit(0.0))


def labelled_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(row_id, pct, lang, source, the numbers, outcome). ``pct`` is the place
    of doc_id in the range of ids, 0 to 99. A document with several label rows
    counts once, by its lowest quality and highest toxicity; NULL text is empty;
    label rows without id, quality or toxic are not used."""
    known = (labels.where("doc_id is not null and quality is not null and toxic is not null")
             .groupBy(F.col("doc_id").alias("row_id")).agg(F.min("quality").alias("q"), F.max("toxic").alias("t")))
    top = documents.agg(F.max("doc_id")).scalar()
    docs = documents.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    rows = known.join(docs, F.col("row_id") == F.col("doc_id"))
    chars = F.when(F.length("text") > 0, F.length("text"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    n = F.col("_n")
    shaped = rows.withColumn("_words", words).withColumn("_n", F.size("_words"))
    return shaped.select(
        "row_id", F.floor(F.col("row_id") * 100 / (top + 1)).cast("int").alias("pct"), "lang", "source",
        F.log1p(F.length("text")).alias("log_chars"), F.log1p(n).alias("log_words"),
        F.coalesce(F.length("text") / F.when(n > 0, n), F.lit(0.0)).alias("chars_per_word"),
        F.coalesce(F.size(F.array_distinct("_words")) / F.when(n > 0, n), F.lit(0.0)).alias("distinct_share"),
        _share("[A-Z]", chars).alias("capital_share"), _share("[0-9]", chars).alias("digit_share"),
        _share("[#*$%&|<>]", chars).alias("symbol_share"), _share("[!?]", chars).alias("exclaim_share"),
        _share("[.,;:]", chars).alias("stop_share"), _share("[aeiouAEIOU]", chars).alias("vowel_share"),
        F.log1p(F.regexp_count("text", F.lit("\n"))).alias("log_lines"),
        F.element_at(F.array(*[F.lit(c) for c in CLASSES]),
                     F.when(F.col("q") == 1, 1).otherwise(3) + F.when(F.col("t") == 1, 1).otherwise(0)).alias(TARGET))


_STORED: dict = {}


def stored_outcomes(spark, sf_dir: str) -> DataFrame:
    """The labelled rows, written once per application to the shared checkpoint
    folder, so fits re-read small rows instead of the texts."""
    from outcomelab.session import checkpoint_root
    from outcomelab.sources import read_table
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED:
        checkpoint_root(spark)
        _STORED[key] = labelled_documents(read_table(spark, sf_dir, "documents"),
                                          read_table(spark, sf_dir, "labels")).checkpoint(eager=True)
    return _STORED[key]
