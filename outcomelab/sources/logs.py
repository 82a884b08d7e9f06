"""Reading numbers back out of text reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomelab.functions.text import extract_number


def read_text_log(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, column ``value`` holds the whole text.

    ``wholetext`` is passed as an argument: the reader option of the same
    name is overridden by the argument's default.
    """
    return spark.read.text(path, wholetext=True).withColumn("path", F.col("_metadata.file_path"))


def scrape_metrics(text_df: DataFrame, section: str | None,
                   patterns: Mapping[str, str], text_col: str = "value") -> DataFrame:
    """Parse named numbers out of each text, optionally after a section title.

    ``patterns`` maps an output column to a regex whose group 1 is the number.
    A missing section or number gives NULL (the report may not exist yet).
    """
    body = F.col(text_col)
    if section is not None:
        idx = F.instr(body, section)
        body = F.when(idx > 0, F.substring(body, idx + len(section), F.length(body)))
    cols = [extract_number(body, pat).alias(name) for name, pat in patterns.items()]
    keep = [c for c in text_df.columns if c != text_col]
    return text_df.select(*keep, *cols)
