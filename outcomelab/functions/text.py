"""Pulling values out of free text with regular expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def extract_group(col, pattern: str, group: int = 1) -> Column:
    """Group of the first match; '' when there is no match (Spark's rule)."""
    return F.regexp_extract(_c(col), pattern, group)


def extract_number(col, pattern: str, group: int = 1) -> Column:
    """Group of the first match parsed as DOUBLE; NULL when absent or bad."""
    raw = F.trim(F.regexp_extract(_c(col), pattern, group))
    return F.when(raw != F.lit(""), raw.try_cast("double"))
