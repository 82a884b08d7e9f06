"""Registry of query bindings and shared binding helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Digits kept on DOUBLE outputs so that both engines agree to the last digit.
DIGITS = 6


def query(name: str):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        return fn
    return deco


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every DOUBLE/FLOAT column; leave the others as they are."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
