"""Load profile: row count and the range of a year column, one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def load_profile(df: DataFrame, year: Column | str) -> DataFrame:
    y = F.col(year) if isinstance(year, str) else year
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.min(y).cast("bigint").alias("min_year"),
                  F.max(y).cast("bigint").alias("max_year"))
