"""Row preparation: sentinel recode, time splits, incomplete rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sentinel_recode(df: DataFrame, col: str, sentinel=0, out: str | None = None) -> DataFrame:
    """Replace ``sentinel`` by (largest value above the sentinel) + 1.

    The maximum is a scalar subquery inside the same plan: one partial
    aggregate per task, a single row to the driver-side planner, no eager
    collect and no join.
    """
    c = F.col(col)
    top = df.filter(c > F.lit(sentinel)).agg(F.max(c)).scalar()
    return df.withColumn(out or col, F.when(c == F.lit(sentinel), top + F.lit(1)).otherwise(c))


SPLIT_NAMES = ("train", "val", "test")


def temporal_split(df: DataFrame, year: str, train_last: int, val_year: int,
                   test_first: int, out: str = "split") -> DataFrame:
    """Label each row train (<= train_last), val (== val_year) or test
    (>= test_first); other years and NULL years get NULL."""
    y = F.col(year)
    return df.withColumn(out, F.when(y <= train_last, F.lit("train"))
                         .when(y == val_year, F.lit("val"))
                         .when(y >= test_first, F.lit("test")))


def split_counts(df: DataFrame, split: str = "split") -> DataFrame:
    """Rows per split in one aggregate (one shuffle of a few partial rows)."""
    return (df.groupBy(split).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col(split).isNotNull()))


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL (or NaN, for floating columns) in ``cols``."""
    return df.na.drop(how="any", subset=list(cols) if cols else None)
