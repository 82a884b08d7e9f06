"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unpivot_rows(*rows: Sequence[tuple[str, Column]]) -> Column:
    """Generator: one output row per given list of (name, expression).

    Turns one wide aggregate row into a handful of long rows without a join;
    every row must have the same names in the same order.
    """
    return F.inline(F.array(*[F.struct(*[e.alias(n) for n, e in r]) for r in rows]))


def ratio(num, den) -> Column:
    """num / den as DOUBLE, NULL when den is 0 or NULL (ANSI-safe)."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def ratio0(num, den) -> Column:
    """num / den, 0 when den is 0 (zero-division rule of the metrics)."""
    return F.coalesce(ratio(num, den), F.lit(0.0))


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df if cond is None else df.filter(cond)
