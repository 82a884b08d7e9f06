"""Class labels: encode to a numeric index, decode back, indicator flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def encode_label(col, classes: Sequence[str]) -> Column:
    """DOUBLE index of the class in ``classes``; NULL for anything else.

    There is no ``otherwise``: a label outside the list must stay NULL so
    it can be rejected before a fit instead of being trained as a negative.
    """
    c = _c(col)
    expr = F.when(c == F.lit(classes[0]), F.lit(0.0))
    for i, name in enumerate(classes[1:], start=1):
        expr = expr.when(c == F.lit(name), F.lit(float(i)))
    return expr


def decode_label(col, classes: Sequence[str]) -> Column:
    """Class name for a numeric index; NULL when out of range."""
    arr = F.array(*[F.lit(x) for x in classes])
    idx = _c(col).cast("int") + F.lit(1)
    return F.when((idx >= 1) & (idx <= len(classes)), F.element_at(arr, idx))


def differs_from(col, value) -> Column:
    """1 unless the value equals ``value``; a NULL counts as different."""
    return (~_c(col).eqNullSafe(F.lit(value))).cast("int")


def at_most(col, threshold) -> Column:
    """1 when ``col <= threshold``, else 0 (NULL gives 0)."""
    return F.when(_c(col) <= F.lit(threshold), F.lit(1)).otherwise(F.lit(0))


def event_flag(col, value) -> Column:
    """1 when the outcome equals ``value``, else 0; a NULL outcome is 0."""
    return F.when(_c(col) == F.lit(value), F.lit(1)).otherwise(F.lit(0))
