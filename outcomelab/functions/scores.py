"""Score vectors: softmax of margins and the arg-max class."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def dense_array(col) -> Column:
    """ML vector (dense or sparse) to ARRAY<DOUBLE>; arrays pass through."""
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(_c(col), "float64")


def softmax(arr) -> Column:
    """Max-shifted softmax of an ARRAY<DOUBLE>; each result sums to 1."""
    a = _c(arr)
    m = F.array_max(a)
    e = F.transform(a, lambda x: F.exp(x - m))
    s = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(e, lambda x: x / s)


def argmax(arr) -> Column:
    """0-based index of the largest entry; the first one wins a tie."""
    a = _c(arr)
    return (F.array_position(a, F.array_max(a)) - F.lit(1)).cast("int")
