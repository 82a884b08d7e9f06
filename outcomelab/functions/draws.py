"""Seeded draws that do not depend on partitioning.

``rand(seed)`` gives different values when the same rows sit in a different
number of partitions. A draw here is a pure function of (seed, row id): the
first 15 hex digits of ``md5('<seed>-<id>')`` read as a BIGINT. DuckDB
computes the same number with
``('0x' || substr(md5('<seed>-' || cast(id AS VARCHAR)), 1, 15))::BIGINT``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 15 hex digits = 60 bits: the draw lies in [0, 2**60).
HASH_SPAN = float(2 ** 60)


def _key(seed, cols) -> Column:
    parts = [F.lit(str(seed))] + [F.col(c).cast("string") if isinstance(c, str)
                                  else c.cast("string") for c in cols]
    return F.concat_ws("-", *parts)


def hash_draw(seed, *cols) -> Column:
    """BIGINT in [0, 2**60) from md5 of ``seed-col1-col2...``."""
    return F.conv(F.substring(F.md5(_key(seed, cols)), 1, 15), 16, 10).cast("bigint")


def unit_draw(seed, *cols) -> Column:
    """DOUBLE in [0, 1), uniform, same value on any partitioning."""
    return hash_draw(seed, *cols).cast("double") / F.lit(HASH_SPAN)
