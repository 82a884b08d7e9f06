"""Ordered categories from numbers: eras and right-closed tiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Era names and their last years, as the analysis defines them.
ERA_LABELS = ("V8 (2005-2013)", "Hybrid (2014-2021)", "Ground Effect (2022-2025)")
ERA_LAST_YEARS = (2013, 2021)

# Standing tiers, right-closed bins (0,2], (2,5], (5,10], (10,30].
TIER_EDGES = (0, 2, 5, 10, 30)
TIER_LABELS = ("Top-2", "3rd-5th", "6th-10th", "11th+")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ordered_bucket(col, upper_bounds: Sequence, labels: Sequence[str]) -> Column:
    """First label whose inclusive upper bound holds; else the last label.

    ``len(labels) == len(upper_bounds) + 1``. A NULL input compares false
    everywhere and so gets the last label, as an if-chain on a missing year
    does.
    """
    if len(labels) != len(upper_bounds) + 1:
        raise ValueError("need one more label than bounds")
    c = _c(col)
    expr = F.when(c <= F.lit(upper_bounds[0]), F.lit(labels[0]))
    for b, lab in zip(upper_bounds[1:], labels[1:-1]):
        expr = expr.when(c <= F.lit(b), F.lit(lab))
    return expr.otherwise(F.lit(labels[-1]))


def era_of_year(col, last_years: Sequence = ERA_LAST_YEARS,
                labels: Sequence[str] = ERA_LABELS) -> Column:
    return ordered_bucket(col, last_years, labels)


def right_closed_bins(col, edges: Sequence, labels: Sequence[str]) -> Column:
    """Label of the bin (edges[i], edges[i+1]]; NULL outside all bins.

    Unlike ``Bucketizer`` (left-closed, and failing on out-of-range values),
    a value on an edge belongs to the lower bin and values outside the
    range give NULL.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per bin")
    c = _c(col)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (c > F.lit(lo)) & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def label_order(col, labels: Sequence[str]) -> Column:
    """0-based position of a label in its fixed order, NULL if absent."""
    pos = F.array_position(F.array(*[F.lit(x) for x in labels]), _c(col))
    return F.when(pos > 0, (pos - 1).cast("bigint"))
