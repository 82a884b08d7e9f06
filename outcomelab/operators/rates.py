"""Outcome rates: by key, on two-way tier grids, class shares.

All of these are single-pass aggregates. Hot keys are harmless: partial
aggregation folds them on the map side before the shuffle. Dense grids come
from conditional aggregates unpivoted by a generator, not from joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomelab.functions.labels import at_most, event_flag
from outcomelab.operators._util import col, drop_null_keys, ratio, unpivot_rows


def rate_by_key(df: DataFrame, key: str, outcome: str, event,
                n_top: int | None = None) -> DataFrame:
    """Per key: rows, events, 100 * events / rows.

    NULL keys are dropped. A NULL outcome counts in ``n_rows`` and never as
    an event. ``n_top`` keeps the first keys in ascending key order (a
    top-k, not a sort of the whole result).
    """
    out = (drop_null_keys(df, [key]).groupBy(key)
           .agg(F.count(F.lit(1)).alias("n_rows"),
                F.sum(event_flag(outcome, event)).cast("bigint").alias("n_events"))
           .withColumn("rate_pct", F.col("n_events") * F.lit(100.0) / F.col("n_rows")))
    if n_top:
        out = out.orderBy(key).limit(n_top)
    return out


def _cell(inside: Column, outcome: str, event) -> tuple[Column, Column]:
    n = F.count(F.when(inside, F.col(outcome)))
    rate = F.avg(F.when(inside, event_flag(outcome, event))) * F.lit(100.0)
    return n, rate


def two_way_rate(df: DataFrame, row, column, col_labels: Sequence[str],
                 outcome: str, event, row_labels: Sequence[str] | None = None,
                 min_support: int = 30, row_name: str = "row_tier",
                 col_name: str = "col_tier") -> DataFrame:
    """Event rate on a row x column grid, every column label present.

    ``n`` counts rows with a non-NULL outcome in the cell; ``rate_pct`` is
    the event share over all rows in the cell (NULL outcome = no event),
    NULL for an empty cell; ``rate_pct_masked`` is ``rate_pct`` where
    ``n >= min_support``. With ``row_labels`` the grid is the full fixed
    rows x columns grid (one global aggregate); without, rows are the
    observed non-NULL values of ``row`` (one grouped aggregate).
    """
    r, c = col(row), col(column)
    if row_labels is not None:
        aggs, rows = [], []
        for i, rl in enumerate(row_labels):
            for j, cl in enumerate(col_labels):
                n, rate = _cell((r == F.lit(rl)) & (c == F.lit(cl)), outcome, event)
                aggs += [n.alias(f"_n_{i}_{j}"), rate.alias(f"_r_{i}_{j}")]
                rows.append([(row_name, F.lit(rl)), ("row_order", F.lit(i).cast("bigint")),
                             (col_name, F.lit(cl)), ("col_order", F.lit(j).cast("bigint")),
                             ("n", F.col(f"_n_{i}_{j}")), ("rate_pct", F.col(f"_r_{i}_{j}"))])
        long = df.agg(*aggs).select(unpivot_rows(*rows))
    else:
        aggs, rows = [], []
        for j, cl in enumerate(col_labels):
            n, rate = _cell(c == F.lit(cl), outcome, event)
            aggs += [n.alias(f"_n_{j}"), rate.alias(f"_r_{j}")]
            rows.append([(col_name, F.lit(cl)), ("col_order", F.lit(j).cast("bigint")),
                         ("n", F.col(f"_n_{j}")), ("rate_pct", F.col(f"_r_{j}"))])
        keyed = df.withColumn(row_name, r)
        long = (drop_null_keys(keyed, [row_name]).groupBy(row_name).agg(*aggs)
                .select(row_name, unpivot_rows(*rows)))
    return long.withColumn(
        "rate_pct_masked", F.when(F.col("n") >= F.lit(min_support), F.col("rate_pct")))


def rate_label(masked_grid: DataFrame, min_support: int = 30, digits: int = 1) -> DataFrame:
    """Display text per cell: 'x.x% (n=N)', or 'n<30 (n=N)' under support."""
    rounded = F.round(F.col("rate_pct"), digits)
    text = F.when(F.col("n") >= F.lit(min_support),
                  F.format_string(f"%.{digits}f%% (n=%d)", rounded, F.col("n")))
    text = text.otherwise(F.format_string(f"n<{min_support} (n=%d)", F.col("n")))
    return masked_grid.withColumn("label", text)


def class_distribution(df: DataFrame, outcome: str, classes: Sequence[str]) -> DataFrame:
    """Rows and % of all rows per class, in the fixed class order.

    The denominator is every row, NULL or unknown outcomes included. A
    class that never occurs gets 0 rows. One global aggregate, one row per
    class out.
    """
    o = F.col(outcome)
    aggs = [F.count(F.lit(1)).alias("_total")]
    aggs += [F.count(F.when(o == F.lit(c), F.lit(1))).alias(f"_n_{i}") for i, c in enumerate(classes)]
    rows = [[(outcome, F.lit(c)), ("class_order", F.lit(i).cast("bigint")),
             ("n_rows", F.col(f"_n_{i}")),
             ("pct", ratio(F.col(f"_n_{i}") * F.lit(100.0), F.col("_total")))]
            for i, c in enumerate(classes)]
    return df.agg(*aggs).select(unpivot_rows(*rows))


def share_at_most(df: DataFrame, by: Sequence[str], value: str, threshold) -> DataFrame:
    """Per group: rows and % of rows with ``value <= threshold``."""
    return (drop_null_keys(df, by).groupBy(*by)
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 (F.avg(at_most(value, threshold)) * F.lit(100.0)).alias("share_pct")))


def group_median(df: DataFrame, by: Sequence[str], value: str, exact: bool = True,
                 accuracy: int = 10_000) -> DataFrame:
    """Per group: interpolated median of ``value`` and the row count.

    The median is read off running counts over (group, value), so no task
    holds a group (``ordered.exact_quantiles``); a group without values has
    median NULL. ``exact=False`` uses a bounded sketch (``percentile_approx``).
    """
    rows = drop_null_keys(df, by)
    if not exact:
        med = F.percentile_approx(F.col(value).cast("double"), 0.5, accuracy).cast("double")
        return rows.groupBy(*by).agg(med.alias("median_value"), F.count(F.lit(1)).alias("n_rows"))
    from outcomelab.operators.ordered import quantiles_of_counts
    from outcomelab.session import checkpoint_root
    # one pass over the rows: the folded counts hold NULL values as well
    checkpoint_root(df.sparkSession)
    folded = (rows.groupBy(*by, F.col(value).cast("double").alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
              .checkpoint())
    counts = folded.groupBy(*by).agg(F.sum("_n").alias("n_rows"))
    real = folded.where(F.col("_value").isNotNull() & ~F.isnan("_value"))
    med = quantiles_of_counts(real, by, "_value", "_n", [0.5]).select(*by, F.col("q")[0].alias("median_value"))
    return counts.join(med, list(by), "left").select(*by, "median_value", "n_rows")


def min_rows_guard(df: DataFrame, by: Sequence[str], value: str, min_rows: int) -> DataFrame:
    """Per group mean and population std of ``value``; a group with fewer
    than ``min_rows`` rows reports mean NULL and std 0."""
    ok = F.col("n_rows") >= F.lit(min_rows)
    return (drop_null_keys(df, by).groupBy(*by)
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.avg(F.col(value).cast("double")).alias("_m"),
                 F.stddev_pop(F.col(value).cast("double")).alias("_s"))
            .select(*by, "n_rows",
                    F.when(ok, F.col("_m")).alias("mean_value"),
                    F.when(ok, F.col("_s")).otherwise(F.lit(0.0)).alias("std_value")))
