"""Distribution summaries: box-plot statistics, running shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from outcomelab.operators._util import drop_null_keys


def boxplot_stats(df: DataFrame, by: Sequence[str], value: str,
                  whis: float = 1.5, exact: bool = True,
                  accuracy: int = 10_000) -> DataFrame:
    """Quartiles (linear interpolation), whiskers and outliers per group.

    Whiskers reach the most extreme data points inside
    [Q1 - whis*IQR, Q3 + whis*IQR]; points outside are outliers.

    Plan: rows are first folded to (group, value, weight) - a partial
    aggregate, so a hot group or value costs nothing extra. Exact quartiles
    are order statistics read off running counts over (group, value)
    (``ordered.exact_quantiles``), so no task holds a group, however many
    distinct values it has; the per-group fences are joined back to the folded
    table (one row per group: Spark broadcasts it when its measured size
    allows) for the whisker pass.

    ``exact=False`` takes ``percentile_approx`` instead: one shuffle less, a
    mergeable sketch per group with a rank error of about 1/``accuracy``.
    Whiskers and outliers are then exact relative to the approximate fences.
    """
    by = list(by)
    keys = by or ["_all"]
    base = df if by else df.withColumn("_all", F.lit(0))
    v = F.col(value).cast("double")
    folded = (drop_null_keys(base, keys).filter(v.isNotNull())
              .groupBy(*keys, v.alias("_v")).agg(F.count(F.lit(1)).alias("_w")))
    if exact:
        from outcomelab.operators.ordered import quantiles_of_counts
        from outcomelab.session import checkpoint_root
        checkpoint_root(df.sparkSession)
        folded = folded.checkpoint()
        q = quantiles_of_counts(folded, keys, "_v", "_w", [0.25, 0.5, 0.75]).withColumnRenamed("q", "_q")
    else:
        # the sketch reads raw rows (it has no weights); no folding needed
        raw = drop_null_keys(base, keys).filter(v.isNotNull())
        q = raw.groupBy(*keys).agg(F.percentile_approx(v, [0.25, 0.5, 0.75], accuracy).alias("_q"),
                                   F.count(F.lit(1)).alias("n"))
    stats = q.select(*keys, "n", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                     F.col("_q")[2].alias("q3"))
    stats = (stats.withColumn("iqr", F.col("q3") - F.col("q1"))
             .withColumn("lo_fence", F.col("q1") - F.lit(whis) * F.col("iqr"))
             .withColumn("hi_fence", F.col("q3") + F.lit(whis) * F.col("iqr")))
    lo, hi, x = F.col("lo_fence"), F.col("hi_fence"), F.col("_v")
    stat_cols = ["n", "q1", "median", "q3", "iqr", "lo_fence", "hi_fence"]
    # the statistics are constant within a group: grouping by them as well
    # carries them through without a second join
    out = (folded.join(stats, keys)
           .groupBy(*keys, *stat_cols)
           # a whisker never ends inside the box
           .agg(F.least(F.min(F.when(x >= lo, x)), F.first("q1")).alias("whisker_low"),
                F.greatest(F.max(F.when(x <= hi, x)), F.first("q3")).alias("whisker_high"),
                F.sum(F.when((x < lo) | (x > hi), F.col("_w")).otherwise(F.lit(0)))
                .cast("bigint").alias("n_outliers"),
                F.min(x).alias("min_value"), F.max(x).alias("max_value")))
    return out.drop("_all") if not by else out


def cumulative_share(df: DataFrame, order: str, value: str, out: str = "cum_pct") -> DataFrame:
    """Running sum of ``value`` in ``order``.

    The window has no partition key, so every row meets in one task: only
    for results whose size a parameter bounds (one row per class or per
    component), never for raw tables.
    """
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.sum(F.col(value)).over(w))
