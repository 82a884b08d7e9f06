"""Positions and running sums over a total order, without one task holding it.

Rows are range-partitioned by the order and sorted inside their partition; the
row numbers of that layout are stored once (``checkpoint()``), so the partition
of a row is fixed. Sums of whole partitions, a table of one row a partition,
give each partition its offset. Exact AUC, exact order statistics and the
frequency rank of categories are read off these running sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LOCAL_BITS = 33  # monotonically_increasing_id: partition above, row number below


def running(df: DataFrame, order: Sequence[Column], sums: Sequence[str] = ()) -> DataFrame:
    """Adds ``pos`` (0-based place in the order) and, for each column of
    ``sums``, ``<name>_before``: its sum over all earlier rows.

    Rows that are equal in the order get places in a stored, otherwise free
    order; NULLs sort as the order says. Two shuffles: the range partitioning,
    and one by partition number for the window.
    """
    from outcomelab.session import checkpoint_root
    checkpoint_root(df.sparkSession)
    laid = (df.repartitionByRange(*order).sortWithinPartitions(*order)
            .withColumn("_at", F.monotonically_increasing_id()).checkpoint(eager=True))
    laid = laid.withColumn("_part", F.shiftright("_at", _LOCAL_BITS))
    parts = laid.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_t{i}") for i, c in enumerate(sums)])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row a partition
    offsets = parts.select(F.col("_part").alias("_of"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"),
                           *[F.coalesce(F.sum(f"_t{i}").over(earlier), F.lit(0)).alias(f"_s{i}")
                             for i in range(len(sums))])
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    local = [F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_l{i}") for i, c in enumerate(sums)]
    out = laid.select("*", *local).join(F.broadcast(offsets), F.col("_part") == F.col("_of"))
    out = out.withColumn("pos", F.col("_n0") + F.col("_at").bitwiseAND((1 << _LOCAL_BITS) - 1))
    for i, c in enumerate(sums):
        out = out.withColumn(f"{c}_before", F.col(f"_s{i}") + F.col(f"_l{i}"))
    return out.drop("_at", "_part", "_of", "_n0", *[f"_s{i}" for i in range(len(sums))],
                    *[f"_l{i}" for i in range(len(sums))])


def category_index(df: DataFrame, col: str) -> DataFrame:
    """(category, n, category_id) of the non-NULL values of ``col`` as text:
    numbered from 0 by falling frequency, ties in alphabetical order. A table:
    the categories are never listed on the driver."""
    counts = (df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("category"))
              .agg(F.count(F.lit(1)).alias("n")))
    return running(counts, [F.col("n").desc(), F.col("category")]).withColumnRenamed("pos", "category_id")


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, qs: Sequence[float]) -> DataFrame:
    """(by..., n, q): exact quantiles (linear interpolation between order
    statistics) as ARRAY<DOUBLE> ``q`` in the order of ``qs``.

    Rows fold to (group, value, count); running counts over (group, value) find
    the values at the wanted ranks. NULL values are left out, a NULL group key
    is a group, a group without values has no row.
    """
    v = F.col(value).cast("double")
    folded = (df.where(v.isNotNull() & ~F.isnan(v)).groupBy(*by, v.alias("_value")).agg(F.count(F.lit(1)).alias("_n")))
    return quantiles_of_counts(folded, by, "_value", "_n", qs)


def quantiles_of_counts(folded: DataFrame, by: Sequence[str], value: str, count: str, qs: Sequence[float]) -> DataFrame:
    """``exact_quantiles`` of rows already folded to distinct (by..., value)."""
    by = list(by)
    folded = folded.select(*by, F.col(value).alias("_v"), F.col(count).alias("_c"))
    # _c_before is counted over the whole order: less its least value it is the count inside the group
    at = running(folded, [*[F.col(c).asc_nulls_first() for c in by], F.col("_v")], ["_c"])
    keys = [F.col(c).alias(f"_g{i}") for i, c in enumerate(by)]
    groups = at.groupBy(*keys).agg(F.sum(F.col("_c")).alias("n"), F.min("_c_before").alias("_base"))
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    at = at.join(groups, same) if by else at.crossJoin(F.broadcast(groups))
    first = F.col("_c_before") - F.col("_base")
    aggs = []
    for j, q in enumerate(qs):
        h = F.lit(float(q)) * (F.col("n") - 1)
        for name, rank in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            aggs.append(F.max(F.when((first <= rank) & (rank < first + F.col("_c")), F.col("_v"))).alias(f"_{name}{j}"))
    got = at.groupBy(*by, "n").agg(*aggs)
    cols = []
    for j, q in enumerate(qs):
        h = F.lit(float(q)) * (F.col("n") - 1)
        lo, hi = F.col(f"_lo{j}"), F.col(f"_hi{j}")
        cols.append(lo + (hi - lo) * (h - F.floor(h)))
    return got.select(*by, "n", F.array(*cols).alias("q"))


def auc_by_class(df: DataFrame, label: str, scores: str, k: int, weight: str | None = None) -> DataFrame:
    """(class_index, n_pos, n_neg, auc): exact one-vs-rest ROC AUC of every
    class of ``scores`` (ARRAY<DOUBLE>), ties counted half, in one plan.

    Rows become (class, score, positive, negative) and fold by score; the
    negatives below a score come from one running sum over (class, score). AUC
    is NULL for a class without positive or negative rows. Rows with a NULL
    label are left out.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1).cast("decimal(19,0)")
    zero = F.lit(0.0) if weight else F.lit(0).cast("decimal(19,0)")
    long = df.where(F.col(label).isNotNull()).select(
        F.col(label).alias("_y"), w.alias("_w"), F.posexplode(F.slice(scores, 1, k)).alias("class_index", "_score"))
    hit = F.col("_y") == F.col("class_index")
    folded = long.groupBy("class_index", "_score").agg(
        F.sum(F.when(hit, F.col("_w")).otherwise(zero)).alias("_p"),
        F.sum(F.when(hit, zero).otherwise(F.col("_w"))).alias("_n"))
    at = running(folded, [F.col("class_index"), F.col("_score")], ["_n"])
    kind = "double" if weight else "decimal(38,0)"
    p, n, before = (F.col(c).cast("double" if weight else "decimal(19,0)") for c in ("_p", "_n", "_n_before"))
    got = at.groupBy("class_index").agg(
        F.sum("_p").alias("n_pos"), F.sum("_n").alias("n_neg"), F.min("_n_before").alias("_base"),
        F.sum((p * before).cast(kind)).alias("_below"), F.sum((p * n).cast(kind)).alias("_tied"))
    # twice the number of ordered pairs
    twice = (F.col("_below").cast("double") * 2 - F.col("_base").cast("double") * F.col("n_pos").cast("double") * 2
             + F.col("_tied").cast("double"))
    both = F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return got.select(F.col("class_index").cast("bigint").alias("class_index"),
                      F.col("n_pos").cast("double").alias("n_pos"), F.col("n_neg").cast("double").alias("n_neg"),
                      F.when(both > 0, twice / (both * 2)).alias("auc"))
