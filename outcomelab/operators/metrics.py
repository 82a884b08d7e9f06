"""Multiclass evaluation from distributed aggregates.

Every metric derives from per-class counts (true positives, support,
predicted) that one partial aggregate computes in a single pass; nothing
row-level reaches the driver. ``by`` columns give one result per group
(fold, model, repeat) from the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomelab.operators._util import ratio, ratio0, unpivot_rows


def _lit_labels(classes):
    return [F.lit(c) for c in classes]


def class_counts(df: DataFrame, truth: str, pred: str, classes: Sequence,
                 by: Sequence[str] = ()) -> DataFrame:
    """One wide row per group with, for class i: ``tp_i``; ``sup_i`` and
    ``prd_i`` (rows whose truth / prediction is the class); ``supin_i`` and
    ``prdin_i`` (the same inside the k x k table, i.e. both truth and
    prediction in the class list); plus ``n_all`` and ``n_in``.
    """
    t, p = F.col(truth), F.col(pred)
    lits = _lit_labels(classes)
    in_list = t.isin(*lits) & p.isin(*lits)
    aggs = [F.count(F.lit(1)).alias("n_all"), F.count(F.when(in_list, 1)).alias("n_in")]
    for i, c in enumerate(classes):
        lc = F.lit(c)
        aggs += [F.count(F.when((t == lc) & (p == lc), 1)).alias(f"tp_{i}"),
                 F.count(F.when(t == lc, 1)).alias(f"sup_{i}"),
                 F.count(F.when(p == lc, 1)).alias(f"prd_{i}"),
                 F.count(F.when((t == lc) & in_list, 1)).alias(f"supin_{i}"),
                 F.count(F.when((p == lc) & in_list, 1)).alias(f"prdin_{i}")]
    g = df.groupBy(*by) if by else df
    return g.agg(*aggs)


def _per_class(i: int) -> dict[str, Column]:
    tp, sup, prd = F.col(f"tp_{i}"), F.col(f"sup_{i}"), F.col(f"prd_{i}")
    # specificity comes from the k x k table, as a confusion matrix over
    # the class list gives it
    fp_in = F.col(f"prdin_{i}") - tp
    tn_in = F.col("n_in") - F.col(f"supin_{i}") - F.col(f"prdin_{i}") + tp
    return {"precision": ratio0(tp, prd), "recall": ratio0(tp, sup),
            "f1": ratio0(tp * F.lit(2), sup + prd), "specificity": ratio0(tn_in, tn_in + fp_in),
            "support": sup}


def _mean(cols: list[Column]) -> Column:
    return _sum(cols) / F.lit(float(len(cols)))


def _sum(cols: list[Column]) -> Column:
    s = cols[0]
    for c in cols[1:]:
        s = s + c
    return s


def metrics_summary(df: DataFrame, truth: str, pred: str, classes: Sequence,
                    by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, Cohen's kappa, macro precision / sensitivity / specificity
    / F1 and support-weighted F1 over the fixed class list (0/0 -> 0).

    Accuracy divides by every row. Precision, recall and F1 count all rows
    of a class; specificity and kappa use the k x k table of rows whose truth
    and prediction are both in the list. Kappa is NULL when chance
    agreement is 1. One pass, one row per group.
    """
    k = len(classes)
    wide = class_counts(df, truth, pred, classes, by)
    per = [_per_class(i) for i in range(k)]
    n_in = F.col("n_in")
    diag = _sum([F.col(f"tp_{i}") for i in range(k)])
    po = ratio(diag, n_in)
    pe = ratio(_sum([F.col(f"supin_{i}") * F.col(f"prdin_{i}") for i in range(k)]), n_in * n_in)
    kappa = F.when(pe < F.lit(1.0), (po - pe) / (F.lit(1.0) - pe))
    sup_tot = _sum([F.col(f"sup_{i}") for i in range(k)])
    wf1 = ratio0(_sum([x["f1"] * x["support"] for x in per]), sup_tot)
    return wide.select(
        *by,
        F.col("n_all").alias("n_rows"),
        ratio(diag, F.col("n_all")).alias("accuracy"),
        kappa.alias("kappa"),
        _mean([x["precision"] for x in per]).alias("macro_precision"),
        _mean([x["recall"] for x in per]).alias("macro_sensitivity"),
        _mean([x["specificity"] for x in per]).alias("macro_specificity"),
        _mean([x["f1"] for x in per]).alias("macro_f1"),
        wf1.alias("weighted_f1"))


def macro_f1_present(df: DataFrame, truth: str, pred: str, classes: Sequence,
                     by: Sequence[str] = ()) -> DataFrame:
    """Macro-F1 over the classes that occur in truth or prediction (the
    scorer used in cross-validation), one row per group."""
    k = len(classes)
    wide = class_counts(df, truth, pred, classes, by)
    present = [F.when((F.col(f"sup_{i}") + F.col(f"prd_{i}")) > 0, F.lit(1.0)).otherwise(F.lit(0.0))
               for i in range(k)]
    f1 = [ratio0(F.col(f"tp_{i}") * F.lit(2), F.col(f"sup_{i}") + F.col(f"prd_{i}")) for i in range(k)]
    return wide.select(*by, ratio(_sum(f1), _sum(present)).alias("macro_f1"))


def class_report(df: DataFrame, truth: str, pred: str, classes: Sequence,
                 truth_name: str = "class") -> DataFrame:
    """Precision, recall, F1 and support per class, then 'macro avg' and
    'weighted avg' rows (support-weighted), in a fixed order."""
    k = len(classes)
    wide = class_counts(df, truth, pred, classes)
    per = [_per_class(i) for i in range(k)]
    sup_tot = _sum([x["support"] for x in per])
    rows = []
    for i, c in enumerate(classes):
        x = per[i]
        rows.append([(truth_name, F.lit(str(c))), ("row_order", F.lit(i).cast("bigint")),
                     ("precision", x["precision"]), ("recall", x["recall"]),
                     ("f1", x["f1"]), ("support", x["support"].cast("bigint"))])
    rows.append([(truth_name, F.lit("macro avg")), ("row_order", F.lit(k).cast("bigint")),
                 ("precision", _mean([x["precision"] for x in per])),
                 ("recall", _mean([x["recall"] for x in per])),
                 ("f1", _mean([x["f1"] for x in per])), ("support", sup_tot.cast("bigint"))])
    rows.append([(truth_name, F.lit("weighted avg")), ("row_order", F.lit(k + 1).cast("bigint")),
                 ("precision", ratio0(_sum([x["precision"] * x["support"] for x in per]), sup_tot)),
                 ("recall", ratio0(_sum([x["recall"] * x["support"] for x in per]), sup_tot)),
                 ("f1", ratio0(_sum([x["f1"] * x["support"] for x in per]), sup_tot)),
                 ("support", sup_tot.cast("bigint"))])
    return wide.select(unpivot_rows(*rows))


def _class_order(col, classes: Sequence):
    """Position of a value in the class list, compared as typed values."""
    return F.coalesce(*[F.when(col == F.lit(c), F.lit(i).cast("bigint")) for i, c in enumerate(classes)])


def confusion_matrix(df: DataFrame, truth: str, pred: str, classes: Sequence) -> DataFrame:
    """Dense k x k table (true, predicted, n) in the fixed class order.

    One grouped count over the typed columns (at most a row per pair of values
    after partial aggregation); the few grouped rows get their positions in
    the class list and are left-joined onto the literal grid, whose size the
    class list bounds. Values outside the list are not counted.
    """
    labels = F.lit([str(c) for c in classes])
    grid = (df.sparkSession.range(1).select(F.posexplode(labels).alias("true_order", "true_label"))
            .select(F.col("true_order").cast("bigint").alias("true_order"), "true_label",
                    F.posexplode(labels).alias("pred_order", "pred_label"))
            .withColumn("pred_order", F.col("pred_order").cast("bigint")))
    counts = (df.groupBy(F.col(truth).alias("_t"), F.col(pred).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
              .groupBy(_class_order(F.col("_t"), classes).alias("_i"), _class_order(F.col("_p"), classes).alias("_j"))
              .agg(F.sum("_n").alias("_n")))
    joined = grid.join(counts, (F.col("true_order") == F.col("_i")) & (F.col("pred_order") == F.col("_j")), "left")
    return joined.select("true_label", "true_order", "pred_label", "pred_order",
                         F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("n"))


def confusion_normalized(cm: DataFrame) -> DataFrame:
    """Row-normalised confusion table; a class with no true rows gives NULL.

    The window is over the k x k table only (k^2 rows).
    """
    from pyspark.sql import Window
    w = Window.partitionBy("true_label")
    return cm.withColumn("row_share", ratio(F.col("n"), F.sum("n").over(w)))


def metrics_long(summary: DataFrame, model: str,
                 names: Sequence[str] = ("accuracy", "kappa", "macro_precision",
                                         "macro_sensitivity", "macro_specificity",
                                         "macro_f1", "weighted_f1")) -> DataFrame:
    """(model, metric, value) rows from a one-row summary."""
    rows = [[("metric", F.lit(n)), ("metric_order", F.lit(i).cast("bigint")),
             ("value", F.col(n).cast("double"))] for i, n in enumerate(names)]
    return summary.select(F.lit(model).alias("model"), unpivot_rows(*rows))


def auc_ovr(spark: SparkSession, df: DataFrame, label_idx: str, probs: str,
            k: int, weight: str | None = None) -> DataFrame:
    """One-vs-rest ROC AUC per class and their macro mean (class_index -1).

    Exact, ties counted half, all classes in one plan
    (``ordered.auc_by_class``). A class with no positive or no negative row has
    no AUC, and then the macro value is NULL as well. ``probs`` is an
    ARRAY<DOUBLE> of length k.
    """
    from outcomelab.operators.ordered import auc_by_class
    got = auc_by_class(df, label_idx, probs, k, weight).select(F.col("class_index").alias("_c"), "auc")
    each = (spark.range(k).withColumnRenamed("id", "class_index")
            .join(got, F.col("class_index") == F.col("_c"), "left").select("class_index", "auc"))
    macro = each.agg(F.when(F.count("auc") == k, F.avg("auc")).alias("auc"))
    return each.unionByName(macro.select(F.lit(-1).cast("bigint").alias("class_index"), "auc"))


def evaluation(spark: SparkSession, df: DataFrame, truth: str, pred: str, probs: str, classes: Sequence,
               model: str) -> DataFrame:
    """(model, metric, metric_order, value): the seven metrics of
    ``metrics_summary`` and the macro AUC of the class probabilities ``probs``.
    ``truth`` holds class numbers 0..k-1 in the order of ``classes``."""
    long = metrics_long(metrics_summary(df, truth, pred, classes), model)
    auc = auc_ovr(spark, df, truth, probs, len(classes)).where("class_index = -1")
    return long.unionByName(auc.select(F.lit(model).alias("model"), F.lit("auc").alias("metric"),
                                       F.lit(7).cast("bigint").alias("metric_order"), F.col("auc").alias("value")))
