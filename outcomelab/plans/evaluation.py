"""Bindings for resampling, scores and metrics on the orders table.

Truth is the order priority (5 ordered classes). The "prediction" is a fixed
rule, class ``o_custkey % 5``, and the per-class scores are
``((o_custkey * (k + 1)) % 97) / 97`` passed through softmax; both are
deterministic, so every metric has an exact SQL twin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelab.functions import argmax, decode_label, encode_label, softmax
from outcomelab.operators import metrics, resample
from outcomelab.plans.registry import query, rounded
from outcomelab.plans.tables import PRIORITIES
from outcomelab.sources import read_table

K = len(PRIORITIES)
SEED = 42
FOLDS = 5
SAMPLE_N = 2000


def predicted_orders(spark, sf_dir) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderpriority",
                    decode_label(F.col("o_custkey") % K, PRIORITIES).alias("pred_priority"))


def scored_orders(spark, sf_dir) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    raw = F.array(*[((F.col("o_custkey") * (k + 1)) % 97).cast("double") / F.lit(97.0)
                    for k in range(K)])
    return o.select("o_orderkey", "o_orderpriority",
                    encode_label("o_orderpriority", PRIORITIES).alias("label"),
                    softmax(raw).alias("probs"))


@query("sample_exact")
def q_sample_exact(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return resample.sample_exact(o, "o_orderkey", SAMPLE_N, seed=SEED)


@query("bootstrap_resample")
def q_bootstrap_resample(spark, sf_dir):
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    n = part.count()
    return rounded(resample.bootstrap_resample(spark, part, "p_partkey", n, seed=SEED))


@query("stratified_folds")
def q_stratified_folds(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return resample.stratified_folds(o, "o_orderpriority", "o_orderkey", FOLDS, seed=SEED)


@query("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(predicted_orders(spark, sf_dir), "o_orderpriority",
                                    "pred_priority", PRIORITIES)


@query("confusion_normalized")
def q_confusion_normalized(spark, sf_dir):
    cm = metrics.confusion_matrix(predicted_orders(spark, sf_dir), "o_orderpriority",
                                  "pred_priority", PRIORITIES)
    return rounded(metrics.confusion_normalized(cm))


@query("class_report")
def q_class_report(spark, sf_dir):
    return rounded(metrics.class_report(predicted_orders(spark, sf_dir), "o_orderpriority",
                                        "pred_priority", PRIORITIES))


@query("metrics_summary")
def q_metrics_summary(spark, sf_dir):
    return rounded(metrics.metrics_summary(predicted_orders(spark, sf_dir), "o_orderpriority",
                                           "pred_priority", PRIORITIES))


@query("metrics_long")
def q_metrics_long(spark, sf_dir):
    s = metrics.metrics_summary(predicted_orders(spark, sf_dir), "o_orderpriority",
                                "pred_priority", PRIORITIES)
    return rounded(metrics.metrics_long(s, "custkey_rule"))


@query("softmax_scores")
def q_softmax_scores(spark, sf_dir):
    s = scored_orders(spark, sf_dir)
    cols = [F.col("probs")[k].alias(f"p{k}") for k in range(K)]
    total = F.aggregate("probs", F.lit(0.0), lambda a, x: a + x)
    return rounded(s.select("o_orderkey", *cols, total.alias("p_sum")))


@query("argmax_label")
def q_argmax_label(spark, sf_dir):
    s = scored_orders(spark, sf_dir)
    idx = argmax("probs")
    return s.select("o_orderkey", idx.cast("bigint").alias("pred_index"),
                    decode_label(idx, PRIORITIES).alias("pred_priority"))


# Scores for the AUC binding are taken at 9 decimals: softmax values that are
# equal in exact arithmetic (permuted margin vectors) differ in the last bit
# between two exp() implementations, which would turn ties into orderings.
SCORE_DIGITS = 9


@query("auc_ovr")
def q_auc_ovr(spark, sf_dir):
    s = scored_orders(spark, sf_dir).withColumn(
        "probs", F.transform("probs", lambda x: F.round(x, SCORE_DIGITS)))
    return rounded(metrics.auc_ovr(spark, s, "label", "probs", K))


@query("cv_summary")
def q_cv_summary(spark, sf_dir):
    folds = resample.stratified_folds(predicted_orders(spark, sf_dir), "o_orderpriority",
                                      "o_orderkey", FOLDS, seed=SEED)
    per_fold = metrics.macro_f1_present(folds, "o_orderpriority", "pred_priority",
                                        PRIORITIES, by=["fold"])
    return rounded(per_fold.agg(F.count(F.lit(1)).alias("n_folds"),
                                F.avg("macro_f1").alias("mean_score"),
                                F.stddev_pop("macro_f1").alias("std_score")))


REPORT_TITLE = "# metrics of custkey_rule over orders"
REPORTED = ("accuracy", "macro_f1", "weighted_f1")


@query("report_scrape")
def q_report_scrape(spark, sf_dir):
    """Write the metrics as text, a title and one ``name<TAB>value`` line each,
    to the shared scratch folder, read it back whole and scrape numbers after
    the title (a missing report or line gives NULL)."""
    from outcomelab.session import scratch_path
    from outcomelab.sources import read_text_log, scrape_metrics
    s = metrics.metrics_summary(predicted_orders(spark, sf_dir), "o_orderpriority",
                                "pred_priority", PRIORITIES)
    lines = [F.concat(F.lit(f"{name}\t"), F.format_number(name, 4)) for name in ("kappa", *REPORTED)]
    text = s.select(F.concat_ws("\n", F.lit(REPORT_TITLE), *lines).alias("value"))
    path = scratch_path(spark, "metrics-report")
    text.coalesce(1).write.mode("overwrite").text(path)
    return scrape_metrics(read_text_log(spark, path), REPORT_TITLE,
                          {name: rf"(?m)^{name}\t(-?[0-9.]+)$" for name in REPORTED}).select(*REPORTED)


@query("predictions_sink")
def q_predictions_sink(spark, sf_dir):
    """Predictions of the rule as (true, predicted) pairs, written as Parquet,
    read back after the commit marker and compared by rows and digest; the
    pairs read back are counted."""
    from outcomelab.session import scratch_path
    from outcomelab.sources import write_checked
    pairs = predicted_orders(spark, sf_dir).select(F.col("o_orderpriority").alias("true_label"),
                                                   F.col("pred_priority").alias("pred_label"))
    back = write_checked(pairs, scratch_path(spark, "pairs"))
    return back.groupBy("true_label", "pred_label").agg(F.count(F.lit(1)).alias("n_rows"))
