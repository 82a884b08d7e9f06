"""Operators on hand-written tables with known answers."""

import math

import pytest
from pyspark.sql import functions as F

from outcomelab.functions.buckets import TIER_EDGES, TIER_LABELS
from outcomelab.functions import right_closed_bins
from outcomelab.operators import distribution, features, metrics, prep, rates, resample


def test_rate_by_key_null_key_dropped_null_target_in_denominator(spark):
    df = spark.createDataFrame([(1, "1st"), (1, None), (None, "1st"), (2, "2nd")], "k int, y string")
    got = {r.k: (r.n_rows, r.n_events, r.rate_pct)
           for r in rates.rate_by_key(df, "k", "y", "1st").collect()}
    assert got == {1: (2, 1, 50.0), 2: (1, 0, 0.0)}


def test_rate_by_key_top_is_by_key(spark):
    df = spark.createDataFrame([(k, "1st") for k in (5, 3, 9, 1)], "k int, y string")
    assert [r.k for r in rates.rate_by_key(df, "k", "y", "1st", n_top=2).collect()] == [1, 3]


def test_dense_grid_has_empty_cells(spark):
    df = spark.createDataFrame([(1.0, 1.0, "1st"), (3.0, 1.0, "2nd"), (7.0, 20.0, "1st"), (12.0, 12.0, None)],
                               "a double, b double, y string")
    g = rates.two_way_rate(df, right_closed_bins("a", TIER_EDGES, TIER_LABELS),
                           right_closed_bins("b", TIER_EDGES, TIER_LABELS), TIER_LABELS, "y", "1st",
                           row_labels=TIER_LABELS, min_support=1)
    rows = g.collect()
    assert len(rows) == 16
    empty = [r for r in rows if r.n == 0 and r.rate_pct is None]
    # cell (11th+, 11th+) has one row whose target is NULL: n = 0 but a rate of 0
    assert len(empty) == 12
    last = [r for r in rows if r.row_tier == "11th+" and r.col_tier == "11th+"][0]
    assert last.n == 0 and last.rate_pct == 0.0 and last.rate_pct_masked is None


def test_class_distribution_missing_class_zero(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "y string")
    got = [(r.y, r.n_rows, r.pct) for r in rates.class_distribution(df, "y", ["a", "b", "c"]).collect()]
    assert got == [("a", 2, 50.0), ("b", 1, 25.0), ("c", 0, 0.0)]


def test_boxplot_quantiles_interpolated(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 4, 8, 16, 3)], "v double")
    r = distribution.boxplot_stats(df, [], "v").first()
    assert (r.q1, r.median, r.q3) == (2.25, 3.5, 7.0)
    # fences 2.25 - 7.125 and 7 + 7.125: 16 is an outlier, whisker stops at 8
    assert r.whisker_high == 8.0 and r.whisker_low == 1.0 and r.n_outliers == 1


def test_population_std_in_guard(spark):
    df = spark.createDataFrame([("g", float(x)) for x in (1, 2, 3, 4)] + [("h", 1.0)], "k string, v double")
    got = {r.k: (r.mean_value, r.std_value) for r in rates.min_rows_guard(df, ["k"], "v", 2).collect()}
    assert abs(got["g"][1] - 1.118034) < 1e-6 and got["h"] == (None, 0.0)


def test_sentinel_recode(spark):
    df = spark.createDataFrame([(0,), (3,), (7,), (0,)], "g int")
    assert [r.g for r in prep.sentinel_recode(df, "g").collect()] == [8, 3, 7, 8]


def test_standardize_population(spark):
    df = spark.createDataFrame([(float(x), 5.0) for x in (1, 2, 3, 4)], "x double, c double")
    rows = features.standardize(df, ["x", "c"]).collect()
    assert abs(rows[0].x_z + 1.5 / 1.118033988749895) < 1e-12
    assert all(r.c_z == 0.0 for r in rows)


def test_folds_balanced_and_partition_independent(spark):
    df = spark.range(1000).withColumn("cls", (F.col("id") % 3).cast("string"))
    a = resample.stratified_folds(df.repartition(1), "cls", "id", 5, n_buckets=1)
    b = resample.stratified_folds(df.repartition(4), "cls", "id", 5, n_buckets=7)
    assert sorted(a.collect()) == sorted(b.collect())
    sizes = a.groupBy("cls", "fold").count().groupBy("cls").agg(
        (F.max("count") - F.min("count")).alias("spread")).collect()
    assert all(r.spread <= 1 for r in sizes)


def test_bootstrap_exact_size_and_permutation(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    boot = resample.bootstrap_resample(spark, df, "k", 1234, seed=7)
    assert boot.count() == 1234 and boot.select("draw_id").distinct().count() == 1234
    pairs = resample.permutation_pairs(df, "k", 3, n_buckets=3)
    assert pairs.count() == 500 and pairs.select("partner").distinct().count() == 500


def test_sample_exact(spark):
    df = spark.range(300).withColumnRenamed("id", "k")
    assert resample.sample_exact(df, "k", 50).count() == 50
    assert resample.sample_exact(df, "k", 1000).count() == 300
    assert resample.sample_exact(df, "k", 0).count() == 0


def test_sample_exact_over_buckets_equals_top_k(spark, monkeypatch):
    from outcomelab.functions import hash_draw
    monkeypatch.setattr(resample.bucket_count, "__defaults__", (7,))
    df = spark.range(300).withColumnRenamed("id", "k")
    for n in (1, 50, 137, 299):
        want = df.orderBy(hash_draw(42, "k"), "k").limit(n).collect()
        assert sorted(resample.sample_exact(df, "k", n).collect()) == sorted(want)


def test_fold_fits_are_weighted_within_their_training_rows(spark):
    """The sum of the weights equals the training rows in every fold of every group."""
    from pyspark.ml.evaluation import Evaluator
    from outcomelab.operators import selection
    df = spark.range(600).select("id", F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"),
                                 F.when(F.col("id") % 7 == 0, 1.0).otherwise(0.0).alias("label"))
    seen = []

    def stages(train):
        r = train.agg(F.sum("weight"), F.count(F.lit(1))).first()
        seen.append((r[0], r[1]))
        return []

    class One(Evaluator):
        def _evaluate(self, dataset):
            return 1.0

    out = selection.group_cv(spark, df, "g", ["a", "b", "none"], stages, "label", "id", 4, One(), min_rows=10,
                             weigh=lambda t: features.with_class_weights(t, "label")).collect()
    assert [(r.g, r.n_rows, r.mean_score) for r in out] == [("a", 200, 1.0), ("b", 400, 1.0), ("none", 0, None)]
    assert len(seen) == 8 and all(abs(w - n) < 1e-6 for w, n in seen)
    assert min(n for _, n in seen) >= 148


CLASSES = ["a", "b", "c"]


def _pred(spark, pairs):
    return spark.createDataFrame(pairs, "t string, p string")


def test_metrics_perfect_constant_empty(spark):
    perfect = metrics.metrics_summary(_pred(spark, [(c, c) for c in "abcab"]), "t", "p", CLASSES).first()
    assert perfect.accuracy == 1.0 and perfect.macro_f1 == 1.0 and perfect.kappa == 1.0
    const = metrics.metrics_summary(_pred(spark, [(c, "a") for c in "abcab"]), "t", "p", CLASSES).first()
    assert const.kappa == 0.0
    # class c never predicted: precision 0/0 -> 0
    rep = {r["class"]: r for r in metrics.class_report(_pred(spark, [(c, "a") for c in "abcab"]),
                                                       "t", "p", CLASSES).collect()}
    assert rep["c"].precision == 0.0 and rep["c"].support == 1


def test_kappa_null_when_single_class(spark):
    r = metrics.metrics_summary(_pred(spark, [("a", "a")] * 3), "t", "p", CLASSES).first()
    assert r.kappa is None and r.accuracy == 1.0


def test_confusion_total_and_normalized(spark):
    df = _pred(spark, [("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")])
    cm = metrics.confusion_matrix(df, "t", "p", CLASSES)
    assert cm.count() == 9 and cm.agg(F.sum("n")).first()[0] == 4
    rows = {(r.true_label, r.pred_label): r.row_share for r in metrics.confusion_normalized(cm).collect()}
    assert rows[("a", "a")] == 0.5 and rows[("c", "a")] == 1.0


def test_auc_ties_half(spark):
    df = spark.createDataFrame([(0.0, [0.5, 0.5]), (1.0, [0.5, 0.5]), (0.0, [0.5, 0.5]), (1.0, [0.5, 0.5])],
                               "label double, probs array<double>")
    got = {r.class_index: r.auc for r in metrics.auc_ovr(spark, df, "label", "probs", 2).collect()}
    assert got == {0: 0.5, 1: 0.5, -1: 0.5}


def test_auc_missing_class_is_null(spark):
    df = spark.createDataFrame([(0.0, [0.9, 0.1]), (0.0, [0.2, 0.8])], "label double, probs array<double>")
    got = {r.class_index: r.auc for r in metrics.auc_ovr(spark, df, "label", "probs", 2).collect()}
    assert got[-1] is None


def test_one_hot_unseen_and_null_all_zero(spark):
    fit = spark.createDataFrame([("x",), ("y",), ("x",)], "c string")
    model = features.one_hot_fit(fit, "c", "o")
    df = spark.createDataFrame([("x",), ("y",), ("z",), (None,), ("x",)], "c string")
    got = [r.h for r in model.transform(df).select(features.hot_position("o").alias("h")).collect()]
    assert got == [0, 1, None, None, 0]


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(0.0,)] * 3 + [(1.0,)], "label double")
    got = {r.label: r.class_weight for r in features.balanced_class_weights(df, "label").collect()}
    assert math.isclose(got[0.0], 4 / 6) and math.isclose(got[1.0], 2.0)
    w = features.with_class_weights(df, "label").agg(F.sum("weight")).first()[0]
    assert math.isclose(w, 4.0)


def test_draw_rank_skewed_class_equals_single_window(spark):
    """Brute force: one class holds 80% of the rows; bucketed positions equal
    one row_number() over the whole class."""
    from pyspark.sql import Window
    from outcomelab.functions import hash_draw
    df = spark.range(3000).withColumn(
        "cls", F.when(F.col("id") % 5 == 0, F.lit("cold")).otherwise(F.lit("hot")))
    got = resample.draw_rank(df, 9, "id", by=["cls"], out="pos", n_buckets=13)
    w = Window.partitionBy("cls").orderBy(hash_draw(9, "id"), "id")
    want = df.withColumn("pos", (F.row_number().over(w) - 1).cast("bigint"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_approximate_quartiles_close_to_exact(spark):
    df = spark.range(20000).select((F.col("id") % 3).alias("g"),
                                   (F.col("id") * 0.37 % 101).alias("v"))
    ex = {r.g: r for r in distribution.boxplot_stats(df, ["g"], "v").collect()}
    ap = {r.g: r for r in distribution.boxplot_stats(df, ["g"], "v", exact=False).collect()}
    for g in ex:
        assert ap[g].n == ex[g].n
        assert abs(ap[g].median - ex[g].median) < 0.5 and abs(ap[g].q3 - ex[g].q3) < 0.5
    med = {r.g: r.median_value for r in rates.group_median(df, ["g"], "v", exact=False).collect()}
    assert all(abs(med[g] - ex[g].median) < 0.5 for g in ex)


def test_auc_matches_pairwise_brute_force(spark):
    from outcomelab.functions import unit_draw
    k = 3
    df = spark.range(400).select(
        (F.col("id") % k).cast("double").alias("label"),
        F.array(*[F.round(unit_draw(f"s{j}", "id") + F.when(F.col("id") % k == j, 0.3).otherwise(0.0), 1)
                  for j in range(k)]).alias("probs"))
    got = {r.class_index: r.auc for r in metrics.auc_ovr(spark, df, "label", "probs", k).collect()}
    rows = df.collect()
    want = []
    for j in range(k):
        pos = [r.probs[j] for r in rows if r.label == j]
        neg = [r.probs[j] for r in rows if r.label != j]
        wins = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
        want.append(wins / (len(pos) * len(neg)))
        assert abs(got[j] - want[j]) < 1e-12
    assert abs(got[-1] - sum(want) / k) < 1e-12


@pytest.mark.parametrize("kind,scale,k", [("int", 1, 20), ("double", 1e7, 20), ("double", 1.0, 200), ("int", 1, 5)])
def test_confusion_compares_typed_values(spark, kind, scale, k):
    value = lambda c: (c * F.lit(scale)).cast(kind)
    df = spark.range(1000).select(value(F.col("id") % k).alias("t"), value((F.col("id") * 3) % k).alias("p"))
    got = metrics.confusion_matrix(df, "t", "p", [float(i) * scale for i in range(k)])
    rows = {(r.true_order, r.pred_order): r.n for r in got.collect()}
    assert len(rows) == k * k and sum(rows.values()) == 1000
    assert rows[1, 3 % k] == sum(1 for i in range(1000) if i % k == 1 and i * 3 % k == 3 % k)


def test_confusion_of_booleans(spark):
    df = spark.createDataFrame([(True, False), (True, True), (False, False)], "t boolean, p boolean")
    got = {(r.true_order, r.pred_order): r.n for r in metrics.confusion_matrix(df, "t", "p", [False, True]).collect()}
    assert got == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 1}


def test_whisker_stays_outside_the_box(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (10.0,), (10.0,)], "v double")
    r = distribution.boxplot_stats(df, [], "v").first()
    assert (r.q1, r.whisker_low, r.whisker_high, r.n_outliers) == (7.5, 7.5, 10.0, 1)


def test_gamma_scale_far_from_zero_nulls_and_constants(spark):
    from outcomelab.operators import features
    far = spark.createDataFrame([([1e8, 1e8 + 1],), ([1e8 + 2, 1e8 + 1],)], "x array<double>")
    r = features.gamma_scale(far, "x").first()
    assert abs(r.variance - 0.5) < 1e-9 and abs(r.gamma - 1.0) < 1e-9 and (r.n_values, r.dim) == (4, 2)
    some = spark.createDataFrame([([1.0, None],), ([3.0, 5.0],)], "x array<double>")
    r = features.gamma_scale(some, "x").first()
    assert r.n_values == 3 and abs(r.variance - 8 / 3) < 1e-12
    flat = spark.createDataFrame([([2.0, 2.0],)], "x array<double>")
    assert features.gamma_scale(flat, "x").first().gamma is None


def test_metrics_on_empty_predictions(spark):
    empty = spark.createDataFrame([], "t string, p string")
    r = metrics.metrics_summary(empty, "t", "p", CLASSES).first()
    assert r.n_rows == 0 and r.accuracy is None and r.kappa is None
    assert r.macro_f1 == 0.0 and r.weighted_f1 == 0.0
    cm = metrics.confusion_matrix(empty, "t", "p", CLASSES)
    assert cm.count() == 9 and cm.agg(F.sum("n")).first()[0] == 0
