"""Bindings for the classifiers and model selection, over the labelled
documents of ``plans.outcomes``.

The label is encoded in the fixed class order; rows whose label is outside it
are rejected before any fit. The first 80% of the id range train, the next
percent validates (unused, as in the analysis), the rest tests.

The balanced linear and RBF machines are fitted by ``operators.kernel_svm`` to
a stated duality gap; the unweighted arm and the logistic baseline by Spark ML.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelab.functions import decode_label, dense_array, encode_label, softmax
from outcomelab.operators import kernel_svm, metrics, models, prep, resample, scaling, selection
from outcomelab.operators.features import with_class_weights
from outcomelab.plans.outcomes import (CATEGORICAL, CLASSES, NUMERIC, TARGET, TEST_FIRST, TRAIN_LAST, VAL,
                                       stored_outcomes)
from outcomelab.plans.registry import query, rounded

K = len(CLASSES)
SEED = 42
# The grids of the analysis and the parameters it uses within groups.
GRID_C, GRID_GAMMA = (0.5, 1.0, 5.0, 10.0), (0.0, 0.01, 0.1)          # 0.0 = 'scale'
GROUP_C, GROUP_GAMMA = 0.5, 0.01
GRID_FOLDS, GROUP_FOLDS, REPEATS = 5, 5, 10
RFF_FEATURES = 200
SCALING_SIZES = (10_000, 100_000, 1_000_000)
GROUPS = ("en", "fr", "de", "es")
# A group needs this many training rows (the analysis: 200 of its 6,800).
GROUP_MIN_ROWS = 40
# Duality gaps, in units of the mean loss (at most 1 without a fit): of the
# grid, of the timed fits, and of models whose predictions another solver checks.
GRID_GAP, SWEEP_GAP, MODEL_GAP = 2e-3, 1e-2, 1e-9
MODEL_STEPS = 300
MODELS = (("svc_rff", "SVM (RBF approx.)"), ("svc_ovr_weighted", "SVM (linear)"),
          ("logreg", "Logistic (baseline)"), ("svc_ovr", "Spark LinearSVC"))

_FITTED: dict = {}
_GRIDS: dict = {}


def outcome_rows(spark, sf_dir) -> DataFrame:
    t = stored_outcomes(spark, sf_dir)
    t = t.withColumn("label", encode_label(TARGET, CLASSES)).filter(F.col("label").isNotNull())
    return prep.temporal_split(t, "pct", TRAIN_LAST, VAL, TEST_FIRST)


def splits(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    t = outcome_rows(spark, sf_dir)
    return t.filter(F.col("split") == "train"), t.filter(F.col("split") == "test")


def _key(spark, sf_dir, *more):
    return (spark.sparkContext.applicationId, sf_dir, *more)


def grid(spark, sf_dir):
    """(table, fit) of the full grid on stratified folds, once per application."""
    key = _key(spark, sf_dir)
    if key not in _GRIDS:
        train, _ = splits(spark, sf_dir)
        folded = resample.stratified_folds(train, "label", "row_id", GRID_FOLDS, seed=SEED)
        _GRIDS[key] = kernel_svm.grid_search(spark, folded, NUMERIC, CATEGORICAL, "label", K, GRID_C, GRID_GAMMA,
                                             "fold", GRID_FOLDS, RFF_FEATURES, SEED, GRID_GAP)
    return _GRIDS[key]


def winner(spark, sf_dir) -> tuple[float, float]:
    """C and width of the best candidate (0: 'scale')."""
    best = grid(spark, sf_dir)[0].where("rank = 1").first()
    return best["c"], 0.0 if best["gamma"] == "scale" else float(best["gamma"])


def spark_arm(train: DataFrame):
    """Unweighted LinearSVC one-vs-rest, whole vector scaled."""
    return models.fit_pipeline(models.prep_stages(NUMERIC, CATEGORICAL, scaling="all") + [
        models.linear_svc_ovr(reg_param=0.1, max_iter=100)], train)


def linear_arm(spark, train: DataFrame, gap: float = MODEL_GAP):
    """Class-balanced linear machines, C = 1."""
    return kernel_svm.fit_one(spark, train, NUMERIC, CATEGORICAL, "label", K, 1.0, gap=gap, max_steps=MODEL_STEPS)


def fitted(spark, sf_dir, kind: str):
    key = _key(spark, sf_dir, kind)
    if key in _FITTED:
        return _FITTED[key]
    train, _ = splits(spark, sf_dir)
    if kind == "svc_rff":        # the winner of the grid, refitted on all training rows
        c, gamma = winner(spark, sf_dir)
        model = kernel_svm.fit_one(spark, train, NUMERIC, CATEGORICAL, "label", K, c, gamma, RFF_FEATURES, SEED,
                                   GRID_GAP)
    elif kind == "svc_ovr_weighted":
        model = linear_arm(spark, train)
    else:
        rows = with_class_weights(train, "label", "weight").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = models.sized_for_fit(rows).persist(StorageLevel.MEMORY_AND_DISK)
            if kind == "svc_ovr":
                model = spark_arm(rows)
            elif kind == "logreg":
                model = models.fit_pipeline(
                    models.prep_stages(NUMERIC, CATEGORICAL, scaling="numeric")
                    + [models.logistic(c=1.0, weight_sum=float(rows.count()), max_iter=2000)], rows)
            else:
                raise ValueError(f"unknown model kind {kind!r}")
        finally:
            rows.unpersist()
    _FITTED[key] = model
    return model


def predict(spark, sf_dir, kind: str) -> DataFrame:
    _, test = splits(spark, sf_dir)
    return fitted(spark, sf_dir, kind).transform(test)


def _margins(df: DataFrame):
    """The margins as an array, whichever library they come from."""
    return F.col("rawPrediction") if df.schema["rawPrediction"].dataType.typeName() == "array" \
        else dense_array("rawPrediction")


def _prediction_table(spark, sf_dir, kind: str, col: str) -> DataFrame:
    p = predict(spark, sf_dir, kind)
    return p.select("row_id", TARGET, decode_label("prediction", CLASSES).alias(col))


@query("outcome_rows")
def q_outcome_rows(spark, sf_dir):
    """The labelled rows that all model keys read."""
    t = outcome_rows(spark, sf_dir)
    return rounded(t.select("row_id", F.col("pct").cast("bigint").alias("pct"), "lang", "source", *NUMERIC, TARGET,
                            F.col("label").cast("bigint").alias("label"), "split"))


@query("svc_ovr")
def q_svc_ovr(spark, sf_dir):
    return _prediction_table(spark, sf_dir, "svc_ovr", "pred_spark_linearsvc")


@query("svc_ovr_weighted")
def q_svc_ovr_weighted(spark, sf_dir):
    return _prediction_table(spark, sf_dir, "svc_ovr_weighted", "pred_svm_linear")


@query("svc_rff")
def q_svc_rff(spark, sf_dir):
    return _prediction_table(spark, sf_dir, "svc_rff", "pred_svm_rbf")


@query("logreg")
def q_logreg(spark, sf_dir):
    return _prediction_table(spark, sf_dir, "logreg", "pred_logreg")


@query("predictions_wide")
def q_predictions_wide(spark, sf_dir):
    """Every test column plus three models' predicted labels side by side:
    chained transforms with their own output columns, no positional join."""
    _, test = splits(spark, sf_dir)
    out = test.drop("label", "split", "pct")
    keep = list(out.columns)
    for kind, col in (("svc_rff", "pred_svm_rbf"), ("svc_ovr_weighted", "pred_svm_linear"),
                      ("logreg", "pred_logreg")):
        # each model appends its working columns; keep only its decoded
        # prediction, so the next model sees the input columns again
        scored = fitted(spark, sf_dir, kind).transform(out)
        out = scored.select(*keep, decode_label("prediction", CLASSES).alias(col))
        keep.append(col)
    return out


@query("model_predictions_sink")
def q_model_predictions_sink(spark, sf_dir):
    """Test rows with three models' predictions, written as Parquet,
    read back after the commit marker and compared by rows and digest: rows by
    class, and how many of them each model left without a label."""
    from outcomelab.session import scratch_path
    from outcomelab.sources import write_checked
    back = write_checked(q_predictions_wide(spark, sf_dir), scratch_path(spark, "predictions"))
    return back.groupBy(TARGET).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("row_id").alias("id_sum"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"without_{c}")
          for c in ("pred_svm_rbf", "pred_svm_linear", "pred_logreg")])


@query("method_comparison")
def q_method_comparison(spark, sf_dir):
    scored = [(name, predict(spark, sf_dir, kind)) for kind, name in MODELS]
    return rounded(selection.method_comparison(scored, "label", "prediction", [float(i) for i in range(K)]))


@query("evaluate_models")
def q_evaluate_models(spark, sf_dir):
    """All eight metrics of every model on the test rows, as (model, metric,
    value) rows; AUC from the softmax of the margins (NULL if a class is absent)."""
    out = None
    for kind, name in MODELS:
        p = predict(spark, sf_dir, kind)
        p = p.select("label", "prediction", softmax(_margins(p)).alias("probs")).persist(StorageLevel.MEMORY_AND_DISK)
        long = metrics.evaluation(spark, p, "label", "prediction", "probs", [float(i) for i in range(K)], name)
        out = long if out is None else out.unionByName(long)
    return rounded(out)


@query("auc_models")
def q_auc_models(spark, sf_dir):
    """OvR macro AUC of the Spark arm from softmax of its margins."""
    p = predict(spark, sf_dir, "svc_ovr")
    return rounded(metrics.auc_ovr(spark, p.withColumn("probs", softmax(_margins(p))), "label", "probs", K))


@query("grid_search")
def q_grid_search(spark, sf_dir):
    """The full grid (4 C x 3 widths, 5 folds) of the RBF model, ranked."""
    return rounded(grid(spark, sf_dir)[0])


@query("grid_certificate")
def q_grid_certificate(spark, sf_dir):
    """Every (fold, width, C, class) machine of the grid: rows and balanced
    weight of its class in the training folds, penalty, width, and whether its
    duality gap is within the stated one."""
    fit = grid(spark, sf_dir)[1]
    rows = []
    for s, t in enumerate(fit.sets):
        for c, cost in enumerate(fit.cs):
            for j in range(K):
                rows.append((t.held_out, kernel_svm.width_name(GRID_GAMMA[s % len(GRID_GAMMA)]), float(cost), CLASSES[j],
                             int(t.counts.sum()), int(t.counts[j]), float(t.weights[j]),
                             float(1e3 / (cost * t.counts.sum())), float(t.gamma),
                             bool(fit.gaps[s][c * K + j] <= GRID_GAP)))
    return rounded(spark.createDataFrame(
        rows, "fold int, gamma string, c double, class string, n_rows bigint, n_class bigint, class_weight double, "
              "penalty_e3 double, width double, certified boolean").withColumn("fold", F.col("fold").cast("bigint")))


@query("group_cv")
def q_group_cv(spark, sf_dir):
    """Within-language cross-validation of the RBF model at fixed parameters;
    training rows only, languages under the minimum not fitted."""
    train, _ = splits(spark, sf_dir)
    folded = resample.stratified_folds(train, "label", "row_id", GROUP_FOLDS, seed=SEED, by=["lang"])
    return rounded(kernel_svm.group_scores(
        spark, folded, "lang", GROUPS, NUMERIC, CATEGORICAL, "label", K, GROUP_C, GROUP_GAMMA, "fold", GROUP_FOLDS,
        GROUP_MIN_ROWS, RFF_FEATURES, SEED, MODEL_GAP, MODEL_STEPS))


@query("permutation_importance")
def q_permutation_importance(spark, sf_dir):
    _, test = splits(spark, sf_dir)
    model = fitted(spark, sf_dir, "svc_rff")
    return rounded(selection.permutation_importance(
        model, test, list(NUMERIC) + [CATEGORICAL], "label", "row_id", K, repeats=REPEATS, seed=SEED))


def timed_sweep(spark, sf_dir, sizes=SCALING_SIZES) -> DataFrame:
    """(n_rows, arm, status, seconds, distinct_rows, id_sum) of every size and arm."""
    train, _ = splits(spark, sf_dir)
    base = train.select("row_id", *NUMERIC, CATEGORICAL, "label")
    return scaling.scaling_curve(
        spark, base, "row_id", sizes,
        {"spark_linearsvc_ovr": spark_arm,
         "linear_svm_balanced": lambda df: linear_arm(spark, df, SWEEP_GAP)}, seed=SEED)


@query("scaling_curve")
def q_scaling_curve(spark, sf_dir):
    """The sweep over 10k, 100k and 1M rows: sizes, arms, status and the rows
    drawn; seconds are in the stored timings (``bench.py`` prints them)."""
    return timed_sweep(spark, sf_dir).drop("seconds")
