"""Model selection: grid search with cross-validation, within-group
cross-validation, permutation importance, method comparison.

Fits are Spark ML fits; ``parallelism`` runs candidate fits as concurrent
Spark jobs. Scores are macro-F1 from one distributed aggregate per
evaluation.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomelab.operators import metrics, resample


class MacroF1Evaluator(Evaluator, HasLabelCol, HasPredictionCol):
    """Macro-F1 over numeric class indices 0..k-1.

    ``fixed_labels=False`` averages over the classes that occur in truth or
    prediction (the cross-validation scorer); ``True`` over all k classes.
    """

    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction",
                 num_classes: int = 5, fixed_labels: bool = False):
        super().__init__()
        self._set(labelCol=labelCol, predictionCol=predictionCol)
        self.num_classes = num_classes
        self.fixed_labels = fixed_labels

    def _evaluate(self, dataset: DataFrame) -> float:
        classes = [float(i) for i in range(self.num_classes)]
        fn = metrics.metrics_summary if self.fixed_labels else metrics.macro_f1_present
        row = fn(dataset, self.getLabelCol(), self.getPredictionCol(), classes).first()
        return float(row["macro_f1"] or 0.0)

    def isLargerBetter(self) -> bool:
        return True


def fold_scores(spark: SparkSession, candidates: Sequence[tuple[DataFrame, Pipeline | Callable]],
                fold_col: str, n_folds: int, evaluator: Evaluator,
                parallelism: int | None = None, weigh=None) -> DataFrame:
    """Score every (candidate, fold) pair: fit on the other folds, evaluate
    on the held-out fold.

    All pairs run as concurrent Spark jobs from a thread pool (the
    mechanism of ``CrossValidator(parallelism=...)``, but across folds and
    candidates too): iterative fits are latency-bound, so concurrency is
    what fills the cluster. Each task fits its own copy of the pipeline; a
    function in its place builds the estimator from the training rows.
    ``weigh`` adds the weights to the training rows of each fold. Returns (candidate, fold, score) rows.
    """
    from concurrent.futures import ThreadPoolExecutor

    tasks = [(c, f) for c in range(len(candidates)) for f in range(n_folds)]
    if parallelism is None:
        # every pair at once on a large cluster; at least 8 threads locally
        parallelism = min(len(tasks), max(8, spark.sparkContext.defaultParallelism))

    def run(task):
        c, f = task
        data, pipe = candidates[c]
        train = data.filter(F.col(fold_col) != F.lit(f))
        valid = data.filter(F.col(fold_col) == F.lit(f))
        if weigh is not None:
            train = weigh(train)
        model = (pipe(train) if callable(pipe) else pipe.copy()).fit(train)
        return c, f, float(evaluator.evaluate(model.transform(valid)))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        rows = list(pool.map(run, tasks))
    return spark.createDataFrame(rows, "candidate bigint, fold bigint, score double")


def summarize_folds(scores: DataFrame) -> DataFrame:
    """Mean and population std of the fold scores per candidate."""
    return scores.groupBy("candidate").agg(F.avg("score").alias("mean_score"),
                                           F.stddev_pop("score").alias("std_score"),
                                           F.count(F.lit(1)).alias("n_folds"))


def grid_search(spark: SparkSession, train: DataFrame, stages: list, param_maps: list,
                param_names: Sequence[str], fold_col: str, n_folds: int,
                evaluator: Evaluator, parallelism: int | None = None, refit: bool = True):
    """Cross-validated grid search over ``param_maps`` on fixed folds
    (``fold_col`` from ``resample.stratified_folds``), then a refit of the
    best candidate on all of ``train``.

    Returns (best PipelineModel or None, table of parameters, mean and
    population std of the fold scores, rank; ties rank by grid order).
    """
    base = Pipeline(stages=stages)
    cands = [(train, base.copy(pm)) for pm in param_maps]
    summary = {r["candidate"]: (r["mean_score"], r["std_score"]) for r in
               summarize_folds(fold_scores(spark, cands, fold_col, n_folds, evaluator,
                                           parallelism)).collect()}
    rows = []
    for i, pm in enumerate(param_maps):
        vals = [str(pm[p]) for p in pm]
        rows.append((i, *vals, float(summary[i][0]), float(summary[i][1])))
    ordered = sorted(rows, key=lambda r: (-r[-2], r[0]))
    ranked = [(rank + 1, *r) for rank, r in enumerate(ordered)]
    schema = ("rank bigint, grid_index bigint, " + ", ".join(f"{n} string" for n in param_names)
              + ", mean_score double, std_score double")
    best = base.copy(param_maps[ordered[0][0]]).fit(train) if refit else None
    return best, spark.createDataFrame(ranked, schema)


def group_cv(spark: SparkSession, df: DataFrame, group_col: str, groups: Sequence[str],
             stages_for, class_col: str, id_col: str, n_folds: int, evaluator: Evaluator,
             min_rows: int = 200, seed: int = 42, parallelism: int | None = None,
             weigh=None) -> DataFrame:
    """Cross-validation inside each group with fixed parameters.

    A group with fewer than ``min_rows`` rows is not fitted and reports
    mean NULL, std 0. ``stages_for(train_df)`` builds the stages from the
    training rows of a fold (so that penalties follow their number), and
    ``weigh(train_df)`` adds weights that are balanced within them. Folds are stratified by class
    within the group; all (group, fold) fits run concurrently. One row per
    group, in the given order.
    """
    # sizes of the requested groups only: the collected rows are bounded by
    # the ``groups`` parameter, not by the data
    sizes = {r[group_col]: r["n"] for r in
             df.filter(F.col(group_col).isin(*[F.lit(g) for g in groups]))
             .groupBy(group_col).agg(F.count(F.lit(1)).alias("n")).collect()}
    from outcomelab.operators.models import sized_for_fit
    folded = sized_for_fit(resample.stratified_folds(df, class_col, id_col, n_folds, seed=seed,
                                                     by=[group_col])).persist()
    try:
        fitted_groups = [g for g in groups if int(sizes.get(g, 0)) >= min_rows]
        cands = []
        for g in fitted_groups:
            cands.append((folded.filter(F.col(group_col) == F.lit(g)),
                          lambda train: Pipeline(stages=stages_for(train))))
        summary = {}
        if cands:
            for r in summarize_folds(fold_scores(spark, cands, "fold", n_folds, evaluator,
                                                 parallelism, weigh)).collect():
                summary[fitted_groups[r["candidate"]]] = (r["mean_score"], r["std_score"])
    finally:
        folded.unpersist()
    out = []
    for i, g in enumerate(groups):
        n = int(sizes.get(g, 0))
        m, s = summary.get(g, (None, 0.0))
        out.append((g, i, n, m, s))
    return spark.createDataFrame(
        out, f"{group_col} string, group_order bigint, n_rows bigint, mean_score double, std_score double")


def permutation_importance(model, df: DataFrame, feature_cols: Sequence[str], label_col: str,
                           id_col: str, num_classes: int, repeats: int = 10, seed: int = 42,
                           pred_col: str = "prediction") -> DataFrame:
    """Drop in macro-F1 when one feature column is permuted, mean and
    population std over ``repeats`` permutations, ascending by mean.

    Rows get dense positions once; a repeat's permutation is a keyed bijection
    of positions (``resample.permutation_partners``), and one join brings every
    row its partners' values. The rows are then replicated once per feature
    with that feature swapped, scored in a single ``transform`` together with
    the rows as they are, and summarised by one aggregate.
    """
    classes = [float(i) for i in range(num_classes)]
    feats = list(feature_cols)
    src = df.select(id_col, label_col, *feats).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        paired = resample.permutation_partners(src, id_col, seed, repeats).persist(StorageLevel.MEMORY_AND_DISK)
        values = (paired.where("repeat = 0")
                  .select(F.col("pos").alias("_at"), *[F.col(f).alias(f"_p_{i}") for i, f in enumerate(feats)]))
        pairs = paired.join(values, F.col("partner") == F.col("_at"))
        swapped = F.explode(F.array(*[
            F.struct(F.lit(f).alias("_feature"),
                     *[(F.col(f"_p_{j}") if g == f else F.col(g)).alias(g) for j, g in enumerate(feats)])
            for f in feats]))
        long = (pairs.select(label_col, F.col("repeat").alias("_repeat"), swapped.alias("_v"))
                .select(label_col, "_repeat", "_v.*"))
        whole = src.select(label_col, F.lit(-1).alias("_repeat"), F.lit(None).cast("string").alias("_feature"), *feats)
        per = metrics.macro_f1_present(model.transform(long.unionByName(whole)), label_col, pred_col, classes,
                                       by=["_repeat", "_feature"]).collect()
    finally:
        src.unpersist()
    # repeats x features + 1 scores
    base = next((float(r["macro_f1"]) for r in per if r["_repeat"] == -1 and r["macro_f1"] is not None), 0.0)
    out = []
    for f in feats:
        drops = [base - float(r["macro_f1"]) for r in per if r["_feature"] == f]
        mean = sum(drops) / len(drops) if drops else 0.0
        out.append((f, mean, (sum((x - mean) ** 2 for x in drops) / max(len(drops), 1)) ** 0.5))
    out.sort(key=lambda r: (r[1], r[0]))
    return df.sparkSession.createDataFrame(out, "feature string, importance_mean double, importance_std double")


def method_comparison(scored: Sequence[tuple[str, DataFrame]], truth: str, pred: str,
                      classes: Sequence) -> DataFrame:
    """(model, macro_f1, accuracy, ...) per scored test set; a union of
    one-row aggregates."""
    out = None
    for i, (name, df) in enumerate(scored):
        s = metrics.metrics_summary(df, truth, pred, classes).select(
            F.lit(name).alias("model"), F.lit(i).cast("bigint").alias("model_order"),
            "macro_f1", "accuracy", "kappa", "weighted_f1", "n_rows")
        out = s if out is None else out.unionByName(s)
    return out
