"""Models over the labelled documents (sf0.01)."""

import numpy as np
from pyspark.sql import functions as F

from outcomelab.operators import features, metrics, resample, selection
from outcomelab.plans import modeling
from outcomelab.plans.outcomes import CATEGORICAL, CLASSES, NUMERIC, TARGET, labelled_documents

from conftest import SF01

ALL = [float(i) for i in range(len(CLASSES))]


def test_labelled_documents_edge_cases(spark):
    docs = spark.createDataFrame([(0, None, "en", "s"), (1, "", "en", None), (2, "One two! 12 #", "fr", "s"), (9, "x", "de", "t")],
                                 "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 1), (2, 1, 0), (2, 1, 1), (3, 1, 0), (None, 1, 1), (9, None, 0)],
                                   "doc_id long, quality int, toxic int")
    got = {r.row_id: r for r in labelled_documents(docs, labels).collect()}
    assert {k: r[TARGET] for k, r in got.items()} == {0: "good", 1: "poor toxic", 2: "good toxic"}
    assert got[0].log_chars == got[1].log_chars == 0 and got[0].digit_share == 0
    assert got[2].pct == 20 and abs(got[2].digit_share - 2 / 13) < 1e-12 and abs(got[2].capital_share - 1 / 13) < 1e-12


def test_models_beat_the_majority(spark):
    _, test = modeling.splits(spark, SF01)
    n = test.count()
    top = test.groupBy("label").count().agg(F.max("count")).first()[0]
    majority = (2 * top / (n + top)) / len(CLASSES)
    for kind in ("svc_ovr_weighted", "svc_rff", "logreg"):
        pred = modeling.predict(spark, SF01, kind)
        assert pred.count() == n
        assert metrics.metrics_summary(pred, "label", "prediction", ALL).first().macro_f1 > majority + 0.05


def test_whole_grid_and_its_winner(spark):
    rows = modeling.q_grid_search(spark, SF01).collect()
    assert len(rows) == len(modeling.GRID_C) * len(modeling.GRID_GAMMA) == 12
    assert all(r.n_folds == 5 and r.duality_gap <= modeling.GRID_GAP for r in rows)
    assert modeling.winner(spark, SF01)[0] == rows[0].c
    model = modeling.fitted(spark, SF01, "svc_rff")
    assert model.c == rows[0].c and (rows[0].gamma == "scale" or model.set.gamma == float(rows[0].gamma))


def test_every_model_has_all_metrics(spark):
    got = modeling.q_evaluate_models(spark, SF01).collect()
    assert len(got) == len(modeling.MODELS) * 8
    assert {r.metric for r in got} >= {"auc", "macro_f1", "kappa"}


def test_permutation_importance(spark):
    _, test = modeling.splits(spark, SF01)
    model = modeling.fitted(spark, SF01, "logreg")
    cols = list(NUMERIC) + [CATEGORICAL]
    imp = {r.feature: r.importance_mean for r in
           selection.permutation_importance(model, test, cols, "label", "row_id", len(CLASSES), repeats=2).collect()}
    assert set(imp) == set(cols) and max(imp.values()) > 0.01
    again = {r.feature: r.importance_mean for r in selection.permutation_importance(
        model, test.repartition(5), cols, "label", "row_id", len(CLASSES), repeats=2).collect()}
    assert imp == again


def test_partners_are_permutations(spark):
    df = spark.range(101).withColumnRenamed("id", "k").repartition(4)
    rows = resample.permutation_partners(df, "k", 5, 3).collect()
    assert len(rows) == 303
    for r in range(3):
        assert sorted(x.partner for x in rows if x.repeat == r) == list(range(101))
    assert len({tuple(x.partner for x in sorted(rows, key=lambda x: x.pos) if x.repeat == r) for r in range(3)}) == 3


def test_permuted_is_a_bijection():
    for n in (1, 2, 3, 10, 97, 5000):
        for key in (0, 7, 2 ** 59):
            assert sorted(resample.permuted(np.arange(n), n, key)) == list(range(n))


def test_predictions_wide_keeps_rows_and_columns(spark):
    _, test = modeling.splits(spark, SF01)
    wide = modeling.q_predictions_wide(spark, SF01)
    assert {"pred_svm_rbf", "pred_svm_linear", "pred_logreg", "row_id", TARGET} <= set(wide.columns)
    assert "features" not in wide.columns and "prediction" not in wide.columns and wide.count() == test.count()


def test_moments_far_from_zero(spark):
    rng = np.random.default_rng(1)
    x = np.c_[rng.normal(1e9, 1, 400), rng.normal(0, 1e-3, 400), np.full(400, 5.0)]
    x[:, 1] += 1e-3 * (x[:, 0] - 1e9)
    rows = [tuple(map(float, r)) for r in x] + [(None, 1.0, 1.0), (1.0, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(9)
    n, mean, co = features.assembled_moments(df, ["a", "b", "c"])
    assert n == 400 and np.allclose(mean, x.mean(0), rtol=1e-12)
    assert np.allclose(co, np.cov(x.T) * 399, rtol=1e-6, atol=1e-9)
    pca = features.Pca(df, ["a", "b", "c"])
    assert pca.eigenvalue[2] < 1e-9 and abs(pca.ratio.sum() - 1) < 1e-12
    scores = features.pca_scores(df, ["a", "b", "c"], [], 2, pca).where("pc1 is not null and not isnan(pc1)").agg(
        F.var_samp("pc1"), F.corr("pc1", "pc2")).first()
    assert abs(scores[0] - pca.eigenvalue[0]) < 1e-4 and abs(scores[1]) < 1e-3
    empty = features.Pca(df.limit(0), ["a", "b"])
    assert empty.n == 0 and list(empty.ratio) == [0.0, 0.0]
