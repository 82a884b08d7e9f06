"""One-pass support vector machines against slow solvers of the same objective."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from outcomelab.operators import kernel_svm as ks
from outcomelab.operators import metrics, ordered

import synthetic
from conftest import SF001

K = 3


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(90, 2))
    y = (x[:, 0] + 0.4 * rng.normal(size=90) > 0).astype(int) + (x[:, 1] > 1.1)
    cat = [None if k % 17 == 0 else "uvw"[k % 3] for k in range(90)]
    return [(int(k), float(a), float(b), c, int(t), int(k % 3)) for k, ((a, b), c, t) in enumerate(zip(x, cat, y))]


SCHEMA = "id long, a double, b double, cat string, y int, fold int"


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(3).cache()


def _loss(v, z, s, w, lam):
    u = 1 - s * (z @ v)
    a = np.clip(u / ks.DELTA, 0, 1)
    return (w * (a * u - ks.DELTA / 2 * a * a)).sum() + lam / 2 * v @ v, -z.T @ (w * a * s) + lam * v


def _slow(z, s, w, lam, steps=60_000):
    """Accelerated gradient steps to the optimum."""
    top = np.linalg.eigvalsh((z * w[:, None]).T @ z)[-1] / ks.DELTA + lam
    beta = (1 - np.sqrt(lam / top)) / (1 + np.sqrt(lam / top))
    v = m = np.zeros(z.shape[1])
    for _ in range(steps):
        new = m - _loss(m, z, s, w, lam)[1] / top
        m, v = new + beta * (new - v), new
    return v


def _design(data, gamma=None, kernel=None):
    x = np.array([r[1:3] for r in data])
    z = (x - x.mean(0)) / x.std(0)
    cats = sorted({r[3] for r in data if r[3]}, key=lambda c: (-sum(r[3] == c for r in data), c))
    if gamma is None:
        hot = np.array([[float(r[3] == c) for c in cats] for r in data])
        return np.hstack([z, hot, np.ones((len(z), 1))])
    t = ks.TrainingSet("", -1, gamma, x.mean(0), x.std(0), np.ones(K))
    seen = sorted({r[3] for r in data if r[3]})
    code = np.array([seen.index(r[3]) if r[3] else -1 for r in data])
    return kernel.design(x, kernel.prepare(seen, code, None), (code >= 0).astype(float), t).z


@pytest.mark.parametrize("gamma", [None, 0.2])
@pytest.mark.parametrize("route", ["newton", "lbfgs"])
def test_fit_is_the_optimum(spark, data, frame, gamma, route, monkeypatch):
    if route == "lbfgs":
        monkeypatch.setattr(ks, "NEWTON_WIDTH", 0)
    gap = 1e-9 if route == "newton" else 1e-5
    model = ks.fit_one(spark, frame, ["a", "b"], "cat", "y", K, 2.0, gamma, n_features=12, gap=gap, max_steps=2000)
    assert -1e-12 <= model.gap <= gap
    z = _design(data, gamma, model.kernel)
    y = np.array([r[4] for r in data])
    w = (len(y) / (K * np.bincount(y, minlength=K)))[y] / len(y)
    for c in range(K):
        s, lam = np.where(y == c, 1.0, -1.0), 1 / (2.0 * len(y))
        best = _loss(_slow(z, s, w, lam), z, s, w, lam)[0]
        mine = _loss(model.coef[:, c], z, s, w, lam)[0]
        # the gap bounds the distance to the optimum
        assert best - 1e-9 <= mine <= best + gap + 1e-9
    pred = model.transform(frame).orderBy("id").collect()
    assert np.allclose([r.rawPrediction for r in pred], z @ model.coef, atol=1e-9)
    assert [r.prediction for r in pred] == list((z @ model.coef).argmax(1))


def test_repeated_rows_count(spark, data, frame):
    fit = lambda df: ks.fit_one(spark, df, ["a", "b"], "cat", "y", K, 1.0, gap=1e-10)
    one = fit(frame.repartition(9))
    # three times every row is the same objective under a third of the C
    three = ks.fit_one(spark, frame.unionByName(frame).unionByName(frame), ["a", "b"], "cat", "y", K, 1 / 3, gap=1e-10)
    assert np.allclose(one.coef, three.coef, atol=1e-6)


def test_many_partial_sums(spark, frame, monkeypatch):
    want = ks.fit_one(spark, frame, ["a", "b"], "cat", "y", K, 1.0, gap=1e-10).coef
    monkeypatch.setattr(ks, "TASK_ENTRIES", 8)
    monkeypatch.setattr(ks, "TASKS_PER_CORE", 4)
    monkeypatch.setattr(ks, "LOT", 3)
    assert np.allclose(want, ks.fit_one(spark, frame, ["a", "b"], "cat", "y", K, 1.0, gap=1e-10).coef, atol=1e-6)


def _macro_f1(y, p):
    out = []
    for c in range(K):
        tp, n = ((y == c) & (p == c)).sum(), (y == c).sum() + (p == c).sum()
        if n:
            out.append(2 * tp / n)
    return np.mean(out)


def test_grid_equals_one_fit_at_a_time(spark, data, frame):
    cs, gammas = (0.5, 4.0), (0.0,)
    table, fit = ks.grid_search(spark, frame, ["a", "b"], "cat", "y", K, cs, gammas, "fold", 3, n_features=10, gap=1e-9)
    assert len(fit.sets) == 3 and max(g.max() for g in fit.gaps) <= 1e-9
    want = []
    for c in cs:
        for g in gammas:
            scores = []
            for f in range(3):
                m = ks.fit_one(spark, frame.where(F.col("fold") != f), ["a", "b"], "cat", "y", K, c, g, n_features=10, gap=1e-9)
                got = m.transform(frame.where(F.col("fold") == f)).select("y", "prediction").collect()
                scores.append(_macro_f1(np.array([r.y for r in got]), np.array([r.prediction for r in got])))
            want.append((c, ks.width_name(g), np.mean(scores), np.std(scores)))
    rows = table.collect()
    got = {(r.c, r.gamma): (r.mean_score, r.std_score) for r in rows}
    for c, g, mean, std in want:
        assert np.allclose(got[(c, g)], (mean, std), atol=1e-12)
    assert [r.rank for r in rows] == [1, 2]
    assert [r.mean_score for r in rows] == sorted((r.mean_score for r in rows), reverse=True)


def test_groups_and_their_minimum(spark, frame):
    sizes = {r["cat"]: r["n"] for r in frame.groupBy("cat").agg(F.count("*").alias("n")).collect()}
    least = max(n for c, n in sizes.items() if c)
    dealt = frame.withColumn("part", (F.floor(F.col("id") / 3) % 3).cast("int"))  # fold is the category's own number
    out = ks.group_scores(spark, dealt, "cat", ["u", "v", "w", "none"], ["a", "b"], None, "y", K, 0.5, 0.1, "part", 3,
                          min_rows=least, n_features=8).collect()
    for r in out:
        n = sizes.get(r.cat, 0)
        assert r.n_rows == n and (r.mean_score is None) == (n < least)
    assert any(r.mean_score is not None for r in out) and out[-1].n_rows == 0


def test_bad_rows_and_unseen_categories(spark, data, frame):
    bad = spark.createDataFrame([(900, None, 1.0, "u", 0, 0), (901, float("nan"), 1.0, "u", 1, 0), (902, 1.0, 1.0, "u", None, 0)], SCHEMA)
    fit = lambda df: ks.fit_one(spark, df, ["a", "b"], "cat", "y", K, 1.0, 0.1, n_features=8, gap=1e-10)
    clean = fit(frame.unionByName(bad))
    assert clean.set.counts.sum() == 90
    new = spark.createDataFrame([(1, 0.3, 0.2, "never", 0, 0), (2, 0.3, 0.2, None, 0, 0)], SCHEMA)
    a, b = clean.transform(new).orderBy("id").collect()
    assert a.rawPrediction == b.rawPrediction
    with pytest.raises(ValueError):
        fit(frame.limit(0))


def test_many_categories_take_the_sparse_route(spark):
    df = spark.range(3000).select(F.col("id"), (F.col("id") % 7).cast("double").alias("a"),
                                  F.concat(F.lit("c"), F.col("id") % 900).alias("cat"), (F.col("id") % 900 < 450).cast("int").alias("y"))
    model = ks.fit_one(spark, df, ["a"], "cat", "y", 2, 50.0, gap=0.02, max_steps=200)
    assert model.kernel.width == 902 > ks.NEWTON_WIDTH and model.gap <= 0.02
    hits = model.transform(df).where("prediction = y").count()
    assert hits > 2900


def test_learns_the_derived_outcomes(spark):
    """Beats the majority class on the outcome table derived from orders."""
    from outcomelab.functions import encode_label
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    rows = synthetic.outcome_table(orders).withColumn("label", encode_label(synthetic.TARGET, synthetic.CLASSES))
    train, test = rows.where("year <= 2022"), rows.where("year >= 2024")
    model = ks.fit_one(spark, train, synthetic.NUMERIC, synthetic.CATEGORICAL, "label", 5, 0.5, 0.01)
    f1 = metrics.metrics_summary(model.transform(test), "label", "prediction", [float(i) for i in range(5)]).first().macro_f1
    assert f1 > 2 * 0.8 / 1.8 / 5 + 0.1


def test_category_index_orders_by_frequency(spark, data, frame):
    got = [(r.category, r.n) for r in ordered.category_index(frame, "cat").orderBy("category_id").collect()]
    count = {}
    for r in data:
        if r[3]:
            count[r[3]] = count.get(r[3], 0) + 1
    assert got == sorted(count.items(), key=lambda x: (-x[1], x[0]))


def test_weighted_square_is_symmetric_and_leaves_rows_without_weight_out():
    rng = np.random.default_rng(5)
    z, w = rng.normal(size=(300, 40)), rng.random(300) * (rng.random(300) < 0.8)
    got = ks._Dense(z).square(w)
    assert (got == got.T).all() and np.allclose(got, (z * w[:, None]).T @ z, rtol=1e-12, atol=1e-12)
    z[w == 0] = np.nan
    assert np.isfinite(ks._Dense(z).square(w)).all()


def test_no_more_tasks_than_cores_send_sums(spark):
    # every task sends the sums of all machines
    assert ks.task_count(spark.range(1000), 1000, ks.TASK_ENTRIES) == spark.sparkContext.defaultParallelism


def test_other_folds_start_from_the_first(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(6000, 2))
    y = (x[:, 0] + 0.6 * rng.normal(size=6000) > 0).astype(int) + (x[:, 1] > 1.1)
    df = spark.createDataFrame([(k, float(a), float(b), "uvw"[k % 3], int(c), k % 3) for k, ((a, b), c) in enumerate(zip(x, y))],
                               SCHEMA).repartition(3).cache()
    passes, step = [], ks.step
    monkeypatch.setattr(ks, "step", lambda *a, **kw: (passes.append({i: x.copy() for i, x in a[6].items()}), step(*a, **kw))[1])
    cs = (0.5, 1.0)
    _, fit = ks.grid_search(spark, df, ["a", "b"], "cat", "y", K, cs, (0.0, 0.1), "fold", 3, n_features=20)
    assert len(fit.sets) == 6 and max(g.max() for g in fit.gaps) <= ks.GAP
    m = K * len(cs)
    assert sorted(passes[0]) == list(range(2 * m))  # both widths of the first fold
    for i in range(2 * m, 6 * m):
        first = next(p[i] for p in passes if i in p)
        s, c = divmod(i % (2 * m), m)
        assert np.array_equal(first, fit.coefs[s][:, c])


def test_a_wide_gap_holds_for_the_rounded_hinge(spark, data, frame):
    # features in single numbers, weights of a smooth hinge as the dual point
    model = ks.fit_one(spark, frame, ["a", "b"], "cat", "y", K, 2.0, 0.2, n_features=12, gap=2e-3)
    assert model.gap <= 2e-3
    z = _design(data, 0.2, model.kernel)
    y = np.array([r[4] for r in data])
    w = (len(y) / (K * np.bincount(y, minlength=K)))[y] / len(y)
    for c in range(K):
        s, lam = np.where(y == c, 1.0, -1.0), 1 / (2.0 * len(y))
        best = _loss(_slow(z, s, w, lam), z, s, w, lam)[0]
        assert best - 1e-6 <= _loss(model.coef[:, c], z, s, w, lam)[0] <= best + model.gap + 1e-6


def test_a_class_without_rows_ends_too(spark, frame, monkeypatch):
    passes, step = [], ks.step
    monkeypatch.setattr(ks, "step", lambda *a, **kw: (passes.append(list(a[6])), step(*a, **kw))[1])
    model = ks.fit_one(spark, frame, ["a", "b"], "cat", "y", K + 1, 1.0, gap=1e-9)
    assert model.gap <= 1e-9 and len(passes) < 80
    assert model.transform(frame).where(f"prediction = {K}").count() == 0
