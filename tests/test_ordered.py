"""Running sums over a total order against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from outcomelab.operators import metrics, ordered, rates


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    # a third of all rows in one group, ties, NULL group and NULL values
    out = [("hot", float(rng.randint(0, 9))) for _ in range(400)]
    out += [(rng.choice(["a", "b", None]), rng.choice([None, rng.uniform(-5, 5), 1.0])) for _ in range(800)]
    return out


def test_running_sums(spark, rows):
    df = spark.createDataFrame([(g, v, k) for k, (g, v) in enumerate(rows)], "g string, v double, k long").repartition(7)
    got = ordered.running(df, [F.col("g").asc_nulls_first(), F.col("k")], ["k"]).orderBy("pos").collect()
    want = sorted(((g is not None, g or "", k) for k, (g, _) in enumerate(rows)))
    assert [r.pos for r in got] == list(range(len(rows)))
    assert [r.k for r in got] == [k for *_, k in want]
    before = 0
    for r in got:
        assert r.k_before == before
        before += r.k


def test_running_empty(spark):
    df = spark.createDataFrame([], "k long")
    assert ordered.running(df, [F.col("k")], ["k"]).collect() == []


def test_exact_quantiles(spark, rows):
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    qs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r.g: (r.n, r.q) for r in ordered.exact_quantiles(df, ["g"], "v", qs).collect()}
    for g in ("hot", "a", "b", None):
        values = [v for x, v in rows if x == g and v is not None]
        assert got[g][0] == len(values)
        assert np.allclose(got[g][1], np.quantile(values, qs))
    whole = ordered.exact_quantiles(df, [], "v", [0.5]).first()
    assert np.isclose(whole.q[0], np.median([v for _, v in rows if v is not None]))


def test_group_median_without_values(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1.0), ("b", 4.0), (None, 7.0)], "g string, v double")
    got = {r.g: (r.median_value, r.n_rows) for r in rates.group_median(df, ["g"], "v").collect()}
    assert got == {"a": (None, 2), "b": (2.5, 2)}


def _auc(y, s, w):
    good = sum(wi * wj * ((si > sj) + 0.5 * (si == sj)) for yi, si, wi in zip(y, s, w) if yi
               for yj, sj, wj in zip(y, s, w) if not yj)
    return good / (sum(wi for yi, wi in zip(y, w) if yi) * sum(wi for yi, wi in zip(y, w) if not yi))


@pytest.mark.parametrize("weight", [None, "w"])
def test_auc_of_all_classes(spark, weight):
    rng = random.Random(9)
    data = [(rng.choice([0, 1, 2, None]), [rng.randint(0, 6) / 6 for _ in range(4)], rng.choice([0.5, 1.0, 2.0])) for _ in range(150)]
    df = spark.createDataFrame(data, "y int, s array<double>, w double").repartition(6)
    got = {r.class_index: r.auc for r in metrics.auc_ovr(spark, df, "y", "s", 4, weight).collect()}
    known = [(y, s, w) for y, s, w in data if y is not None]
    for c in range(3):
        want = _auc([y == c for y, *_ in known], [s[c] for _, s, _ in known], [w if weight else 1.0 for *_, w in known])
        assert abs(got[c] - want) < 1e-12
    assert got[3] is None and got[-1] is None
    assert {r.class_index: r.auc for r in metrics.auc_ovr(spark, df.where("y < 3").limit(0), "y", "s", 2).collect()} == {
        0: None, 1: None, -1: None}


def test_a_million_categories(spark):
    n = 1_000_000
    df = spark.range(n).select(F.concat(F.lit("c"), F.col("id")).alias("cat")).unionByName(
        spark.range(30).select(F.when(F.col("id") < 20, "c777").when(F.col("id") < 29, "z").alias("cat")))
    index = ordered.category_index(df, "cat")
    top = index.where("category_id < 3").orderBy("category_id").collect()
    assert [(r.category, r.n) for r in top] == [("c777", 21), ("z", 9), ("c0", 1)]
    r = index.agg(F.count("*"), F.count_distinct("category_id"), F.min("category_id"), F.max("category_id")).first()
    assert tuple(r) == (n + 1, n + 1, 0, n)
    joined = df.join(index, df["cat"] == index["category"], "left").where("category_id is null")
    assert joined.count() == 1  # the NULL category
