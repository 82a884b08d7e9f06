"""PCA properties and the kernel approximation on a non-linear class."""

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from outcomelab.functions import unit_draw
from outcomelab.operators import features, metrics, models
from outcomelab.plans import featureprep
from outcomelab.sources import read_table

from conftest import SF001


def test_pca_variance_sums_to_100(spark):
    li = read_table(spark, SF001, "lineitem")
    rows = features.pca_variance(spark, li, ["l_quantity", "l_extendedprice", "l_discount"]).collect()
    assert len(rows) == 3
    assert abs(rows[-1].cumulative_pct - 100.0) < 1e-9
    assert all(a.variance_pct >= b.variance_pct for a, b in zip(rows, rows[1:]))
    # z-scores: eigenvalues sum to d * n / (n - 1)
    n = li.count()
    assert abs(sum(r.eigenvalue for r in rows) - 3 * n / (n - 1)) < 1e-6


def test_pca_loadings_and_scores_shape(spark):
    load = featureprep.q_pca_loadings(spark, SF001)
    assert load.count() == featureprep.EMB_DIM * 3
    scores = featureprep.q_pca_scores(spark, SF001)
    n = read_table(spark, SF001, "embeddings").count()
    assert scores.count() == min(n, featureprep.PCA_SAMPLE)


def test_fourier_features_learn_a_disc(spark):
    # points in the square, class 1 inside a disc: not linearly separable
    df = (spark.range(2000)
          .select("id", (unit_draw(1, "id") * 2 - 1).alias("x"), (unit_draw(2, "id") * 2 - 1).alias("y"))
          .withColumn("label", ((F.col("x") ** 2 + F.col("y") ** 2) < 0.5).cast("double")))
    asm = models.prep_stages(["x", "y"], None, scaling="numeric")
    lin = Pipeline(stages=asm + [models.linear_svc_ovr(reg_param=0.001, max_iter=50,
                                                        parallelism=2)]).fit(df)
    rff = Pipeline(stages=asm + models.rff_svc(c=10.0, weight_sum=2000.0, gamma=0.5, n_features=100,
                                               max_iter=50, weight_col=None, parallelism=2)).fit(df)

    def acc(m):
        return metrics.metrics_summary(m.transform(df), "label", "prediction", [0.0, 1.0]).first().accuracy

    a_lin, a_rff = acc(lin), acc(rff)
    assert a_rff > 0.9 and a_rff > a_lin + 0.15
