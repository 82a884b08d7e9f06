"""Bindings for feature preparation and PCA."""

from __future__ import annotations

from pyspark.sql import functions as F

from outcomelab.functions import differs_from
from outcomelab.operators import features, resample
from outcomelab.plans.registry import query, rounded
from outcomelab.sources import read_table

# Category left out of the one-hot fit, so that its rows are unseen.
UNSEEN_TYPE = "STANDARD"
EMB_DIM = 64
PCA_SAMPLE = 2000


@query("standardize")
def q_standardize(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return rounded(features.standardize(o, ["o_totalprice"]).select("o_orderkey", "o_totalprice_z"))


@query("one_hot")
def q_one_hot(spark, sf_dir):
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    model = features.one_hot_fit(part.filter(F.col("p_type") != UNSEEN_TYPE), "p_type", "type_ohe")
    enc = model.transform(part)
    pos = features.hot_position("type_ohe")
    return enc.select("p_partkey", "p_type", pos.alias("hot_index"),
                      F.when(pos.isNull(), F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("hot_count"))


@query("class_weights")
def q_class_weights(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return rounded(features.balanced_class_weights(o, "o_orderpriority"))


@query("gamma_scale")
def q_gamma_scale(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    return rounded(features.gamma_scale(e, "embedding"))


@query("pca_variance")
def q_pca_variance(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return rounded(features.pca_variance(spark, li, ["l_quantity", "l_extendedprice"]))


def _embedding_columns(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    cols = [f"e{i:02d}" for i in range(EMB_DIM)]
    wide = e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(c)
                                         for i, c in enumerate(cols)])
    return wide, cols


_PCA: dict = {}


def embedding_pca(spark, sf_dir) -> features.Pca:
    """Fitted once per application: the loadings and the scores share it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PCA:
        _PCA[key] = features.Pca(*_embedding_columns(spark, sf_dir))
    return _PCA[key]


@query("pca_scores")
def q_pca_scores(spark, sf_dir):
    wide, cols = _embedding_columns(spark, sf_dir)
    scores = features.pca_scores(wide, cols, ["vec_id", "label"], 2, embedding_pca(spark, sf_dir))
    # a readable scatter: an exact seeded sample of rows, flagged by class
    sample = resample.sample_exact(scores, "vec_id", PCA_SAMPLE, seed=42)
    return rounded(sample.withColumn("not_class0", differs_from("label", 0)))


@query("pca_loadings")
def q_pca_loadings(spark, sf_dir):
    wide, cols = _embedding_columns(spark, sf_dir)
    return rounded(features.pca_loadings(spark, wide, cols, 3, pca=embedding_pca(spark, sf_dir)))
