"""Classifiers on Spark ML: feature stages, linear SVM one-vs-rest,
balanced multinomial logistic regression, and an RBF-kernel approximation
by random Fourier features.

Every fit is a Spark ML fit (tree aggregates over cached vectors); the only
Python on the executors is the Fourier map, an Arrow-batched pandas UDF.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def prep_stages(numeric: Sequence[str], categorical: str | None, scaling: str = "numeric",
                out: str = "features") -> list:
    """Feature stages.

    ``scaling='numeric'``: z-score the numeric block only (centred), append
    the one-hot block untouched; other columns are dropped.
    ``scaling='all'``: assemble numeric + one-hot, then scale the whole
    vector by its std without centring (one-hots scaled too).
    Unseen or NULL categories give an all-zero one-hot block. Spark's scaler
    divides by the sample std (n-1); ``features.standardize`` is the
    population version.
    """
    stages, blocks = [], []
    if categorical:
        stages += [StringIndexer(inputCol=categorical, outputCol=f"{categorical}_idx",
                                 handleInvalid="keep"),
                   OneHotEncoder(inputCols=[f"{categorical}_idx"],
                                 outputCols=[f"{categorical}_ohe"], dropLast=True)]
        blocks = [f"{categorical}_ohe"]
    if scaling == "numeric":
        stages += [VectorAssembler(inputCols=list(numeric), outputCol="_num_raw"),
                   StandardScaler(inputCol="_num_raw", outputCol="_num_z", withMean=True, withStd=True),
                   VectorAssembler(inputCols=["_num_z"] + blocks, outputCol=out)]
    elif scaling == "all":
        stages += [VectorAssembler(inputCols=list(numeric) + blocks, outputCol="_raw",
                                   handleInvalid="keep"),
                   StandardScaler(inputCol="_raw", outputCol=out, withMean=False, withStd=True)]
    else:
        raise ValueError(scaling)
    return stages


def linear_svc_ovr(reg_param: float = 0.1, max_iter: int = 100, weight_col: str | None = None,
                   parallelism: int = 5, features: str = "features", label: str = "label",
                   tol: float = 1e-6) -> OneVsRest:
    """One binary linear SVM per class, arg-max of margins; the k fits run
    as ``parallelism`` concurrent Spark jobs. ``tol`` 1e-6 is Spark's
    default; the sklearn-equivalent arms pass 1e-4, sklearn's default."""
    svc = LinearSVC(featuresCol=features, labelCol=label, maxIter=max_iter,
                    regParam=reg_param, standardization=False, tol=tol)
    ovr = OneVsRest(classifier=svc, featuresCol=features, labelCol=label,
                    predictionCol="prediction", rawPredictionCol="rawPrediction",
                    parallelism=parallelism)
    if weight_col:
        ovr.setWeightCol(weight_col)
    return ovr


def svc_reg_param(c: float, weight_sum: float) -> float:
    """regParam matching C * sum(w * hinge) + |w|^2 / 2 when the loss is
    averaged by weight: 1 / (C * sum of weights)."""
    return 1.0 / (c * weight_sum)


def logistic(c: float = 1.0, weight_sum: float = 1.0, max_iter: int = 2000,
             weight_col: str | None = "weight", features: str = "features",
             label: str = "label") -> LogisticRegression:
    """Multinomial logistic regression with an L2 penalty equivalent to
    C * sum(w * logloss) + |w|^2 / 2."""
    lr = LogisticRegression(featuresCol=features, labelCol=label, family="multinomial",
                            maxIter=max_iter, regParam=1.0 / (c * weight_sum),
                            elasticNetParam=0.0, standardization=False)
    if weight_col:
        lr.setWeightCol(weight_col)
    return lr


# ---- random Fourier features -------------------------------------------------

class _RFFParams(HasInputCol, HasOutputCol, HasSeed):
    gamma = Param(Params._dummy(), "gamma", "RBF width; <= 0 means 'scale' (1 / (d var X))",
                  typeConverter=TypeConverters.toFloat)
    numFeatures = Param(Params._dummy(), "numFeatures", "number of Fourier features",
                        typeConverter=TypeConverters.toInt)

    def getGamma(self):
        return self.getOrDefault(self.gamma)

    def getNumFeatures(self):
        return self.getOrDefault(self.numFeatures)


class RandomFourierFeatures(Estimator, _RFFParams, DefaultParamsReadable, DefaultParamsWritable):
    """z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2 gamma), b ~ U(0, 2 pi)
    (Rahimi and Recht, 2007): a linear model on z approximates an RBF
    kernel machine. The fit reads d (and var X for gamma 'scale') in one
    aggregate and draws W, b from the seed on the driver (D x d numbers)."""

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="rff", gamma=0.0, numFeatures=200, seed=42):
        super().__init__()
        self._setDefault(gamma=0.0, numFeatures=200, seed=42)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "RandomFourierFeaturesModel":
        from outcomelab.operators.features import gamma_scale
        stats = gamma_scale(dataset, self.getInputCol()).first()
        d = int(stats["dim"])
        gamma = self.getGamma()
        if gamma <= 0:
            var = float(stats["variance"])
            gamma = 1.0 / (d * var) if var > 0 else 1.0
        rng = np.random.default_rng(self.getSeed())
        w = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(d, self.getNumFeatures()))
        b = rng.uniform(0.0, 2.0 * math.pi, size=self.getNumFeatures())
        m = RandomFourierFeaturesModel(w.tolist(), b.tolist(), gamma)
        m._set(inputCol=self.getInputCol(), outputCol=self.getOutputCol())
        return m


class RandomFourierFeaturesModel(Model, HasInputCol, HasOutputCol):
    def __init__(self, weights=None, offsets=None, gamma=None):
        super().__init__()
        self.weights, self.offsets, self.gamma_used = weights, offsets, gamma

    def _transform(self, dataset: DataFrame) -> DataFrame:
        w = np.asarray(self.weights, dtype=np.float64)
        b = np.asarray(self.offsets, dtype=np.float64)
        scale = math.sqrt(2.0 / w.shape[1])

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def fourier(xs: pd.Series) -> pd.Series:
            if len(xs) == 0:
                return pd.Series([], dtype=object)
            x = np.stack(xs.to_numpy())
            z = scale * np.cos(x @ w + b)
            return pd.Series(list(z))

        arr = vector_to_array(F.col(self.getInputCol()), "float64")
        return dataset.withColumn(self.getOutputCol(), array_to_vector(fourier(arr)))


SKLEARN_TOL = 1e-4


def rff_svc(c: float, weight_sum: float, gamma: float = 0.0, n_features: int = 200,
            seed: int = 42, max_iter: int = 100, weight_col: str | None = "weight",
            parallelism: int = 5, tol: float = SKLEARN_TOL) -> list:
    """Stages: Fourier map of ``features`` then a weighted linear SVM OvR."""
    rff = RandomFourierFeatures(inputCol="features", outputCol="rff", gamma=gamma,
                                numFeatures=n_features, seed=seed)
    svc = linear_svc_ovr(reg_param=svc_reg_param(c, weight_sum), max_iter=max_iter,
                         weight_col=weight_col, parallelism=parallelism, features="rff", tol=tol)
    return [rff, svc]


# Rows per partition of a training set: iterative fits run one job per
# iteration, so tiny tasks cost more in scheduling than they save.
ROWS_PER_FIT_TASK = 200_000


def sized_for_fit(df: DataFrame, n_rows: int | None = None,
                  rows_per_task: int = ROWS_PER_FIT_TASK) -> DataFrame:
    """Repartition a training set to about ``rows_per_task`` rows per task
    (one partition for small data, thousands at cluster scale)."""
    n = df.count() if n_rows is None else n_rows
    return df.repartition(max(1, math.ceil(n / rows_per_task)))


def fit_pipeline(stages: list, train: DataFrame):
    return Pipeline(stages=stages).fit(train)
