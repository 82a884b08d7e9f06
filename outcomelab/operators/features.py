"""Feature preparation: z-scores, one-hot, class weights, kernel width, PCA.

Statistics that a transform needs (means, deviations, category lists,
class counts) are small by construction: one value per column, per
category or per class. Means and deviations enter the plan as scalar
subqueries, which Catalyst merges into a single aggregate job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def fit_standardizer(src: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std of each column: one aggregate job whose
    single result row (2 values per column) is the fitted state."""
    xs = [F.col(c).cast("double") for c in cols]
    row = src.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(xs)],
                  *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(xs)]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}


def standardize(df: DataFrame, cols: Sequence[str], fit_df: DataFrame | None = None,
                suffix: str = "_z", fitted: dict | None = None) -> DataFrame:
    """Add ``<col><suffix>`` = (x - mean) / population std, fitted on
    ``fit_df`` (default: ``df`` itself). A constant column scales by 1, so
    its z-scores are 0; a NULL stays NULL.

    For one column the statistics stay in the plan as a scalar subquery;
    for several, ``fit_standardizer`` computes them in one job and they
    enter the plan as literals (scalar subqueries would be planned once per
    reference).
    """
    src = fit_df if fit_df is not None else df
    names = {c + suffix for c in cols}
    keep = [F.col(c) for c in df.columns if c not in names]
    if len(cols) == 1 and fitted is None:
        x = F.col(cols[0]).cast("double")
        m = src.agg(F.avg(x)).scalar()
        sd = src.agg(F.stddev_pop(x)).scalar()
        z = (x - m) / F.when(sd > 0, sd).otherwise(F.lit(1.0))
        return df.select(*keep, z.alias(cols[0] + suffix))
    fitted = fitted or fit_standardizer(src, cols)
    zs = []
    for c in cols:
        m, sd = fitted[c]
        x = F.col(c).cast("double")
        scale = sd if sd is not None and sd > 0 else 1.0
        zs.append(((x - F.lit(m)) / F.lit(scale)).alias(c + suffix))
    return df.select(*keep, *zs)


def one_hot_fit(df: DataFrame, col: str, out: str | None = None):
    """Fit index + one-hot for ``col``: categories by frequency (ties in
    alphabetical order); an unseen or NULL category at transform time gets
    an all-zero vector. Returns a ``PipelineModel``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    out = out or f"{col}_ohe"
    idx = StringIndexer(inputCol=col, outputCol=f"{col}_idx", handleInvalid="keep",
                        stringOrderType="frequencyDesc")
    enc = OneHotEncoder(inputCols=[f"{col}_idx"], outputCols=[out], dropLast=True)
    return Pipeline(stages=[idx, enc]).fit(df)


def hot_position(vec: str) -> Column:
    """0-based position of the 1 in a one-hot vector; NULL for all zeros."""
    from pyspark.ml.functions import vector_to_array
    pos = F.array_position(vector_to_array(F.col(vec)), F.lit(1.0))
    return F.when(pos > 0, (pos - 1).cast("bigint"))


def balanced_class_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class: rows and the balanced weight n / (k * n_class), where k
    counts the classes present. One grouped aggregate; the totals are
    scalar subqueries over its (k-row) result."""
    counts = (df.filter(F.col(label).isNotNull()).groupBy(label)
              .agg(F.count(F.lit(1)).alias("n_rows")))
    n = counts.agg(F.sum("n_rows")).scalar()
    k = counts.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("class_weight", n.cast("double") / (k * F.col("n_rows")))


def with_class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Add the balanced weight of each row's class (NULL label -> NULL).

    The weights, one row per class, are joined: Spark broadcasts them when
    their measured size allows, however long the class list is.
    """
    w = balanced_class_weights(df, label).select(F.col(label).alias("_class"), F.col("class_weight").alias(out))
    return df.join(w, F.col(label) == F.col("_class"), "left").drop("_class")


def gamma_scale(df: DataFrame, vec: str) -> DataFrame:
    """Kernel width 'scale': 1 / (d * var(X)), var over every non-NULL
    element of the feature matrix (population), d = features per row. ``vec``
    is an ML vector or a numeric array. The variance is the engine's merged
    one, stable for values far from zero; it is NULL without values, and the
    width is NULL when all values are equal."""
    from pyspark.sql.types import ArrayType
    c = F.col(vec)
    if not isinstance(df.schema[vec].dataType, ArrayType):
        from pyspark.ml.functions import vector_to_array
        c = vector_to_array(c)
    agg = (df.select(F.size(c).alias("_d"), F.explode_outer(c).alias("_v"))
           .withColumn("_x", F.col("_v").cast("double"))
           .agg(F.var_pop("_x").alias("variance"), F.count("_x").alias("n_values"), F.max("_d").alias("dim")))
    return agg.select(F.col("n_values").cast("bigint").alias("n_values"),
                      F.col("dim").cast("bigint").alias("dim"), "variance",
                      F.when(F.col("variance") > 0, F.lit(1.0) / (F.col("dim") * F.col("variance"))).alias("gamma"))


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out,
                           handleInvalid=handle_invalid).transform(df)


def assembled_moments(df: DataFrame, cols: Sequence[str]):
    """(n, means, co-moments) of the rows without NULL or NaN in ``cols``.

    Co-moments are sums of products of deviations from the mean. Every Arrow
    batch gives its own triple, triples merge by the pairwise formula of Chan,
    Golub and LeVeque, which is stable for values far from zero; a task sends
    one triple, ``LOT`` tasks merge in one, the driver gets the last d x d.
    """
    import numpy as np
    import pyarrow as pa
    d = len(cols)

    def merge(a, b):
        if a is None or b[0] == 0:
            return b if a is None else a
        n = a[0] + b[0]
        delta = b[1] - a[1]
        return (n, a[1] + delta * (b[0] / n), a[2] + b[2] + np.outer(delta, delta) * (a[0] * b[0] / n))

    def pack(t):
        return np.concatenate([[t[0]], t[1], t[2].ravel()]).tobytes()

    def unpack(x):
        v = np.frombuffer(x)
        return v[0], v[1:d + 1], v[d + 1:].reshape(d, d)

    def partial(batches):
        state = None
        for b in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns]) if b.num_rows else None
            if x is None:
                continue
            mean = x.mean(axis=0)
            dev = x - mean
            state = merge(state, (float(len(x)), mean, dev.T @ dev))
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pack(state)], pa.binary())], names=["m"])

    def total(pdf):
        import pandas as pd
        state = None
        for x in pdf["m"]:
            state = merge(state, unpack(x))
        return pd.DataFrame({"m": [pack(state)]})

    from outcomelab.session import ship
    ship(df.sparkSession)
    rows = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]).na.drop()
    parts = rows.mapInArrow(partial, "m binary").withColumn("lot", F.floor(F.spark_partition_id() / LOT))
    state = None
    for r in parts.groupBy("lot").applyInPandas(total, "m binary").toLocalIterator():
        state = merge(state, unpack(bytes(r["m"])))
    return state if state is not None else (0.0, np.zeros(d), np.zeros((d, d)))


# Triples (one a task) merged in one task.
LOT = 256


class Pca:
    """Principal components of population z-scores: ``mean``, ``scale`` (1 for a
    constant column), ``ratio`` and ``eigenvalue`` by falling variance,
    ``vectors`` (a column each). Eigenvalues are those of the sample covariance
    of the z-scores. The entry of largest absolute value of each component is
    positive (the first one on ties), as eigenvectors have no sign."""

    def __init__(self, df: DataFrame, cols: Sequence[str]):
        import numpy as np
        self.cols = list(cols)
        n, self.mean, co = assembled_moments(df, cols)
        self.n = int(n)
        std = np.sqrt(np.diag(co) / n) if n else np.zeros(len(cols))
        self.scale = np.where(std > 0, std, 1.0)
        cov = co / np.outer(self.scale, self.scale) / max(n - 1, 1)
        value, vector = np.linalg.eigh(cov)
        self.eigenvalue, vector = np.clip(value[::-1], 0.0, None), vector[:, ::-1]
        top = np.abs(vector).argmax(axis=0)
        self.vectors = vector * np.where(vector[top, np.arange(len(cols))] < 0, -1.0, 1.0)
        whole = self.eigenvalue.sum()
        self.ratio = self.eigenvalue / whole if whole > 0 else np.zeros(len(cols))

    def score(self, j: int) -> Column:
        """Score on component j of a row; NULL if one of its columns is NULL."""
        out = F.lit(0.0)
        for c, m, s, v in zip(self.cols, self.mean, self.scale, self.vectors[:, j]):
            out = out + (F.col(c).cast("double") - F.lit(float(m))) * F.lit(float(v / s))
        return out


def pca_variance(spark: SparkSession, df: DataFrame, cols: Sequence[str], pca: Pca | None = None) -> DataFrame:
    """Per component: variance ratio and cumulative in %, eigenvalue."""
    pca = pca or Pca(df, cols)
    rows, cum = [], 0.0
    for i, (r, e) in enumerate(zip(pca.ratio, pca.eigenvalue)):
        cum += float(r)
        rows.append((i + 1, float(r) * 100.0, cum * 100.0, float(e)))
    return spark.createDataFrame(
        rows, "component bigint, variance_pct double, cumulative_pct double, eigenvalue double")


def pca_loadings(spark: SparkSession, df: DataFrame, cols: Sequence[str], n_components: int = 3,
                 arrow_scale: float = 3.0, pca: Pca | None = None) -> DataFrame:
    """Long table (feature, component, weight, loading, arrow) for the first
    components: weight = component entry (3 digits), loading = weight x
    sqrt(eigenvalue), arrow = loading x arrow_scale. Size is d x n_components."""
    pca = pca or Pca(df, cols)
    rows = []
    for j in range(min(n_components, len(pca.cols))):
        root = float(pca.eigenvalue[j]) ** 0.5
        for name, w in zip(pca.cols, pca.vectors[:, j]):
            rows.append((name, j + 1, round(float(w), 3), float(w) * root, float(w) * root * arrow_scale))
    return spark.createDataFrame(
        rows, "feature string, component bigint, weight double, loading double, arrow double")


def pca_scores(df: DataFrame, cols: Sequence[str], keep: Sequence[str], n_components: int = 2,
               pca: Pca | None = None) -> DataFrame:
    """Scores of each row on the first components (z-scored inputs), as column
    arithmetic on the fitted means, deviations and vectors."""
    pca = pca or Pca(df, cols)
    return df.select(*keep, *[pca.score(j).alias(f"pc{j + 1}") for j in range(n_components)])
