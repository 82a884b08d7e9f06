"""Reproducible resampling: ranks by seeded draw, folds, samples, bootstrap,
permutations.

All randomness comes from ``functions.draws`` (a function of seed and row
id), so results do not change with the number of partitions or executors.

Exact positions ("row i of n within its class, in draw order") normally
need a window over the whole class, which puts one class in one task. Here
the draw order is cut into ``n_buckets`` ranges of the draw value; a
window runs per (class, bucket) and the bucket sizes, a table of
classes x buckets rows, give each bucket its offset. Because the bucket is a
monotone function of the draw, the positions equal those of the
single-window definition (checked against DuckDB's ``row_number``), while no
task holds more than about n / n_buckets rows, however skewed the classes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from outcomelab.functions.draws import HASH_SPAN, hash_draw

# Rows per (group, bucket) window task the bucket count aims at.
ROWS_PER_BUCKET = 2_000_000


def bucket_count(n_rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    return max(1, int(math.ceil(n_rows / rows_per_bucket)))


def draw_rank(df: DataFrame, seed, id_col: str, by: Sequence[str] = (),
              out: str = "pos", n_buckets: int | None = None) -> DataFrame:
    """Add ``out``: 0-based position of the row within ``by`` when rows are
    ordered by (hash_draw(seed, id), id).

    ``n_buckets`` defaults to one bucket per ``ROWS_PER_BUCKET`` rows of
    the input (one count job); any value gives the same positions.
    """
    by = list(by)
    if n_buckets is None:
        n_buckets = bucket_count(df.count())
    h = hash_draw(seed, id_col)
    # never NULL (the draw of a NULL id is bucket 0), so no extra
    # is-not-null filter re-evaluating the hash is inferred for the join key
    b = F.coalesce(F.floor(h.cast("double") / F.lit(HASH_SPAN) * F.lit(n_buckets)).cast("int"),
                   F.lit(0))
    d = df.withColumn("_h", h).withColumn("_b", b)
    local = F.row_number().over(Window.partitionBy(*by, "_b").orderBy("_h", id_col)) - F.lit(1)
    d = d.withColumn("_local", local)
    sizes = d.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    # offsets has (groups x buckets) rows: tiny next to the data, so the
    # join is a broadcast whenever its measured size allows. Keys match
    # null-safely so that a NULL group keeps its rows.
    ren = {c: f"_k{i}" for i, c in enumerate(by)}
    offsets = offsets.withColumnsRenamed(ren).withColumnRenamed("_b", "_ob")
    cond = [d[c].eqNullSafe(offsets[k]) for c, k in ren.items()] + [d["_b"] == offsets["_ob"]]
    joined = d.join(offsets, cond)
    return joined.withColumn(out, (F.col("_off") + F.col("_local")).cast("bigint")) \
        .drop("_h", "_b", "_ob", "_local", "_off", *ren.values())


def stratified_folds(df: DataFrame, class_col: str, id_col: str, k: int, seed=42,
                     out: str = "fold", n_buckets: int | None = None,
                     by: Sequence[str] = ()) -> DataFrame:
    """Shuffled stratified k-fold: fold = position within class mod k.

    Per class (and per ``by`` group), fold sizes differ by at most one row.
    Rows with a NULL class form their own stratum.
    """
    ranked = draw_rank(df, seed, id_col, by=[*by, class_col], out="_pos", n_buckets=n_buckets)
    return ranked.withColumn(out, (F.col("_pos") % F.lit(k)).cast("int")).drop("_pos")


def sample_exact(df: DataFrame, id_col: str, n: int, seed=42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement, seeded: the first n
    in the order of (hash_draw(seed, id), id).

    A histogram of the draw (one number per ``ROWS_PER_BUCKET`` rows) finds the
    bucket of the n-th row. Rows of earlier buckets are all taken, and only
    that bucket is ranked, so no task merges more than a bucket's rows.
    """
    n_buckets = bucket_count(df.count())
    d = df.withColumn("_h", hash_draw(seed, id_col))
    d = d.withColumn("_b", F.floor(F.col("_h").cast("double") / F.lit(HASH_SPAN) * F.lit(n_buckets)).cast("int"))
    left = n
    for r in d.groupBy("_b").agg(F.count(F.lit(1)).alias("rows")).orderBy("_b").collect():
        if r["rows"] >= left:
            last = d.filter(F.col("_b") == r["_b"]).orderBy("_h", id_col).limit(left)
            return d.filter(F.col("_b") < r["_b"]).unionByName(last).drop("_h", "_b")
        left -= r["rows"]
    return df


def bootstrap_resample(spark: SparkSession, df: DataFrame, id_col: str, n: int,
                       seed=42, out_id: str = "draw_id") -> DataFrame:
    """Exactly ``n`` rows drawn with replacement, seeded.

    The base rows get dense positions 0..m-1 (``draw_rank``); draw i takes
    the row at position hash(seed, i) mod m. The join key is uniform, so
    the join has no hot key however many copies of one row are drawn.
    """
    m = df.count()
    if m == 0:
        raise ValueError("cannot resample an empty table")
    base = draw_rank(df, f"{seed}-base", id_col, out="_pos", n_buckets=bucket_count(m))
    draws = (spark.range(n).withColumnRenamed("id", out_id)
             .withColumn("_pos", F.pmod(hash_draw(seed, out_id), F.lit(m))))
    return draws.join(base, "_pos").drop("_pos")


def permutation_pairs(df: DataFrame, id_col: str, seed, n_buckets: int | None = None) -> DataFrame:
    """(id, partner) pairs forming one random permutation of the rows.

    Rows are placed by two independent draws; the row at position p of the
    first order is paired with the row at position p of the second. Every
    row is a partner exactly once.
    """
    ids = df.select(id_col)
    a = draw_rank(ids, f"{seed}-a", id_col, out="_p", n_buckets=n_buckets)
    b = draw_rank(ids, f"{seed}-b", id_col, out="_p", n_buckets=n_buckets) \
        .withColumnRenamed(id_col, "partner")
    return a.join(b, "_p").drop("_p")


# Rounds of the Feistel network behind ``permuted``.
FEISTEL_ROUNDS = 8


def permuted(pos: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..n-1, applied to ``pos``: no table, no rank.

    An alternating Feistel network over pairs (x div b, x mod b) of a grid of
    a x b >= n places is a bijection of the grid; places beyond n walk on until
    they fall inside, which keeps it one of 0..n-1.
    """
    a = max(1, math.isqrt(n - 1) + 1) if n > 1 else 1
    b = -(-n // a)
    x = np.asarray(pos, np.int64).copy()
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] // b, x[todo] % b
        for i in range(FEISTEL_ROUNDS):
            if i % 2:
                right = (right + _mix(left, key, i) % np.uint64(b)).astype(np.int64) % b
            else:
                left = (left + _mix(right, key, i) % np.uint64(a)).astype(np.int64) % a
        x[todo] = left * b + right
        todo = todo[x[todo] >= n]
    return x


def _mix(x: np.ndarray, key: int, i: int) -> np.ndarray:
    """64-bit finaliser (SplitMix64) of a value, the key and the round; below 2**32."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) + np.uint64(key & (2 ** 64 - 1)) + np.uint64(i + 1) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((z ^ (z >> np.uint64(31))) >> np.uint64(32)).astype(np.uint64)


def permutation_key(seed, repeat: int) -> int:
    return int(hashlib.md5(f"{seed}-perm-{repeat}".encode()).hexdigest()[:15], 16)


def permutation_partners(df: DataFrame, id_col: str, seed, repeats: int) -> DataFrame:
    """``df`` with ``pos`` (dense, by draw), ``repeat`` and ``partner``: for
    each repeat the position of the row's partner, every row being one once.

    One rank for all repeats; the permutations are computed from the position.
    """
    from outcomelab.session import ship
    ship(df.sparkSession)
    ranked = draw_rank(df, f"{seed}-pos", id_col, out="pos")
    n = df.count()
    keys = [permutation_key(seed, r) for r in range(repeats)]

    @F.pandas_udf("array<bigint>")
    def partners(pos):
        import pandas as pd
        got = np.stack([permuted(pos.to_numpy(np.int64), n, key) for key in keys], axis=1)
        return pd.Series(list(got), dtype=object)

    return ranked.select("*", F.posexplode(partners("pos")).alias("repeat", "partner"))
