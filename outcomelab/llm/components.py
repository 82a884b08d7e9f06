"""Connected components by alternating large-star and small-star steps.

Each step is a grouped minimum and a join; every step's edges are written to
the shared scratch folder. No node's neighbours are collected in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored

MAX_STEPS = 60


def _star(edges: DataFrame, both: bool) -> DataFrame:
    e = edges.select("a", "b")
    if both:
        e = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = e.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("k"), F.least("a", "m").alias("m"))
    j = e.join(least, e["a"] == least["k"])
    if both:  # neighbours larger than the node move to its minimum
        out = j.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:  # the node and its smaller neighbours move to the minimum
        out = (j.select(F.col("b").alias("a"), F.col("m").alias("b"))
               .unionByName(least.select(F.col("k").alias("a"), F.col("m").alias("b"))))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of comparable ids -> ``(node, root)`` for every node that
    has an edge; the root is the smallest node of the component and has itself.

    NULL ends and self links are ignored; an empty input gives no rows.
    """
    e = (edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
         .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    e = stored(spark, e, "cc")
    last = None
    for _ in range(MAX_STEPS):
        e = stored(spark, _star(_star(e, True), False), "cc")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("components did not settle")
    return (e.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct())
