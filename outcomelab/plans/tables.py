"""Bindings for the aggregates, tiers, splits and scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomelab.functions import (decode_label, differs_from, encode_label,
                                  extract_group, label_order, ordered_bucket,
                                  right_closed_bins)
from outcomelab.functions.buckets import TIER_EDGES, TIER_LABELS
from outcomelab.operators import distribution, prep, rates
from outcomelab.plans.registry import query, rounded
from outcomelab.session import scratch_path
from outcomelab.sources import load_profile, read_csv, read_csv_checked, read_table, write_csv

# Order priorities in their natural order (the 5-class target).
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
# Year eras of the order and ship dates.
ERA_LAST = (1996, 1998)
ERAS = ("E1 (to 1996)", "E2 (1997-1998)", "E3 (from 1999)")


def _t(spark, sf_dir, name) -> DataFrame:
    return read_table(spark, sf_dir, name)


@query("load_profile")
def q_load_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_profile(_t(spark, sf_dir, "orders"), F.year("o_orderdate"))


@query("era_bucket")
def q_era_bucket(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    era = ordered_bucket(F.year("o_orderdate"), ERA_LAST, ERAS)
    return (o.groupBy(era.alias("era")).agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("era_order", label_order("era", ERAS)))


@query("sentinel_recode")
def q_sentinel_recode(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    rec = prep.sentinel_recode(li, "l_discount", 0, out="discount_recoded")
    out = (rec.groupBy((F.col("l_discount") == 0).cast("bigint").alias("recoded"))
           .agg(F.count(F.lit(1)).alias("n_rows"),
                F.min("discount_recoded").alias("min_value"),
                F.max("discount_recoded").alias("max_value"),
                F.avg("discount_recoded").alias("avg_value")))
    return rounded(out)


@query("label_encode")
def q_label_encode(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_orderpriority",
                    encode_label("o_orderpriority", PRIORITIES).alias("label"))


@query("label_decode")
def q_label_decode(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    enc = o.select("o_orderkey", encode_label("o_orderpriority", PRIORITIES).alias("label"),
                   (F.col("o_custkey") % 5).alias("prediction"))
    dec = enc.select("o_orderkey", decode_label("label", PRIORITIES).alias("true_label"),
                     decode_label("prediction", PRIORITIES).alias("pred_label"))
    return dec.withColumnsRenamed({"true_label": "o_orderpriority",
                                   "pred_label": "pred_priority"})


@query("temporal_split")
def q_temporal_split(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    return prep.split_counts(prep.temporal_split(o, "year", 1999, 2000, 2001))


@query("split_balance")
def q_split_balance(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    train = prep.temporal_split(o, "year", 1999, 2000, 2001).filter(F.col("split") == "train")
    return rounded(rates.class_distribution(train, "o_orderpriority", PRIORITIES))


@query("binary_flag")
def q_binary_flag(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    pr = F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM"))
    return (o.groupBy(differs_from(pr, "5-LOW").cast("bigint").alias("flag"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


@query("rate_by_key")
def q_rate_by_key(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return rounded(rates.rate_by_key(li, "l_quantity", "l_returnflag", "R", n_top=12))


@query("tier_bin")
def q_tier_bin(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    tier = right_closed_bins("l_quantity", TIER_EDGES, TIER_LABELS)
    return li.groupBy(tier.alias("tier")).agg(F.count(F.lit(1)).alias("n_rows"))


def tier_grid(li: DataFrame) -> DataFrame:
    return rates.two_way_rate(
        li, right_closed_bins("l_quantity", TIER_EDGES, TIER_LABELS),
        right_closed_bins("l_linenumber", TIER_EDGES, TIER_LABELS), TIER_LABELS,
        "l_returnflag", "R", row_labels=TIER_LABELS, min_support=30,
        row_name="quantity_tier", col_name="line_tier")


@query("tier_rate_grid")
def q_tier_rate_grid(spark, sf_dir):
    return rounded(tier_grid(_t(spark, sf_dir, "lineitem")))


def brand_size_grid(part: DataFrame) -> DataFrame:
    return rates.two_way_rate(
        part, "p_brand", right_closed_bins("p_size", TIER_EDGES, TIER_LABELS), TIER_LABELS,
        "p_type", "STANDARD", min_support=30, row_name="p_brand", col_name="size_tier")


@query("tier_rate_masked")
def q_tier_rate_masked(spark, sf_dir):
    return rounded(brand_size_grid(_t(spark, sf_dir, "part")))


@query("tier_rate_label")
def q_tier_rate_label(spark, sf_dir):
    g = rates.rate_label(brand_size_grid(_t(spark, sf_dir, "part")), min_support=30)
    return rounded(g.select("p_brand", "size_tier", "n", "label"))


# The class list of the distribution query; the last class
# never occurs in the data.
DIST_CLASSES = PRIORITIES + ("6-UNSEEN",)


@query("class_distribution")
def q_class_distribution(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return rounded(rates.class_distribution(o, "o_orderpriority", DIST_CLASSES))


@query("cumulative_share")
def q_cumulative_share(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    dist = rates.class_distribution(o, "o_orderpriority", DIST_CLASSES)
    return rounded(distribution.cumulative_share(dist, "class_order", "pct"))


def _returns_by_era(spark, sf_dir) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem")
    return (li.filter(F.col("l_returnflag") == "R")
            .withColumn("era", ordered_bucket(F.year("l_shipdate"), ERA_LAST, ERAS)))


@query("winner_median")
def q_winner_median(spark, sf_dir):
    return rounded(rates.group_median(_returns_by_era(spark, sf_dir), ["era"], "l_linenumber"))


@query("share_below")
def q_share_below(spark, sf_dir):
    return rounded(rates.share_at_most(_returns_by_era(spark, sf_dir), ["era"], "l_linenumber", 2))


@query("boxplot_stats")
def q_boxplot_stats(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").withColumn(
        "era", ordered_bucket(F.year("l_shipdate"), ERA_LAST, ERAS))
    return rounded(distribution.boxplot_stats(li, ["era", "l_returnflag"], "l_quantity"))


@query("min_rows_guard")
def q_min_rows_guard(spark, sf_dir):
    return rounded(rates.min_rows_guard(_t(spark, sf_dir, "part"), ["p_brand"], "p_retailprice", 80))


@query("drop_incomplete")
def q_drop_incomplete(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
        F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("status"), "o_totalprice")
    return rounded(prep.drop_incomplete(o))


@query("text_scrape")
def q_text_scrape(spark, sf_dir):
    pages = _t(spark, sf_dir, "pages")
    lang = extract_group("html", r'<html lang="([^"]*)"')
    return pages.groupBy(lang.alias("lang")).agg(F.count(F.lit(1)).alias("n_pages"))


PART_CSV_SCHEMA = T.StructType([
    T.StructField("p_partkey", T.LongType()),
    T.StructField("p_type", T.StringType()),
    T.StructField("p_size", T.IntegerType()),
    T.StructField("p_retailprice", T.DoubleType()),
])


@query("csv_scan")
def q_csv_scan(spark, sf_dir):
    """Round trip through CSV in the shared scratch folder, read back with
    an explicit schema (no inference pass), then aggregate."""
    part = _t(spark, sf_dir, "part").select(*[f.name for f in PART_CSV_SCHEMA.fields])
    path = write_csv(part, scratch_path(spark, "part-csv"))
    back = read_csv(spark, path, PART_CSV_SCHEMA)
    out = (back.groupBy("p_type")
           .agg(F.count(F.lit(1)).alias("n_rows"),
                F.sum("p_size").cast("bigint").alias("sum_size"),
                F.avg("p_retailprice").alias("avg_price")))
    return rounded(out)


# Every BAD_EVERY-th part gets a size that is no number.
BAD_EVERY = 50


@query("csv_bad_cells")
def q_csv_bad_cells(spark, sf_dir):
    """The same round trip with sizes that are no number in some rows: per type
    the rows, the rows with a bad cell, and what the good cells hold."""
    part = _t(spark, sf_dir, "part").select(*[f.name for f in PART_CSV_SCHEMA.fields])
    spoilt = part.withColumn("p_size", F.when(F.col("p_partkey") % BAD_EVERY == 0, F.lit("n/a"))
                             .otherwise(F.col("p_size").cast("string")))
    back = read_csv_checked(spark, write_csv(spoilt, scratch_path(spark, "part-csv")), PART_CSV_SCHEMA)
    return rounded(back.groupBy("p_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("_bad_record").alias("n_bad"),
        F.sum("p_size").cast("bigint").alias("sum_size"), F.sum("p_partkey").cast("bigint").alias("sum_key"),
        F.avg("p_retailprice").alias("avg_price")))
