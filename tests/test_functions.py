"""Column functions: hand-computed cases from the fixture list."""

from pyspark.sql import functions as F

from outcomelab.functions import (argmax, decode_label, differs_from, encode_label,
                                  era_of_year, hash_draw, right_closed_bins, softmax)
from outcomelab.functions.buckets import TIER_EDGES, TIER_LABELS


def test_bin_edges_right_closed(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 1.0, 2.0, 2.5, 5.0, 10.0, 30.0, 31.0)], "x double")
    got = [r[0] for r in df.select(right_closed_bins("x", TIER_EDGES, TIER_LABELS)).collect()]
    assert got == [None, "Top-2", "Top-2", "3rd-5th", "3rd-5th", "6th-10th", "11th+", None]


def test_era_null_year_is_last_era(spark):
    df = spark.createDataFrame([(2000,), (2013,), (2014,), (2021,), (2022,), (None,)], "y int")
    got = [r[0] for r in df.select(era_of_year("y")).collect()]
    assert got[:2] == ["V8 (2005-2013)"] * 2
    assert got[2:4] == ["Hybrid (2014-2021)"] * 2
    assert got[4:] == ["Ground Effect (2022-2025)"] * 2


def test_label_outside_list_is_null(spark):
    classes = ["1st", "2nd", "3rd", "4th", "Outside Top 4"]
    df = spark.createDataFrame([("2nd",), ("DNF",), (None,)], "p string")
    got = [r[0] for r in df.select(encode_label("p", classes)).collect()]
    assert got == [1.0, None, None]
    back = df.select(encode_label("p", classes).alias("l")).select(decode_label("l", classes))
    assert [r[0] for r in back.collect()] == ["2nd", None, None]


def test_not_equal_flag_counts_null_as_different(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "p string")
    assert [r[0] for r in df.select(differs_from("p", "b")).collect()] == [1, 0, 1]


def test_softmax_sums_to_one_and_argmax_first_tie(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0, -2.0],), ([1000.0, 999.0, 0.0, 0.0],)], "a array<double>")
    rows = df.select(softmax("a").alias("p"), argmax("a").alias("k")).collect()
    for r in rows:
        assert abs(sum(r.p) - 1.0) < 1e-12
    assert rows[0].k == 1 and rows[1].k == 0


def test_hash_draw_independent_of_partitioning(spark):
    a = spark.range(1000).repartition(1).select("id", hash_draw(42, "id").alias("h"))
    b = spark.range(1000).repartition(4).select("id", hash_draw(42, "id").alias("h"))
    assert sorted(a.collect()) == sorted(b.collect())
    assert a.agg(F.min("h")).first()[0] >= 0


def test_scrape_metrics_section_and_missing(spark):
    from outcomelab.sources import scrape_metrics
    text = ("=== A ===\n  Accuracy:    0.5000\n  Macro-F1:    0.2500\n"
            "=== B ===\n  Accuracy:    0.7500\n")
    df = spark.createDataFrame([(text,)], "value string")
    pats = {"acc": r"Accuracy:\s*([-0-9.]+)", "f1": r"Macro-F1:\s*([-0-9.]+)"}
    b = scrape_metrics(df, "=== B ===", pats).first()
    assert b.acc == 0.75 and b.f1 is None
    missing = scrape_metrics(df, "=== C ===", pats).first()
    assert missing.acc is None and missing.f1 is None
