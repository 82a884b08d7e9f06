"""The sweep over sizes on a small table, and sinks that check what they wrote."""

import pytest
from pyspark.sql import types as T

from outcomelab.operators import scaling
from outcomelab.plans import modeling
from outcomelab.session import scratch_path
from outcomelab.sources import read_csv_checked, sinks, write_checked, write_csv


def test_sweep_times_nested_resamples_and_goes_on_after_a_failure(spark):
    base = spark.range(40).withColumnRenamed("id", "row_id")
    seen = {}

    def count(df):
        seen[df.count()] = sorted(r.row_id for r in df.collect())

    def fail(df):
        raise ValueError("no fit")

    got = {(r.n_rows, r.arm): r for r in scaling.scaling_curve(
        spark, base, "row_id", [10, 100, 1000], {"count": count, "fail": fail}).collect()}
    assert len(got) == 6
    for n in (10, 100, 1000):
        ok, bad = got[(n, "count")], got[(n, "fail")]
        assert ok.status == "ok" and ok.seconds >= 0 and bad.seconds is None and bad.status.startswith("ValueError")
        assert ok.distinct_rows == len(set(seen[n])) and ok.id_sum == sum(seen[n])
    # a smaller resample is part of a larger one
    for small, large in ((10, 100), (100, 1000)):
        rest = list(seen[large])
        for k in seen[small]:
            rest.remove(k)


def test_registered_sizes():
    assert modeling.SCALING_SIZES == (10_000, 100_000, 1_000_000)
    assert (modeling.GRID_C, len(modeling.GRID_GAMMA), modeling.GRID_FOLDS) == ((0.5, 1.0, 5.0, 10.0), 3, 5)


def test_write_checked(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "k int, s string")
    path = scratch_path(spark, "checked")
    back = write_checked(df, path)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect())) and sinks.is_committed(spark, path)
    assert not sinks.is_committed(spark, path + "-none")
    assert sinks.table_digest(df) == sinks.table_digest(df.repartition(3)) != sinks.table_digest(df.distinct())
    got = iter([(3, 5), (3, 6)])
    monkeypatch.setattr(sinks, "table_digest", lambda df: next(got))
    with pytest.raises(sinks.SinkError):
        write_checked(df, scratch_path(spark, "checked"))


def test_bad_csv_cells_are_counted_and_headers_compared(spark):
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("s", T.StringType())])
    df = spark.createDataFrame([("1", "a"), ("x", "b"), (None, None), ("3", "c,d")], "k string, s string")
    path = write_csv(df, scratch_path(spark, "csv"))
    rows = {r.s: r for r in read_csv_checked(spark, path, schema).cache().collect()}
    assert rows["a"].k == 1 and rows["a"]._bad_record is None and rows["c,d"].k == 3
    assert rows["b"].k is None and rows["b"]._bad_record == "x,b"
    swapped = write_csv(df.select("s", "k"), scratch_path(spark, "csv"))
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_checked(spark, swapped, schema).collect()
