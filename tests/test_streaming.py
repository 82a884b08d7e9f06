"""The streaming rate equals the batch rate on the same rows."""

from outcomelab.operators import rates
from outcomelab.session import scratch_path
from outcomelab.sources import read_table, write_parquet
from outcomelab.streaming import latest_rates, start_rate_stream

from conftest import SF001


def test_stream_matches_batch(spark):
    li = read_table(spark, SF001, "lineitem").select("l_linenumber", "l_returnflag")
    src = scratch_path(spark, "stream-src")
    # two arrivals of files
    write_parquet(li.filter("l_linenumber <= 3"), src + "/part1")
    write_parquet(li.filter("l_linenumber > 3"), src + "/part2")
    sink, ckpt = scratch_path(spark, "stream-sink"), scratch_path(spark, "stream-ckpt")
    q = start_rate_stream(spark, src + "/*", li.schema, "l_linenumber", "l_returnflag", "R", sink, ckpt)
    q.awaitTermination(300)
    got = sorted(tuple(r) for r in latest_rates(spark, sink).select(
        "l_linenumber", "n_rows", "n_events", "rate_pct").collect())
    want = sorted(tuple(r) for r in rates.rate_by_key(li, "l_linenumber", "l_returnflag", "R").select(
        "l_linenumber", "n_rows", "n_events", "rate_pct").collect())
    assert got == want and len(got) == 7
