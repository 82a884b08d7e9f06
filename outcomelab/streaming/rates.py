"""Streaming outcome rate by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from outcomelab.operators.rates import rate_by_key


def start_rate_stream(spark: SparkSession, source_dir: str, schema: T.StructType, key: str,
                      outcome: str, event, sink_dir: str, checkpoint_dir: str,
                      fmt: str = "parquet", available_now: bool = True) -> StreamingQuery:
    """Start the rate stream from files in ``source_dir`` into ``sink_dir``.

    The aggregate is ``operators.rates.rate_by_key``; its state holds two
    counters per key. Each micro-batch writes the whole result (one row per key)
    to a folder of its own, ``batch=<number>``, so a reader never sees half of
    one and a repeated batch replaces itself; ``latest_rates`` reads the newest.
    ``checkpoint_dir`` must be on shared storage so that a restarted
    driver resumes from the stored offsets and state.
    """
    src = spark.readStream.schema(schema).format(fmt).load(source_dir)
    out = rate_by_key(src, key, outcome, event)

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/batch={epoch}")

    w = out.writeStream.outputMode("complete").option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.foreachBatch(write).start()


def latest_rates(spark: SparkSession, sink_dir: str) -> DataFrame:
    """The result of the newest micro-batch."""
    every = spark.read.parquet(sink_dir)
    return every.where(F.col("batch") == every.agg(F.max("batch")).scalar()).drop("batch")
