"""Writers. Each task writes its own part file; nothing passes the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def table_digest(df: DataFrame) -> tuple[int, int]:
    """(rows, digest): the sum of the rows' 64-bit hashes. It does not depend
    on the order of rows or partitions and counts repeated rows."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(20,0)")
    n, s = df.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)"))).first()
    return int(n), int(s or 0)


class SinkError(RuntimeError):
    """What was read back is not what was written."""


def is_committed(df_or_spark, path: str) -> bool:
    """Whether the job that wrote ``path`` has committed (its ``_SUCCESS`` marker)."""
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def write_checked(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write as Parquet, wait for the commit marker, read back and compare rows
    and digest; returns the table read back.

    The rows are stored once in between (``checkpoint()``), so what is compared
    is what was written even where ``df`` does not repeat itself (timings,
    unordered limits).
    """
    from outcomelab.session import checkpoint_root
    checkpoint_root(df.sparkSession)
    fixed = df.checkpoint(eager=True)
    write_parquet(fixed, path, "errorifexists", partition_by)
    if not is_committed(df, path):
        raise SinkError(f"{path}: no commit marker")
    back = df.sparkSession.read.parquet(path).select(*df.columns)
    if (got := table_digest(back)) != (want := table_digest(fixed)):
        raise SinkError(f"{path}: wrote {want}, read {got}")
    return back
