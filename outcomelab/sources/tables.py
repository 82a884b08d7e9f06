"""Table readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")

def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the benchmark parquet tables; Catalyst prunes and pushes down."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             header: bool = True) -> DataFrame:
    """CSV with a header and an explicit schema (no inference pass)."""
    return (spark.read.schema(schema).option("header", header)
            .option("mode", "PERMISSIVE").csv(path))


BAD = "_bad_record"


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with an explicit schema, plus ``_bad_record``: the whole line of a
    row that has a cell of the wrong type, or too few or too many cells (NULL
    for a good row; the good cells of a bad row are kept).

    The header of every file is compared with the schema: a file whose columns
    are named or ordered otherwise fails the job, as its cells would land in
    wrong columns.
    """
    full = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    return (spark.read.schema(full).option("header", True).option("mode", "PERMISSIVE")
            .option("enforceSchema", False).option("columnNameOfCorruptRecord", BAD).csv(path))
