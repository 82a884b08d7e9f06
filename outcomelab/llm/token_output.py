"""Token ids as Parquet list columns.

Documents are range-sorted by id, encoded, and written as ``doc_id``,
``n_tokens``, ``local_start`` and ``ids`` (list of int32). Version 2 pages:
ids are dictionary-encoded per row group and fall back to delta encoding;
row groups and pages have set sizes, and the writer adds column and offset
indexes, so a reader may fetch the metadata columns, or the pages of a range
of ids, alone. A row's start in the whole corpus is the sum of the earlier
parts' tokens (one number per part) and its start in its own part.

Edge cases: NULL or empty text is the end id alone; an empty table gives an
empty file set that reads back with the same schema; repeated ids are ordered
by their text's hash; NULL ids come first. Columns other than ``doc_id`` and
``text`` are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomelab.session import scratch_path

from .common import ship
from .tok import default_vocabulary, encoder

END_ID = 0
SCHEMA = "part int, local_start long, doc_id long, n_tokens long, ids array<int>"
LAYOUT = {"parquet.writer.version": "v2", "parquet.enable.dictionary": "true",
          "parquet.block.size": str(32 << 20), "parquet.page.size": str(1 << 20),
          "parquet.dictionary.page.size": str(2 << 20), "compression": "zstd"}
LOT_TOKENS = 500_000


def _encode(path: str, end: int):
    def lot(part, start, docs, ids):
        n = np.array([len(x) // 4 for x in ids], np.int64)
        flat = np.frombuffer(b"".join(ids), "<i4")
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(n), part, np.int32)), pa.array(start + np.cumsum(n) - n),
             pa.array(docs, pa.int64()), pa.array(n),
             pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(flat))],
            names=["part", "local_start", "doc_id", "n_tokens", "ids"])

    def run(batches):
        enc, tail = encoder(path), end.to_bytes(4, "little")
        part, start = TaskContext.get().partitionId(), 0
        for b in batches:
            docs, ids, held = [], [], 0
            texts = (t.as_py() for t in b.column(1))
            for i, x in zip(b.column(0).to_pylist(), enc.encode(texts)):
                docs.append(i)
                ids.append(x + tail)
                held += len(x) // 4 + 1
                if held >= LOT_TOKENS:
                    yield lot(part, start, docs, ids)
                    start += held
                    docs, ids, held = [], [], 0
            if docs:
                yield lot(part, start, docs, ids)
                start += held
    return run


def write_ids(spark: SparkSession, docs: DataFrame, path: str, vocabulary: str | None = None,
              end: int = END_ID) -> None:
    """Write the ids of ``docs`` in ascending ``doc_id`` order to ``path``."""
    ship(spark)
    src = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
           .orderBy("doc_id", F.xxhash64("text")))
    (src.mapInArrow(_encode(vocabulary or default_vocabulary(), end), SCHEMA)
     .write.options(**LAYOUT).parquet(path))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The written rows with ``start``, the tokens of all documents before."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    parts = sorted((r.part, r.n) for r in rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    before, at = [], 0
    for part, n in parts:  # one row per written part
        before.append((part, at))
        at += n
    # one row for each written part, which the session's partition count bounds
    offsets = F.broadcast(spark.createDataFrame(before, "p int, before long"))
    return (rows.join(offsets, F.col("part") == F.col("p"))
            .select("doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids"))


def digests(rows: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the ids that were read."""
    def run(batches):
        for b in batches:
            ids = b.column(3)
            flat = ids.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            cut = ids.offsets.to_numpy()
            crc = [zlib.crc32(flat[a:z]) for a, z in zip(cut, cut[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.diff(cut).astype(np.int64)),
                                              pa.array(crc, pa.int64())],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(spark: SparkSession, docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    write_ids(spark, docs, path, vocabulary)
    return digests(read_ids(spark, path))
