"""Best-fit packing of token sequences by hierarchical residual packing.

A document is its token ids and an end id. A document longer than the sequence
length is cut into full pieces, the first piece taking the remainder. Each
partition packs its pieces best-fit, longest first (an exact best fit over
lengths, by a bit mask of free spaces). Bins that no other bin could join are
closed; the others move up as items, in groups of ``FAN_IN`` partitions, and
are packed best-fit again, level by level, until one group is left.

What moves up is bounded: after a best-fit round at most one bin of a group is
half full or less, and only that one and the ``HOSTS`` emptiest others can
still take part. The rest is closed where it is.

Edge cases: NULL or empty text is the end id alone; an empty table gives no
rows; repeated rows are packed as rows of their own. Columns other than
``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch, ship, stored
from .tok import default_vocabulary, encoder

SEQUENCE = 1024
END_ID = 2
FAN_IN = 16
HOSTS = 64
PARTITION_BITS = 40


def best_fit(sizes: list[int], room: int) -> tuple[list[int], list[int], list[int]]:
    """Best-fit decreasing: bin and offset of every item, and each bin's fill."""
    where, offset, fill = [0] * len(sizes), [0] * len(sizes), []
    open_bins: list[list[int]] = [[] for _ in range(room + 1)]  # by free space
    mask = 0
    for k in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[k]
        fits = mask >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            b = open_bins[free].pop()
            if not open_bins[free]:
                mask &= ~(1 << free)
        else:
            b, free = len(fill), room
            fill.append(0)
        where[k], offset[k] = b, fill[b]
        fill[b] += size
        open_bins[room - fill[b]].append(b)
        mask |= 1 << (room - fill[b])
    return where, offset, fill


def movers(fill: list[int], room: int) -> set[int]:
    """Bins that may still join another group's bins."""
    low = [b for b, f in enumerate(fill) if f < room]
    low.sort(key=lambda b: (fill[b], b))
    half = [b for b in low if 2 * fill[b] <= room]
    return set(half) | set([b for b in low if 2 * fill[b] > room][:HOSTS])


def pieces(ids: bytes, room: int) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's ids; the first may be shorter."""
    n = len(ids) // 4
    first = n % room or min(n, room)
    cuts = [0, *range(first, n, room), n] if n > first else [0, n]
    return [(k, a, z - a, zlib.crc32(ids[4 * a:4 * z])) for k, (a, z) in enumerate(zip(cuts, cuts[1:]))]


_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, off long, up boolean, fill long"
_KIND = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()]


def _emit(rows):
    names = [c.split()[0] for c in _PIECE.split(", ")]
    cols = list(zip(*rows)) if rows else [[]] * len(names)
    return batch(**{n: (t, list(c)) for n, t, c in zip(names, _KIND, cols)})


def _first_level(path: str, room: int, end: int):
    def run(batches):
        enc = encoder(path)
        tail = end.to_bytes(4, "little")
        base = TaskContext.get().partitionId() << PARTITION_BITS
        part: list[tuple] = []
        full = 0
        for b in batches:
            out = []
            texts = (t.as_py() for t in b.column(1))
            for i, ids in zip(b.column(0).to_pylist(), enc.encode(texts)):
                for p, start, length, crc in pieces(ids + tail, room):
                    if length == room:  # a bin of its own; even numbers
                        out.append((i, p, start, length, crc, base + 2 * full, 0, False, room))
                        full += 1
                    else:
                        part.append((i, p, start, length, crc))
            yield _emit(out)
        where, off, fill = best_fit([x[3] for x in part], room)
        up = movers(fill, room)
        rows = [(*x, base + 2 * b + 1, o, b in up, fill[b]) for x, b, o in zip(part, where, off)]
        for k in range(0, len(rows), 50_000):
            yield _emit(rows[k:k + 50_000])
    return run


def _merge_level(room: int, level: int):
    """Pack the bins of FAN_IN groups; the parent of a bin is the first bin in it."""
    def run(pdf):
        import pandas as pd
        pdf = pdf.sort_values("bin")
        bins, size = pdf["bin"].tolist(), pdf["fill"].tolist()
        where, off, fill = best_fit(size, room)
        up = movers(fill, room)
        host: dict[int, int] = {}
        for b, w, o in zip(bins, where, off):
            if o == 0:
                host[w] = b
        return pd.DataFrame({"child": bins, "parent": [host[w] for w in where], "shift": off,
                             "fill": [fill[w] for w in where], "up": [w in up for w in where]})
    return run


def pack(spark: SparkSession, docs: DataFrame, vocabulary: str | None = None, room: int = SEQUENCE,
         end: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    ship(spark)
    path = vocabulary or default_vocabulary()
    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stored(spark, src.mapInArrow(_first_level(path, room, end), _PIECE), "pieces")
    open_bins = rows.where("up").select("bin", "fill").distinct()
    groups = (rows.agg(F.max(F.shiftright("bin", PARTITION_BITS))).first()[0] or 0) + 1
    out = rows.select("doc_id", "piece", "start", "length", "ids_crc32",
                      F.col("bin").alias("sequence_id"), F.col("off").alias("offset"))
    level = 0
    while True:
        level += 1
        key = F.floor(F.shiftright("bin", PARTITION_BITS) / F.lit(FAN_IN ** level)).cast("long")
        merged = stored(spark, open_bins.groupBy(key.alias("g")).applyInPandas(
            _merge_level(room, level), "child long, parent long, shift long, fill long, up boolean"), "bins")
        out = (out.join(merged.select("child", "parent", "shift"), F.col("sequence_id") == F.col("child"), "left")
               .select("doc_id", "piece", "start", "length", "ids_crc32",
                       F.coalesce("parent", "sequence_id").alias("sequence_id"),
                       (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset")))
        if FAN_IN ** level >= groups:
            return out
        open_bins = merged.where("up and shift = 0").select(F.col("parent").alias("bin"), "fill")
