"""Sharding by Karmarkar-Karp differencing: byte-balanced shards of whole groups.

Documents with equal texts form a group that is not cut. A partial partition is
``k`` subsets with their sizes; a single group is one with ``k - 1`` empty
subsets. Differencing combines the two partial partitions of the largest spread
(largest less smallest subset), the largest subset of one with the smallest of
the other, until one is left.

One task cannot difference all groups, so it goes in three steps over the same
function:

1. heavy groups, those of at least 1 / (k * HEAVY) of all bytes (there are at
   most ``k * HEAVY``), are differenced in one task;
2. light groups are dealt by hash into lots of about ``LOT`` groups, one task
   each. A lot starts from a partial partition that holds its share of the heavy
   subsets, so it fills up what they left uneven;
3. one lot is held back and starts from the exact sizes of all others, which
   evens out what their spreads add up to.

A subset that holds more than a shard's fair share gets nothing else, because it
is always the one of largest spread and meets the others by its largest end.

Positions inside a shard come from pieces (a file of the stored rows, a block
of rows in it, a shard): a grouped count, a running sum over pieces and a rank
inside the piece. No task sees a shard or a group of copies whole. The shards of
groups with more than 1 / HOT of all rows (fewer than ``HOT`` groups) reach
their rows by broadcast, all others by a shuffled join.

Edge cases: NULL and empty texts are one group of size 8 a row, CRC-32 0. Rows
that repeat or have no doc_id are placed like any other. No documents give no
rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ship, stored

SHARDS = 24
HEAVY = 64
LOT = 50_000
HOT = 1_000
BLOCK_ROWS = 1 << 16
OVERHEAD = 8


def _merged(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Two partial partitions (sizes falling), oppositely ordered: sizes
    falling, and for each the subset of ``a`` it holds."""
    both = [x + y for x, y in zip(a, reversed(b))]
    order = sorted(range(len(both)), key=lambda i: -both[i])
    return [both[i] for i in order], order


def _with_single(a: list[int], size: int) -> tuple[list[int], list[int]]:
    """``_merged`` where the other partial partition is a single group."""
    last = a[-1] + size
    at = bisect_left(a, -last, 0, len(a) - 1, key=lambda x: -x)
    order = list(range(len(a)))
    order.insert(at, order.pop())
    return a[:at] + [last] + a[at:-1], order


def difference(sizes: list[int], k: int, start: list[int] | None = None) -> np.ndarray:
    """Subset (0 to k - 1) of every group by Karmarkar-Karp differencing.

    ``start`` holds sizes already in the subsets, whose numbers it fixes. Ties
    of spread go to the earlier partial partition, so equal input gives equal
    output. Memory: ``k`` bytes for each group and ``k`` numbers for each open
    partial partition.
    """
    n = len(sizes)
    if k == 1 or n == 0:
        return np.zeros(n, np.int32)
    # nodes: 0..n-1 single groups, n the start, then the combined ones
    open_: dict[int, list[int]] = {}
    heap = [(-s, i) for i, s in enumerate(sizes)]
    fixed = None
    if start is not None:
        order = sorted(range(k), key=lambda i: -start[i])
        open_[n] = [start[i] for i in order]
        heap.append((open_[n][-1] - open_[n][0], n))
        fixed = order
    heapq.heapify(heap)
    kids: list[tuple[int, int]] = []
    perms = np.zeros((max(n, 1), k), np.uint16)

    while len(heap) > 1:
        a = heapq.heappop(heap)[1]
        b = heap[0][1]
        if b >= n and a < n:
            a, b = b, a
        left = open_.pop(a) if a >= n else [sizes[a]] + [0] * (k - 1)
        if b < n:
            sums, order = _with_single(left, sizes[b])
        else:
            sums, order = _merged(left, open_.pop(b))
        node = n + 1 + len(kids)
        perms[len(kids)] = order
        kids.append((a, b))
        open_[node] = sums
        heapq.heapreplace(heap, (sums[-1] - sums[0], node))

    # downwards: the final subset of each place of a node
    out = np.zeros(n, np.int32)
    places: dict[int, np.ndarray] = {heap[0][1]: np.arange(k)}
    begun = np.arange(k)
    for j in range(len(kids) - 1, -1, -1):
        mine = places.pop(n + 1 + j)
        a, b = kids[j]
        of_a = np.empty(k, np.int64)
        of_a[perms[j]] = mine
        for kid, at in ((a, of_a), (b, of_a[::-1])):
            if kid < n:
                out[kid] = at[0]
            else:
                places[kid] = at
    if fixed is not None:
        begun = places.get(n, begun)
        # the start's place p has the caller's subset fixed[p] and ended up as begun[p]
        name = np.empty(k, np.int32)
        name[begun] = fixed
        out = name[out]
    return out


def spread(sizes: list[int], subset: np.ndarray, k: int) -> int:
    total = [0] * k
    for s, j in zip(sizes, subset):
        total[j] += s
    return max(total) - min(total)


def _assigned(groups: DataFrame, k: int) -> DataFrame:
    """(digest, size, lot[, start]) -> (digest, size, shard), a lot a task."""
    def one(pdf):
        pdf = pdf.sort_values(["size", "digest"], ascending=[False, True], kind="stable")
        sizes = [int(x) for x in pdf["size"]]
        begin = [int(x) for x in pdf["start"].iloc[0]] if "start" in pdf else None
        pdf = pdf[["digest", "size"]].copy()
        pdf["shard"] = difference(sizes, k, begin)
        return pdf

    return groups.groupBy("lot").applyInPandas(one, "digest binary, size decimal(38,0), shard int")


def _loads(assigned: DataFrame, k: int) -> list[int]:
    load = [0] * k
    for r in assigned.groupBy("shard").agg(F.sum("size").alias("size")).collect():
        load[r.shard] = int(r.size)
    return load


def assign_groups(spark: SparkSession, groups: DataFrame, k: int = SHARDS, lot: int = LOT) -> DataFrame:
    """``groups(digest, size)`` with distinct digests -> ``(digest, shard)``.

    The driver holds three lists of ``k`` sizes; everything else is in tasks.
    """
    ship(spark)
    whole = F.col("size").cast("decimal(38,0)")
    groups = groups.select("digest", whole.alias("size"))
    n, total = groups.agg(F.count(F.lit(1)), F.sum("size")).first()
    if not n:
        return groups.select("digest", F.lit(0).alias("shard"))
    total = int(total)
    is_heavy = F.col("size") * F.lit(k * HEAVY).cast("decimal(20,0)") >= F.lit(total).cast("decimal(38,0)")
    heavy = stored(spark, _assigned(groups.where(is_heavy).withColumn("lot", F.lit(0)), k), "heavy")
    load = _loads(heavy, k)

    lots = -(-n // lot)
    light = groups.where(~is_heavy).withColumn("lot", F.pmod(F.xxhash64("digest"), F.lit(lots)).cast("int"))
    done = heavy
    if lots > 1:
        # every lot but 0 starts from its share of the heavy subsets
        rest = total - sum(load)
        first = light.where("lot > 0")
        share = first.groupBy(F.col("lot").alias("of")).agg(F.sum("size").alias("held"))
        part = F.array(*[(F.col("held").cast("double") * (x / max(rest, 1))).cast("decimal(38,0)") for x in load])
        started = first.join(share.select("of", part.alias("start")), F.col("lot") == F.col("of")).drop("of")
        mid = stored(spark, _assigned(started, k), "lots")
        load = [a + b for a, b in zip(load, _loads(mid, k))]
        done = done.unionByName(mid)
    last = light.where("lot = 0").withColumn("start", F.array(*[F.lit(x).cast("decimal(38,0)") for x in load]))
    done = done.unionByName(stored(spark, _assigned(last, k), "last"))
    return done.select("digest", "shard")


def _placed(rows: DataFrame) -> DataFrame:
    """Adds ``slot``: gapless positions from 0 in every shard. ``rows`` is a
    stored table, so a file and a row number name a row for good."""
    at = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    at = at.withColumn("_block", (F.col("_row") / BLOCK_ROWS).cast("long"))
    piece = ["shard", "_file", "_block"]
    before = Window.partitionBy("shard").orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    start = (at.groupBy(*piece).agg(F.count(F.lit(1)).alias("_n"))
             .select(*piece, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    inside = Window.partitionBy(*piece).orderBy("_row")
    return (at.withColumn("_rank", F.row_number().over(inside)).join(start, piece)
            .withColumn("slot", F.col("_start") + F.col("_rank") - 1)
            .drop("_file", "_row", "_block", "_rank", "_start"))


def shard_documents(spark: SparkSession, docs: DataFrame, k: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    text = F.coalesce("text", F.lit(""))
    rows = stored(spark, docs.select(
        "doc_id", (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest")), "sizes")
    groups = stored(spark, rows.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("size").cast("decimal(38,0)")).alias("size")), "groups")
    shard_of = assign_groups(spark, groups.select("digest", "size"), k).select(
        F.col("digest").alias("of"), "shard")

    total = rows.count()
    hot = groups.where(F.col("n") * HOT > total).select(F.col("digest").alias("hot"))
    hot_shard = F.broadcast(shard_of.join(F.broadcast(hot), F.col("of") == F.col("hot")).drop("hot"))
    named = rows.join(F.broadcast(hot), F.col("digest") == F.col("hot"), "left")
    many = named.where(F.col("hot").isNotNull()).join(hot_shard, F.col("digest") == F.col("of"))
    few = named.where(F.col("hot").isNull()).join(shard_of, F.col("digest") == F.col("of"))
    cols = ["doc_id", "size", "text_crc32", "shard"]
    placed = _placed(stored(spark, many.select(*cols).unionByName(few.select(*cols)), "shards"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
