"""Filter interaction audit: what each of five filters removes, in every order.

A coalition is a set of filters; it removes the documents that fail any of
them. Every document is one of 32 failure masks, so the removals of all 32
coalitions of a part come from at most 32 counts. A filter's Shapley value is
the solution of the kernel-weighted least squares of the coalition removals,
constrained to add up to the removals of all filters; its normal equations are
solved in rationals, so the value is exact. The counts of a step are
differences between the coalition before it and the one after it.

Filters (words are maximal ``[^\\x20\\x09-\\x0D]+``, case-sensitive): A under 50
words; B 100 * distinct words < 65 * words; C 100 * ``[A-Z]`` characters > 5 *
code points; D holds any ``[#$%&*|]``; E identical to the text of a smaller
doc_id anywhere in the table.

Scale: texts are read once and leave their task as four bits and a SHA-256.
Rows that repeat in every respect fold before they travel. The smallest doc_id
of a text is a grouped minimum; it is joined on (text, doc_id), so the copies of
one text are dealt out by their ids and no task gathers them. What is left is
32 rows a part.

Edge cases: NULL or empty text has no words and no characters (fails A only,
and E from the second doc_id on); NULL and empty texts are identical. NULL
source is the part ''. A row without doc_id never fails E, makes nothing else
fail it and has no label. Rows that repeat a doc_id are counted each; equal ids
are not smaller than each other. A document is good (toxic) if any of its label
rows says so. Empty documents give no parts and no rows. Other columns are not
read.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction
from itertools import permutations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, stored

FILTERS = "ABCDE"
M = len(FILTERS)
ALL = (1 << M) - 1
MIN_WORDS = 50
DISTINCT_PCT = 65
CAPITAL_PCT = 5
_CAPITALS = bytes(range(0x41, 0x5B))
_SYMBOLS = b"#$%&*|"

REPORT = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
          "unique_fails long, good_lost long, toxic_lost long, shapley long")


def failures(text: str | None) -> int:
    """Bits of the filters A to D that a text fails (bit 0 is A)."""
    text = text or ""
    b = text.encode("utf-8")
    ws = b.split()
    return ((len(ws) < MIN_WORDS)
            | (100 * len(set(ws)) < DISTINCT_PCT * len(ws)) << 1
            | (100 * (len(b) - len(b.translate(None, _CAPITALS))) > CAPITAL_PCT * len(text)) << 2
            | (len(b) > len(b.translate(None, _SYMBOLS))) << 3)


def _flagged(docs: DataFrame) -> DataFrame:
    """(doc_id, part, fails, digest), the texts left behind."""
    def run(batches):
        for b in batches:
            ids, part, texts = b.columns
            fails, digest = [], []
            for t in texts:
                t = t.as_py() or ""
                fails.append(failures(t))
                digest.append(hashlib.sha256(t.encode("utf-8")).digest())
            yield pa.RecordBatch.from_arrays(
                [ids, part, pa.array(fails, pa.int32()), pa.array(digest, pa.binary())],
                names=["doc_id", "part", "fails", "digest"])

    kind = dict(docs.dtypes)["doc_id"]
    return (docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), "text")
            .mapInArrow(run, f"doc_id {kind}, part string, fails int, digest binary"))


def mask_counts(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of a part by the filters they fail."""
    ship(spark)
    rows = stored(spark, _flagged(docs).groupBy("doc_id", "part", "fails", "digest")
                  .agg(F.count(F.lit(1)).alias("n")), "flags")
    first = (rows.groupBy("digest").agg(F.min("doc_id").alias("first"))
             .select(F.col("digest").alias("of"), "first"))
    copies = rows.join(first, (F.col("digest") == F.col("of")) & (F.col("doc_id") == F.col("first")), "left")
    mask = F.col("fails") + F.when(F.col("doc_id").isNotNull() & F.col("first").isNull(), 1 << 4).otherwise(0)
    known = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id"))
             .agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("is_good"),
                  F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("is_toxic")))
    return (copies.select("doc_id", "part", mask.alias("mask"), "n")
            .join(known, F.col("doc_id") == F.col("id"), "left")
            .groupBy("part", "mask")
            .agg(F.sum("n").alias("n"),
                 F.sum(F.col("n") * F.coalesce("is_good", F.lit(0))).alias("good"),
                 F.sum(F.col("n") * F.coalesce("is_toxic", F.lit(0))).alias("toxic")))


def removals(counts: list[int]) -> list[int]:
    """By coalition: how many of the counted masks hold any of its filters."""
    return [sum(c for mask, c in enumerate(counts) if mask & s) for s in range(1 << M)]


def _solve(a: list[list[Fraction]], b: list[Fraction]) -> list[Fraction]:
    """Solution of a regular system, by elimination in rationals."""
    rows = [r + [x] for r, x in zip(a, b)]
    n = len(rows)
    for i in range(n):
        at = next(k for k in range(i, n) if rows[k][i])
        rows[i], rows[at] = rows[at], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for k in range(n):
            if k != i and rows[k][i]:
                f = rows[k][i]
                rows[k] = [x - f * y for x, y in zip(rows[k], rows[i])]
    return [r[-1] for r in rows]


def shapley(value: list[int]) -> list[Fraction]:
    """Shapley values of a game by coalition mask (``value[0]`` is 0): least
    squares over the proper coalitions under the Shapley kernel, with the sum
    of the values held at ``value[-1]`` by a multiplier."""
    players = range(M)
    weight = {s: Fraction(M - 1, comb(M, s.bit_count()) * s.bit_count() * (M - s.bit_count()))
              for s in range(1, ALL)}
    a = [[sum(w for s, w in weight.items() if s >> i & 1 and s >> j & 1) for j in players] + [Fraction(1)]
         for i in players] + [[Fraction(1)] * M + [Fraction(0)]]
    b = [sum(w * value[s] for s, w in weight.items() if s >> i & 1) for i in players] + [Fraction(value[ALL])]
    return _solve(a, b)[:M]


_ORDERS = np.array(list(permutations(range(M))))
_BIT = 1 << _ORDERS
_AFTER = np.cumsum(_BIT, axis=1)
_BEFORE = _AFTER - _BIT


def report(counts: list[int], good: list[int], toxic: list[int]) -> dict[str, np.ndarray]:
    """The 600 rows of a part, as columns, from its counts by mask."""
    v, vg, vt = (np.array(removals(c), np.int64) for c in (counts, good, toxic))
    removed = v[_AFTER] - v[_BEFORE]
    share = [x * len(_ORDERS) for x in shapley([int(x) for x in v])]
    if any(x.denominator != 1 for x in share):
        raise ArithmeticError("a Shapley sum over whole orders is not whole")
    out = {"kept": sum(counts) - v[_AFTER], "removed": removed, "redundant": v[_BIT] - removed,
           "unique_fails": v[ALL] - v[ALL - _BIT], "good_lost": vg[_AFTER] - vg[_BEFORE],
           "toxic_lost": vt[_AFTER] - vt[_BEFORE],
           "shapley": np.array([int(x) for x in share], np.int64)[_ORDERS]}
    names = ["".join(FILTERS[i] for i in o) for o in _ORDERS]
    return {"filter_order": np.repeat(names, M), "step": np.tile(np.arange(1, M + 1, dtype=np.int32), len(names)),
            **{k: x.ravel() for k, x in out.items()}}


def audit(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    def one(pdf):
        import pandas as pd
        cols = {}
        for c in ("n", "good", "toxic"):
            cols[c] = [0] * (1 << M)
            for mask, x in zip(pdf["mask"], pdf[c]):
                cols[c][int(mask)] = int(x)
        out = pd.DataFrame(report(cols["n"], cols["good"], cols["toxic"]))
        out.insert(0, "part", pdf["part"].iloc[0])
        return out

    return mask_counts(spark, docs, labels).groupBy("part").applyInPandas(one, REPORT)
