"""Source divergence audit: how far the term shares of the sources of a language
lie apart, with hash-consed segment trees over term ids.

Terms are runs of ASCII letters and of characters beyond ASCII, only A-Z
lower-cased. A language keeps the V terms that at least ``MIN_DOCS`` of its
documents hold. A group (lang, source), and the language as a whole, gives each
kept term the share p = 1 + floor(SCALE * (count + 2) / (N + 2 V)), N its count
over kept terms. Two shares p and q differ by f = floor((p - q)^2 / (p + q)).

- ``pair`` rows: for each other source of the language, f summed over all kept
  terms.
- ``term`` rows: kept terms of the group above the language's own share, by f,
  the first ``TOP_TERMS``.

Term ids of a language are dealt out by hash into blocks of about ``BLOCK``
terms. Over a block, every group has a segment tree of its counts; leaves are
count values and an inner node is a pair of nodes, both numbered by value, so
identical count subtrees of any groups are one node. Two trees are walked
together from the roots: a level holds each pair of nodes once with the number
of places where it stands, so equal node pairs go down once and at the leaves
each pair of counts is priced once. All arithmetic is in integers.

Scale: a task counts its documents and sends one row for each (lang, source,
term) it holds, at most ``OPEN_TERMS`` at a time. A pricing task has one block
of terms and two blocks of ``SOURCES`` sources: its memory is bounded, whatever
the numbers of terms and of sources. Pair rows (every other source, by contract)
are built by these tasks, not by a join.

Edge cases: NULL text, lang and source are ''. A group whose documents have no
kept term has count 0 everywhere; a language without kept terms has pair values
0 and no term rows; a language with one source has no pair rows. Repeated rows
count each. No documents give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ship, stored

MIN_DOCS = 10
SCALE = 1_000_000_000
PRIOR = 2
TOP_TERMS = 10
BLOCK = 8192
SOURCES = 64
OPEN_TERMS = 300_000
REPORT = ["lang", "source", "part", "item", "value", "rank"]

_TERM_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
                    for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """Terms of a text in order, as UTF-8."""
    return (text or "").encode("utf-8").translate(_TERM_BYTES).split()


def _counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, df) partial counts of every task."""
    def run(batches):
        held: dict[tuple, tuple[Counter, Counter]] = {}

        def rows():
            for (lang, source), (n, df) in held.items():
                keys = list(n)
                for at in range(0, len(keys), 10_000):
                    part = keys[at:at + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(part)), pa.array([source] * len(part)),
                         pa.array([t.decode("utf-8") for t in part]),
                         pa.array([n[t] for t in part], pa.int64()), pa.array([df[t] for t in part], pa.int64())],
                        names=["lang", "source", "term", "n", "df"])
            held.clear()

        for b in batches:
            langs, sources = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lang, source, text in zip(langs, sources, b.column(2)):
                ts = terms(text.as_py())
                if not ts:
                    continue
                n, df = held.setdefault((lang, source), (Counter(), Counter()))
                one = Counter(ts)
                n.update(one)
                df.update(one.keys())
                if sum(len(x) for x, _ in held.values()) > OPEN_TERMS:
                    yield from rows()
        yield from rows()

    return (docs.select(F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit("")), "text")
            .mapInArrow(run, "lang string, source string, term string, n long, df long"))


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n, lang_n) of the kept terms that a group holds."""
    each = (_counted(docs).repartition("lang", "term").groupBy("lang", "source", "term")
            .agg(F.sum("n").alias("n"), F.sum("df").alias("df")))
    of_term = Window.partitionBy("lang", "term")
    return (each.withColumn("lang_n", F.sum("n").over(of_term)).withColumn("lang_df", F.sum("df").over(of_term))
            .where(F.col("lang_df") >= min_docs).select("lang", "source", "term", "n", "lang_n"))


def share(count: np.ndarray, whole: int) -> np.ndarray:
    """1 + floor(SCALE * (count + PRIOR) / whole) in 64-bit integers: three
    steps of long division in base 1000 (SCALE is 1000 ** 3)."""
    if whole > 9 * 10 ** 15:
        raise OverflowError("more than 9e15 terms in one group")
    out = np.ones(len(count), np.int64)
    rest = count.astype(np.int64) + PRIOR
    digits = np.zeros(len(count), np.int64)
    for _ in range(3):
        digits = digits * 1000 + rest * 1000 // whole
        rest = rest * 1000 % whole
    return out + digits


class Forest:
    """Segment trees of several groups over the same terms, hash-consed.

    ``counts`` is (groups x terms). A level numbers its distinct nodes; nodes of
    the same number are the same subtree, in whichever group they stand.
    """

    def __init__(self, counts: np.ndarray):
        groups, n = counts.shape
        width = 1 << max(n - 1, 0).bit_length()
        # places beyond the terms hold -1, which costs nothing
        grid = np.full((groups, width), -1, np.int64)
        grid[:, :n] = counts
        self.values, ids = np.unique(grid, return_inverse=True)
        ids = ids.reshape(grid.shape)
        self.kids: list[tuple[np.ndarray, np.ndarray]] = []
        size = len(self.values)
        while ids.shape[1] > 1:
            pair, ids2 = np.unique(ids[:, 0::2] * size + ids[:, 1::2], return_inverse=True)
            self.kids.append((pair // size, pair % size))
            ids, size = ids2.reshape(groups, -1), len(pair)
        self.roots = ids[:, 0]

    def nodes(self) -> int:
        return len(self.values) + sum(len(a) for a, _ in self.kids)

    def meet(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (count in a, count in b) over the terms, and the number of
        terms of each, by walking both trees together."""
        left, right = self.roots[[a]], self.roots[[b]]
        times = np.ones(1, np.int64)
        for at, (first, second) in enumerate(reversed(self.kids)):
            size = len(self.values) if at == len(self.kids) - 1 else len(self.kids[-at - 2][0])
            key = np.concatenate([first[left] * size + first[right], second[left] * size + second[right]])
            key, back = np.unique(key, return_inverse=True)
            # exact: whole numbers below 2 ** 53
            times = np.bincount(back, np.concatenate([times, times]), len(key)).astype(np.int64)
            left, right = key // size, key % size
        ca, cb = self.values[left], self.values[right]
        real = ca >= 0
        return ca[real], cb[real], times[real]


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _pair_values(rows: DataFrame) -> DataFrame:
    """(lang, block, i, j, source, at, n, whole) -> (lang, a, b, value), the
    share of the block; a row without ``at`` only names a source."""
    def one(pdf):
        import pandas as pd
        who = pdf[["source", "side", "whole"]].drop_duplicates("source").sort_values(["side", "source"])
        names, side = who["source"].tolist(), who["side"].tolist()
        whole = [int(x) for x in who["whole"]]
        real = pdf[pdf["at"].notna()]
        at = real["at"].to_numpy(np.int64) - 1
        row = real["source"].map({s: k for k, s in enumerate(names)}).to_numpy(np.int64)
        counts = np.zeros((len(names), int(at.max()) + 1 if len(at) else 0), np.int64)
        counts[row, at] = real["n"].to_numpy(np.int64)
        i, j = pdf["i"].iloc[0], pdf["j"].iloc[0]
        out = []
        forest = Forest(counts) if counts.shape[1] else None
        for x in range(len(names)):
            for y in range(x + 1, len(names)):
                if i != j and side[x] == side[y]:
                    continue  # both of one block: priced where i and j are that block
                total = 0
                if forest is not None:
                    ca, cb, times = forest.meet(x, y)
                    f = price(share(ca, whole[x]), share(cb, whole[y]))
                    total = sum(int(v) * int(t) for v, t in zip(f, times))
                out.append((names[x], names[y], total))
        got = pd.DataFrame(out, columns=["a", "b", "value"])
        got.insert(0, "lang", pdf["lang"].iloc[0])
        return got

    return rows.groupBy("lang", "block", "i", "j").applyInPandas(
        one, "lang string, a string, b string, value long")


def audit(spark: SparkSession, docs: DataFrame, min_docs: int = MIN_DOCS, block: int = BLOCK,
          sources: int = SOURCES) -> DataFrame:
    """Pair and term rows of every (lang, source) group."""
    ship(spark)
    kept = stored(spark, kept_counts(docs, min_docs), "kept-terms")

    # directory of groups: N of the group, N and V of the language, numbers of sources
    groups = docs.select(F.coalesce("lang", F.lit("")).alias("lang"),
                         F.coalesce("source", F.lit("")).alias("source")).distinct()
    of_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = (kept.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n")).groupBy("lang")
               .agg(F.sum("lang_n").alias("lang_total"), F.count(F.lit(1)).alias("v")))
    directory = (groups.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
                 .na.fill(0, ["total", "lang_total", "v"])
                 .select("lang", "source", "v", (F.col("total") + PRIOR * F.col("v")).alias("whole"),
                         (F.col("lang_total") + PRIOR * F.col("v")).alias("lang_whole"),
                         F.greatest(F.ceil(F.col("v") / block), F.lit(1)).alias("blocks"),
                         F.floor((F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1) / sources)
                         .cast("int").alias("home")))
    last = F.max("home").over(Window.partitionBy("lang"))
    directory = stored(spark, directory.withColumn("homes", (last + 1).cast("int")), "groups")

    full = kept.join(directory, ["lang", "source"])
    # a source's rows go to every pair of source blocks that its own is part of
    cells = F.explode(F.transform(
        F.sequence(F.lit(0), F.col("homes") - 1),
        lambda o: F.struct(F.least(o, F.col("home")).alias("i"), F.greatest(o, F.col("home")).alias("j"))))
    numbered = (full.withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")))
                .withColumn("at", F.dense_rank().over(Window.partitionBy("lang", "block").orderBy("term")))
                .select("lang", "source", "block", "at", "n", "whole", "home", "homes"))
    markers = (directory.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
               .select("lang", "source", "block", F.lit(None).cast("int").alias("at"),
                       F.lit(0).cast("long").alias("n"), "whole", "home", "homes"))
    rows = (numbered.unionByName(markers).select("*", cells.alias("cell"))
            .select("lang", "block", "cell.i", "cell.j", "source", F.col("home").alias("side"), "at", "n", "whole"))
    pairs = stored(spark, _pair_values(rows).groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "pairs")
    both = (pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value")
            .unionByName(pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
            .withColumn("part", F.lit("pair")))

    def p(n, whole):
        # the quotient of two decimals without a fraction is a whole number
        return F.expr(f"1 + ({SCALE} * cast({n} + {PRIOR} as decimal(28, 0))) div cast({whole} as decimal(28, 0))")

    f = F.expr("((p - q) * (p - q)) div (p + q)")
    above = (full.where("n > 0").withColumn("p", p("n", "whole")).withColumn("q", p("lang_n", "lang_whole"))
             .where("p > q").select("lang", "source", F.col("term").alias("item"), f.alias("value"),
                                    F.lit("term").alias("part")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    top = above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP_TERMS)
    return both.withColumn("rank", F.row_number().over(order)).select(*REPORT).unionByName(top.select(*REPORT))
