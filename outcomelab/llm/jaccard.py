"""N-gram Jaccard join with several global token orders.

A document is the set of its distinct 5-word shingles; two documents link
when ``100 * |A & B| >= 80 * |A | B|``. For any one global order of the
shingles, linked sets share a shingle among the first
``n - ceil(0.8 n) + 1`` of each (the prefix). Three orders are used: shingles
that are frequent somewhere come last in all of them, and each order shuffles
the rest by a hash of its own. Pairs come from the prefixes of the first
order, must also share a prefix shingle in the second and the third, and are
then verified by their exact intersection.

* Equal sets are one class (a fingerprint); only classes are compared, copies
  are given back by membership, so a hot group of copies costs one class.
* Frequent shingles are those that some task saw in ``HOT_IN_TASK`` classes or
  more; at most ``MAX_HOT`` of them, the most frequent, are broadcast. They
  only choose the order, which is exact for any choice.
* Prefix shingles are dealt by hash in compact blobs, a few bytes each; the
  number of shards grows with the input.
* A shingle of many classes does not give all their pairs. Its members are
  first paired with a hub, the one that has the smallest share of shingles of
  its own; then only members of different components are paired for which the
  hub's shingles that neither lacks leave room for a link. No link between
  components is lost, and links inside a component need not be listed.
* A class with more than a fifth of shingles that no other class with a
  candidate has links with nothing. Whole sets travel for the others, from one
  document of each, found by a bit table of fixed size, and are intersected
  inside the JVM.

Edge cases: NULL, empty or word-free text has ``n_shingles`` 0 and links with
nothing (its component is its own id); a text of fewer than five words is one
shingle. Repeated rows are copies. A NULL id is ignored as a component's
smallest id; a component with NULL ids only has a NULL component. Columns
other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch, is_member, membership, mix, salted, shingle_set, ship, signed, stored, use_memos
from .components import components

HOT_IN_TASK = 4
MAX_HOT = 1 << 18
SHARD_SHINGLES = 2_000_000
MIN_SHARDS = 64
FLUSH_ENTRIES = 2_000_000
RUN_ALL = 16


def fingerprint(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def _need(n):
    """ceil(0.8 n): what a set of n must share at least with a linked set."""
    return (4 * n + 4) // 5


def _hot_rank(s: np.ndarray, hot: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How frequent each shingle of a sorted set is, 0 for those not broadcast."""
    if not len(hot[0]):
        return np.zeros(len(s), np.uint64)
    at = np.minimum(np.searchsorted(hot[0], s), len(hot[0]) - 1)
    return np.where(hot[0][at] == s, hot[1][at], 0).astype(np.uint64)


def ordered(s: np.ndarray, hot: tuple[np.ndarray, np.ndarray], order: int, rank: np.ndarray | None = None) -> np.ndarray:
    """The prefix of a sorted set in one of the global orders."""
    rank = _hot_rank(s, hot) if rank is None else rank
    key = salted(s, order) >> np.uint64(7) | rank << np.uint64(57)
    p = len(s) - _need(len(s)) + 1
    if p < len(s):
        return s[np.argpartition(key, p - 1)[:p]]
    return s


def _profile(batches):
    """One row per document, and the shingles that are frequent in this task."""
    use_memos()
    seen: set[int] = set()
    lot: list[np.ndarray] = []
    held: dict[int, int] = {}

    def fold():
        # a shingle met once in a lot is not held: the counts only choose an order
        if lot:
            u, c = np.unique(np.concatenate(lot), return_counts=True)
            k = c >= 2
            for t, n in zip(u[k].tolist(), c[k].tolist()):
                held[t] = held.get(t, 0) + n
            lot.clear()

    for b in batches:
        fps, ns = [], []
        for t in b.column(1):
            s = shingle_set(t.as_py())
            f = fingerprint(s)
            fps.append(f)
            ns.append(len(s))
            if len(s) and f not in seen:
                seen.add(f)
                lot.append(s)
                if len(lot) >= 4000:
                    fold()
        n = len(ns)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(ns, pa.int64()), pa.array(fps, pa.int64()),
             pa.nulls(n, pa.int64())], names=["doc_id", "n", "fp", "hot"])
    fold()
    hot = {t: n for t, n in held.items() if n >= HOT_IN_TASK}
    if hot:
        m = len(hot)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(m, pa.int64()), pa.array(list(hot.values()), pa.int64()), pa.nulls(m, pa.int64()),
             pa.array(signed(np.fromiter(hot, np.uint64, m)), pa.int64())],
            names=["doc_id", "n", "fp", "hot"])


def _hot_table(profile: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    top = (profile.where("hot is not null").groupBy("hot").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "hot").limit(MAX_HOT).toPandas())
    t = top["hot"].to_numpy(np.int64).view(np.uint64)
    c = (1 + np.log2(np.maximum(top["n"].to_numpy(np.float64), 1))).astype(np.int64)
    k = np.argsort(t)
    return t[k], c[k]


def _texts(b, bits):
    """The texts of a batch ``(h, text)``, of the documents in the bit table."""
    if bits is None:
        return b.column(1)
    table = np.frombuffer(bits.value, np.uint8)
    return b.column(1).filter(pa.array(is_member(table, b.column(0).to_numpy().view(np.uint64))))


def _deal(shards, hot=None, bits=None):
    """Shingles of every class of this task, as one blob per shard: the prefixes
    under ``hot``, or whole sets of the documents in the bit table."""
    def run(batches):
        seen: set[int] = set()
        docs: list[tuple[int, int, np.ndarray]] = []
        held = 0

        def blobs():
            tok = np.concatenate([d[2] for d in docs])
            own = np.repeat(np.arange(len(docs)), [len(d[2]) for d in docs])
            fp = np.array([d[0] for d in docs], np.int64)
            n = np.array([d[1] for d in docs], np.int32)
            shard = (tok % np.uint64(shards)).astype(np.int64)
            k = np.argsort(shard, kind="stable")
            tok, own, shard = (tok[k] >> np.uint64(32)).astype(np.uint32), own[k], shard[k]
            for s, part in zip(*_runs(shard)):
                o = own[part]
                who, start = np.unique(o, return_index=True)
                yield batch(shard=(pa.int32(), [int(s)]),
                            fp=(pa.binary(), [fp[who].tobytes()]), n=(pa.binary(), [n[who].tobytes()]),
                            size=(pa.binary(), [np.diff(np.append(start, len(o))).astype(np.int32).tobytes()]),
                            tok=(pa.binary(), [tok[part].tobytes()]))

        for b in batches:
            for t in _texts(b, bits):
                s = shingle_set(t.as_py())
                f = fingerprint(s)
                if len(s) and f not in seen:
                    seen.add(f)
                    docs.append((f, len(s), s if hot is None else ordered(s, hot.value, 1)))
                    held += len(docs[-1][2])
                    if held >= FLUSH_ENTRIES:
                        yield from blobs()
                        docs, held = [], 0
        if docs:
            yield from blobs()
    return run


_BLOB = "shard int, fp binary, n binary, size binary, tok binary"


def _entries(pdf):
    """``fp, n, tok`` of a shard, sorted by shingle, size and class; the same
    class from several tasks counts once."""
    cat = lambda c, t: np.concatenate([np.frombuffer(x, t) for x in pdf[c]])
    size = cat("size", np.int32)
    fp, n, tok = np.repeat(cat("fp", np.int64), size), np.repeat(cat("n", np.int32), size), cat("tok", np.uint32)
    k = np.lexsort((fp, n, tok))
    fp, n, tok = fp[k], n[k], tok[k]
    if len(tok):
        new = np.r_[True, (tok[1:] != tok[:-1]) | (fp[1:] != fp[:-1])]
        fp, n, tok = fp[new], n[new], tok[new]
    return fp, n, tok


def _alone(pdf):
    """Per class the shingles of this shard that no other class has; two
    shingles that look alike here make it fewer, never more."""
    import pandas as pd
    fp, _, tok = _entries(pdf)
    change = np.r_[True, tok[1:] != tok[:-1], True]
    who, count = np.unique(fp[change[1:] & change[:-1]], return_counts=True)
    return pd.DataFrame({"fp": who, "own": count.astype(np.int64)})


def _runs(sorted_values: np.ndarray):
    at = np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]])
    return sorted_values[at], [slice(a, z) for a, z in zip(at, np.append(at[1:], len(sorted_values)))]


def _pairs(pdf):
    """Pairs of classes of one shard that share a prefix shingle and whose
    sizes allow a link, from shingles of up to ``RUN_ALL`` classes. Of a larger
    one the members are given, once for each different set of members."""
    import pandas as pd
    fp, n, tok = _entries(pdf)
    first = np.flatnonzero(np.r_[True, tok[1:] != tok[:-1]]) if len(tok) else np.empty(0, np.int64)
    count = np.diff(np.append(first, len(tok)))
    runs: dict[bytes, int] = {}
    for a, c in zip(first[count > RUN_ALL].tolist(), count[count > RUN_ALL].tolist()):
        runs.setdefault(fp[a:a + c].tobytes(), a)
    shard = int(pdf["shard"].iloc[0])
    out = [pd.DataFrame({"run": shard << 33 | a, "a": fp[a:a + len(x) // 8], "b": np.int64(0), "n": n[a:a + len(x) // 8]})
           for x, a in runs.items()]
    kind = np.dtype([("a", np.int64), ("b", np.int64)])
    got, at, step = [], np.flatnonzero(np.repeat(count <= RUN_ALL, count)), 1
    while len(at):  # sizes rise within a shingle, so a pair too far apart ends the walk
        at = at[at + step < len(tok)]
        at = at[(tok[at] == tok[at + step]) & (n[at] >= _need(n[at + step]))]
        pair = np.empty(len(at), kind)
        pair["a"], pair["b"] = np.minimum(fp[at], fp[at + step]), np.maximum(fp[at], fp[at + step])
        got.append(np.unique(pair))
        step += 1
    if got:
        pair = np.unique(np.concatenate(got))
        out.append(pd.DataFrame({"run": np.int64(-1), "a": pair["a"], "b": pair["b"], "n": np.int64(0)}))
    return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("run", "a", "b", "n")}, dtype="int64")


def _sets(bits, hot):
    """The lower halves of the shingles, and the other two prefixes, of the
    documents that stand for a class with a candidate."""
    def run(batches):
        seen: set[int] = set()
        for b in batches:
            rows = []
            for t in _texts(b, bits):
                s = shingle_set(t.as_py())
                f = fingerprint(s)
                if len(s) and f not in seen:
                    seen.add(f)
                    rank = _hot_rank(s, hot.value)
                    two, three = ((mix(ordered(s, hot.value, o, rank)) >> np.uint64(32)).astype(np.uint32) for o in (2, 3))
                    half = s.astype(np.uint32)
                    rows.append((f, len(s), len(np.unique(half)) < len(s), *(x.view(np.int32) for x in (two, three, half))))
                    if len(rows) >= 500:
                        yield _set_batch(rows)
                        rows = []
            if rows:
                yield _set_batch(rows)
    return run


_SET = "fp long, n long, clash boolean, p2 array<int>, p3 array<int>, lo array<int>"


def _set_batch(rows):
    kinds = [pa.int64(), pa.int64(), pa.bool_()] + [pa.list_(pa.int32())] * 3
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)],
                                      names=[x.split()[0] for x in _SET.split(", ")])


def _whole_sets(bits):
    """All shingles in full of the documents that stand for a class."""
    def run(batches):
        for b in batches:
            for t in _texts(b, bits):
                s = shingle_set(t.as_py())
                yield batch(fp=(pa.int64(), [fingerprint(s)]), s=(pa.list_(pa.int64()), [signed(s)]))
    return run


def _standing(spark: SparkSession, profile: DataFrame, classes: DataFrame):
    """Bit table of one document of each of the classes ``fp``."""
    chosen = (profile.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
              .join(classes.select("fp").distinct(), "fp").select(F.xxhash64("doc_id").alias("h")))
    return spark.sparkContext.broadcast(membership(chosen, "h"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("fp"))


def _verified(spark: SparkSession, pairs: DataFrame, sets: DataFrame, src: DataFrame, profile: DataFrame) -> DataFrame:
    """The pairs that link. The lower halves of the shingles are intersected
    first: their overlap can only be too large, but for sets in which two lower
    halves clash. Pairs that a few false matches could decide are intersected
    again in full, by sets made anew from the texts."""
    def joined(p, cols, sets=sets):
        for x in ("a", "b"):
            p = p.join(sets.select(F.col("fp").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in cols]), x)
        return p

    shared = (joined(pairs, ["p2", "p3"]).where(F.arrays_overlap("p2_a", "p2_b") & F.arrays_overlap("p3_a", "p3_b"))
              .select("a", "b"))
    n = F.col("n_a") + F.col("n_b")
    links = lambda both: 100 * both >= 80 * (n - both)
    common = F.size(F.array_intersect("lo_a", "lo_b"))
    first = (joined(shared, ["n", "clash", "lo"])
             .select("a", "b", "n_a", "n_b", common.alias("both"), (F.col("clash_a") | F.col("clash_b")).alias("clash"))
             .where(F.col("clash") | links(F.col("both")))
             .select("a", "b", (F.col("clash") | ~links(F.col("both") - 2)).alias("unsure")).distinct())
    first = stored(spark, first, "verified")
    sure, again = first.where(~F.col("unsure")).select("a", "b"), first.where("unsure").select("a", "b")
    if again.isEmpty():
        return sure
    whole = src.mapInArrow(_whole_sets(_standing(spark, profile, _ends(again))), "fp long, s array<long>").distinct()
    size = profile.select("fp", "n").distinct()
    exact = (joined(joined(again, ["n"], size), ["s"], whole)
             .where(links(F.size(F.array_intersect("s_a", "s_b")))).select("a", "b"))
    return sure.unionByName(exact).distinct()


def _may_link(spark: SparkSession, src: DataFrame, profile: DataFrame, classes: DataFrame, shards: int) -> DataFrame:
    """Of the classes with a candidate, ``fp, n, own`` (shingles that no other of
    them has) of those that can link at all: a linked set shares 0.8 of its own."""
    classes = classes.distinct()
    whole = src.mapInArrow(_deal(shards, bits=_standing(spark, profile, classes)), _BLOB)
    alone = (whole.groupBy("shard").applyInPandas(_alone, "fp long, own long")
             .groupBy("fp").agg(F.sum("own").alias("own")))
    return (profile.where("n > 0").select("fp", "n").distinct().join(classes, "fp", "left_semi").join(alone, "fp", "left")
            .withColumn("own", F.coalesce("own", F.lit(0))).where("5 * own <= n"))


def _allowed(x: str, y: str):
    """Sizes, and what each class shares with any other at all, allow a link:
    the overlap must reach 4/9 of the sizes' sum."""
    total = F.col(f"{x}.n") + F.col(f"{y}.n")
    return ((9 * (F.col(f"{x}.n") - F.col(f"{x}.own")) >= 4 * total)
            & (9 * (F.col(f"{y}.n") - F.col(f"{y}.own")) >= 4 * total))


def _with_hubs(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Each class of the large runs with its hub, the member of its runs that
    has the least share of shingles of its own (the copy nearest to what all
    copies have in common), and the hub's shingles that it lacks."""
    hub = members.groupBy("run").agg(F.min(F.struct((F.col("own") / F.col("n")).alias("share"), "fp", "n")).alias("h"))
    one = (members.join(hub, "run").groupBy("fp").agg(F.min("h").alias("h"), F.first("n").alias("n"), F.first("own").alias("own"))
           .select("fp", "n", "own", F.col("h.fp").alias("hub"), F.col("h.n").alias("hub_n")))
    lo = sets.groupBy("fp").agg(F.first("lo").alias("lo")).join(one.select("fp").distinct(), "fp", "left_semi")
    return (one.join(lo, "fp").join(lo.select(F.col("fp").alias("hub"), F.col("lo").alias("hub_lo")), "hub")
            .select("fp", "n", "own", "hub", "hub_n", F.array_except("hub_lo", "lo").alias("lacks")))


def _rest_pairs(members: DataFrame, hubs: DataFrame, root: DataFrame) -> DataFrame:
    """Pairs of a run that are not in one component yet and may link. Classes
    of one hub share at most the hub's shingles that neither lacks, and others
    that are not their own."""
    m = hubs.join(root.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    x, y = m.alias("x"), m.alias("y")
    lacking = F.size("x.lacks") + F.size("y.lacks") - F.size(F.array_intersect("x.lacks", "y.lacks"))
    other = lambda c: F.col(f"{c}.n") - F.col(f"{c}.own") - F.col(f"{c}.hub_n") + F.size(f"{c}.lacks")
    most = F.col("x.hub_n") - lacking + F.greatest(F.least(other("x"), other("y")), F.lit(0)) + 2  # 2: false matches of half shingles
    cross = (F.col("x.fp") < F.col("y.fp")) & (F.col("x.root") != F.col("y.root")) & _allowed("x", "y")
    ends = (F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    same = x.join(y, (F.col("x.hub") == F.col("y.hub")) & cross & (9 * most >= 4 * (F.col("x.n") + F.col("y.n")))).select(*ends)
    each = members.select("run", "fp").join(m.select("fp", "n", "own", "hub", "root"), "fp")
    several = each.groupBy("run").agg(F.min("hub").alias("lo"), F.max("hub").alias("hi")).where("lo < hi").select("run")
    each = each.join(several, "run", "left_semi")
    x, y = each.alias("x"), each.alias("y")
    apart = x.join(y, (F.col("x.run") == F.col("y.run")) & (F.col("x.hub") != F.col("y.hub")) & cross).select(*ends)
    return same.unionByName(apart).distinct()


def links(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``profile(doc_id, n, fp)`` of every document, and verified links
    ``(a, b)`` between different classes (fingerprints) that connect all
    classes which any links connect."""
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    src = docs.select(F.xxhash64("doc_id").alias("h"), "text")
    profile = stored(spark, docs.mapInArrow(_profile, "doc_id long, n long, fp long, hot long"), "sets")
    hot = spark.sparkContext.broadcast(_hot_table(profile))
    profile = profile.where("hot is null").select("doc_id", "n", "fp")
    total = profile.agg(F.sum("n")).first()[0] or 0
    shards = max(MIN_SHARDS, -(-int(total) // SHARD_SHINGLES))
    dealt = src.mapInArrow(_deal(shards, hot=hot), _BLOB)
    runs = stored(spark, dealt.groupBy("shard").applyInPandas(_pairs, "run long, a long, b long, n long"), "runs")
    pairs = runs.where("run < 0").select("a", "b").distinct()
    members = runs.where("run >= 0").select("run", F.col("a").alias("fp"), "n")
    live = stored(spark, _may_link(spark, src, profile, _ends(pairs).unionByName(members.select("fp")), shards), "live")
    for x in ("a", "b"):
        pairs = pairs.join(live.select(F.col("fp").alias(x), F.struct("n", "own").alias(f"{x}_")), x)
    pairs = stored(spark, pairs.where(_allowed("a_", "b_")).select("a", "b"), "pairs")
    members = stored(spark, members.join(live.select("fp", "own"), "fp"), "members")
    bits = _standing(spark, profile, _ends(pairs).unionByName(members.select("fp")))
    sets = stored(spark, src.mapInArrow(_sets(bits, hot), _SET), "cand")
    hubs = stored(spark, _with_hubs(members, sets), "hubs")
    star = hubs.where("fp <> hub").select(F.least("fp", "hub").alias("a"), F.greatest("fp", "hub").alias("b"))
    near = stored(spark, _verified(spark, pairs.unionByName(star).distinct(), sets, src, profile), "links")
    rest = stored(spark, _rest_pairs(members, hubs, components(spark, near)), "rest")
    rest = _verified(spark, rest, sets, src, profile)
    return profile, stored(spark, near.unionByName(rest).distinct(), "links")


def jaccard_components(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document."""
    profile, linked = links(spark, docs)
    root = components(spark, linked)
    cls = (profile.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("least"))
           .join(root.select(F.col("node").alias("fp"), "root"), "fp", "left")
           .withColumn("root", F.coalesce("root", "fp")))
    comp = cls.groupBy("root").agg(F.min("least").alias("component_id"))
    cls = cls.join(comp, "root").select(F.col("fp").alias("_fp"), "component_id")
    return (profile.join(cls, (F.col("fp") == F.col("_fp")) & (F.col("n") > 0), "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def one_per_group(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest
    id; rows that repeat an id and its text stay once. All columns are kept."""
    keep = (jaccard_components(spark, docs)
            .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select(F.col("doc_id").alias("_id")).distinct())
    return (docs.join(keep, docs["doc_id"].cast("bigint").eqNullSafe(keep["_id"]), "left_semi")
            .dropDuplicates(["doc_id", "text"]))
