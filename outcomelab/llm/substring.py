"""Substring dedup by repeated-phrase automata.

A window is ``WINDOW`` consecutive words of one document. Every word covered
by a window whose word sequence also starts anywhere else is removed.

1. Each window has a seed: its ``SEED``-word phrase of least hash. Equal
   windows have equal seeds, so a window can only recur if its seed does. All
   seeds are counted, and a bit table of fixed size marks those that recur.
2. Windows with a marked seed go to the seed's shard, as the stretch of words
   that the windows of one seed occurrence span. A task sends equal stretches
   once: from the second on they recur as a whole, so their places are known.
3. A shard confirms the windows that recur, joins neighbours that recur in the
   same stretches to phrases, compiles the phrases into an Aho-Corasick
   automaton over word numbers and streams all its stretches through it. Every
   occurrence found is a range of words to remove.

Seeds with more than ``HOT_SEED`` occurrences are split: their windows travel
one by one, dealt by their own hash, so no shard gathers a hot passage. Shards
grow in number with the marked occurrences.

Edge cases: NULL text has no words and nothing is removed; texts shorter than
a window neither; repeated rows repeat each other's windows; the digest of a
document without kept words is that of the empty string. Columns other than
``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (batch, is_member, membership, mix, rolling, ship, signed, stored, use_memos, word_hashes,
                     words)

WINDOW = 35
SEED = 8
SEED_SHARDS = 32
SHARD_STRETCHES = 25_000
MIN_SHARDS = 32
HOT_SEED = 20_000
MAX_HOT = 1 << 16
_POS = np.uint64((1 << 24) - 1)


def seeds(h: np.ndarray, window: int = WINDOW, k: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Seed position of every window of a document, and the phrase hashes. The
    least hash wins, the first of equal ones."""
    g = rolling(h, k)
    width = window - k + 1
    n = len(g) - width + 1
    if n <= 0:
        return np.empty(0, np.int64), g
    key = (g & ~_POS) | (np.arange(len(g), dtype=np.uint64) & _POS)
    low, span = key, 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    low = np.minimum(low[:n], low[width - span:width - span + n])
    start = np.arange(n)
    return start + ((low & _POS).astype(np.int64) - start) % (1 << 24), g


def _count_seeds(window, k):
    def run(batches):
        use_memos("words")
        lot, held = [], 0

        def out():
            s, n = np.unique(np.concatenate(lot), return_counts=True)
            shard = (s % np.uint64(SEED_SHARDS)).astype(np.int64)
            for x in range(SEED_SHARDS):
                m = shard == x
                if m.any():
                    yield batch(shard=(pa.int32(), [x]), seed=(pa.binary(), [s[m].tobytes()]),
                                n=(pa.binary(), [np.minimum(n[m], 60_000).astype(np.uint16).tobytes()]))

        for b in batches:
            for t in b.column(0):
                ws = words(t.as_py())
                if len(ws) >= window:
                    at, g = seeds(word_hashes(ws), window, k)
                    lot.append(g[np.unique(at)])
                    held += len(lot[-1])
                    if held >= 3_000_000:
                        yield from out()
                        lot, held = [], 0
        if lot:
            yield from out()
    return run


def _recurring(pdf):
    import pandas as pd
    s = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["seed"]])
    n = np.concatenate([np.frombuffer(x, np.uint16) for x in pdf["n"]]).astype(np.int64)
    u, back = np.unique(s, return_inverse=True)
    total = np.bincount(back, n).astype(np.int64)
    k = total >= 2
    return pd.DataFrame({"seed": signed(u[k]), "n": total[k]})


_STRETCH = "shard int, k long, a int, words int, text binary"


def _stretches(bits, hot, shards, window, k):
    def run(batches):
        use_memos("words")
        table = np.frombuffer(bits.value, np.uint8)
        met: dict[bytes, tuple | None] = {}
        rows: list[tuple] = []

        def send(key, shard, a, part):
            text = b" ".join(part)
            mark = xxhash.xxh3_128_digest(text)
            if mark not in met:
                met[mark] = (key, a)
                rows.append((shard, key, a, len(part), text))
                return
            first = met[mark]
            if first is not None:
                rows.append((first[0] % shards, *first, len(part), None))
                met[mark] = None
            rows.append((key % shards, key, a, len(part), None))

        for b in batches:
            for key, t in zip(b.column(0).to_pylist(), b.column(1)):
                ws = words(t.as_py())
                if len(ws) < window:
                    continue
                at, g = seeds(word_hashes(ws), window, k)
                cut = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
                seed = g[at[cut]]
                keep = np.flatnonzero(is_member(table, seed))
                ends = np.append(cut[1:], len(at))
                for j in keep.tolist():
                    s, a, z = int(seed[j]), int(cut[j]), int(ends[j])
                    parts = hot.value.get(s)
                    if parts is None:
                        send(key, (s >> 20) % shards, a, ws[a:z - 1 + window])
                    else:
                        for w in range(a, z):
                            own = ws[w:w + window]
                            send(key, (xxhash.xxh3_64_intdigest(b" ".join(own)) >> 20) % shards, w, own)
                if len(rows) >= 20_000:
                    yield _stretch_batch(rows)
                    rows.clear()
        if rows:
            yield _stretch_batch(rows)
    return run


def _stretch_batch(rows):
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)],
                                      names=["shard", "k", "a", "words", "text"])


def phrases(flat: np.ndarray, first: np.ndarray, window: int) -> tuple[list[tuple], np.ndarray]:
    """Phrases of the windows that recur among stretches (``first``: where each
    starts in ``flat``), and which stretches hold one.

    A phrase is a longest run of neighbouring windows, at their first place,
    that occur in the same stretches: each of its occurrences is then an
    occurrence of all its windows."""
    size = np.diff(np.append(first, len(flat)))
    own = np.repeat(np.arange(len(first)), size)
    n = len(flat) - window + 1
    if n <= 0:
        return [], np.zeros(len(first), bool)
    h = rolling(flat.astype(np.uint64), window)
    start = np.flatnonzero(own[:n] == own[window - 1:])
    order = start[np.argsort(h[start], kind="stable")]
    g = np.flatnonzero(np.r_[True, h[order][1:] != h[order][:-1]])
    count = np.diff(np.append(g, len(order)))
    sign = np.add.reduceat(mix(own[order].astype(np.uint64) + np.uint64(1)), g) if len(g) else np.empty(0, np.uint64)
    again = count >= 2
    holds = np.zeros(len(first), bool)
    holds[own[order[np.repeat(again, count)]]] = True
    at = order[g][again]  # first place of every recurring window
    k = np.argsort(at)
    at, sign = at[k], sign[again][k]
    cut = np.flatnonzero(np.r_[True, (at[1:] != at[:-1] + 1) | (own[at[1:]] != own[at[:-1]])
                               | (sign[1:] != sign[:-1])]) if len(at) else ()
    last = np.append(cut[1:], len(at)) - 1 if len(at) else ()
    return [tuple(flat[at[x]:at[y] + window].tolist()) for x, y in zip(cut, last)], holds


def _locate(window):
    def run(pdf):
        import ahocorasick
        import pandas as pd
        use_memos()
        known = pdf[pdf["text"].isna()]
        out = [(known["k"].to_numpy(np.int64), known["a"].to_numpy(np.int64),
                (known["a"] + known["words"]).to_numpy(np.int64))]
        pdf = pdf[pdf["text"].notna()]
        number: dict[bytes, int] = {}
        if len(pdf):
            size = pdf["words"].to_numpy(np.int64)
            first = np.cumsum(size) - size
            flat = np.fromiter((number.setdefault(w, len(number) + 1) for t in pdf["text"] for w in t.split()),
                               np.int64, int(size.sum()))
            number.clear()
            found, holds = phrases(flat, first, window)
            if found:
                auto = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
                for p in found:
                    auto.add_word(p, len(p))
                auto.make_automaton()
                key, a = pdf["k"].to_numpy(np.int64), pdf["a"].to_numpy(np.int64)
                rows = []
                for j in np.flatnonzero(holds).tolist():
                    lo = hi = -1
                    for end, n in auto.iter(tuple(flat[first[j]:first[j] + size[j]].tolist())):
                        if hi < 0:
                            lo, hi = end + 1 - n, end + 1
                        elif end + 1 - n > hi:
                            rows.append((j, lo, hi))
                            lo, hi = end + 1 - n, end + 1
                        else:
                            lo, hi = min(lo, end + 1 - n), end + 1
                    if hi >= 0:
                        rows.append((j, lo, hi))
                if rows:
                    j, lo, hi = np.array(rows, np.int64).T
                    out.append((key[j], a[j] + lo, a[j] + hi))
        k, lo, hi = (np.concatenate(c) for c in zip(*out))
        return pd.DataFrame({"k": k, "lo": lo, "hi": hi})
    return run


def _remove(batches):
    use_memos()
    for b in batches:
        rows = []
        for t, cut in zip(b.column(1), b.column(2)):
            ws = words(t.as_py())
            keep = ws
            cut = cut.as_py()
            if cut:
                gone = np.zeros(len(ws), bool)
                for c in cut:
                    gone[c["lo"]:c["hi"]] = True
                keep = [w for w, x in zip(ws, gone.tolist()) if not x]
            rows.append((len(ws), len(ws) - len(keep), b" ".join(keep)))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2].decode("utf-8") for r in rows], pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept"])


def _digest(batches):
    for b in batches:
        kept = [hashlib.sha256(t.as_py().encode("utf-8")).hexdigest() for t in b.column(3)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(kept, pa.string())],
                                         names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def repeated_ranges(spark: SparkSession, docs: DataFrame, window: int = WINDOW, k: int = SEED) -> DataFrame:
    """``k, lo, hi``: word ranges that recurring windows cover, by row key
    (a hash of id and text; equal rows share it and their ranges)."""
    ship(spark)
    src = docs.select(F.xxhash64("doc_id", "text").alias("_k"), "text")
    counted = (src.select("text").mapInArrow(_count_seeds(window, k), "shard int, seed binary, n binary")
               .groupBy("shard").applyInPandas(_recurring, "seed long, n long"))
    counted = stored(spark, counted, "seeds")
    total = counted.agg(F.sum("n")).first()[0] or 0
    bound = max(HOT_SEED, total // MAX_HOT)
    hot = {r.seed % (1 << 64): r.n for r in counted.where(F.col("n") > bound).toLocalIterator()}
    hot = spark.sparkContext.broadcast(hot)
    bits = spark.sparkContext.broadcast(membership(counted, "seed"))
    shards = max(MIN_SHARDS, -(-int(total) // SHARD_STRETCHES))
    return (src.mapInArrow(_stretches(bits, hot, shards, window, k), _STRETCH)
            .groupBy("shard").applyInPandas(_locate(window), "k long, lo long, hi long"))


def without_repeats(spark: SparkSession, docs: DataFrame, window: int = WINDOW, k: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: the kept words joined by a space."""
    found = repeated_ranges(spark, docs, window, k).groupBy("k").agg(F.collect_set(F.struct("lo", "hi")).alias("cut"))
    kind = dict(docs.dtypes)["doc_id"]
    src = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("_k"))
    return (src.join(found, src["_k"] == found["k"], "left").select("doc_id", "text", "cut")
            .mapInArrow(_remove, f"doc_id {kind}, n_words long, n_removed long, kept string"))


def digests(rows: DataFrame) -> DataFrame:
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(_digest, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")
