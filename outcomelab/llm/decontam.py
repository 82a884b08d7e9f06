"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

A document is contaminated by an item when some run of its words is within
``max_edits(m) = floor((1 - similarity) * m)`` word edits (insert, delete,
replace) of the item's ``m`` words. Words are lower-cased.

1. Pigeonhole: such a run shares ``q = floor((m - e) / (e + 1))`` words in a
   row with the item (from 1 to 4 are asked for), and ``m - e`` words in all.
   Only item-sized windows that do are looked at; nothing is lost here.
2. Every item-sized window there, and the item, are embedded by the CGK random
   walk: at each of ``3 m`` steps the current word is written and a random bit
   of (step, word) says whether to move on. Edit distance becomes Hamming
   distance, and the walks meet again after an edit.
3. ``REPEATS`` walks, each sampled at ``SAMPLES`` random steps, give the LSH
   keys; a window and an item that agree in one key are a candidate.
4. Candidates are verified by the exact edit distance of the item to the best
   run of words around the window.

Items are handled in blocks of at most ``BLOCK_ITEMS``, each broadcast; a
document is never shuffled.

Edge cases: items or texts that are NULL or without words match nothing;
repeated items and repeated documents each give their own rows; rows with a
NULL id are reported with a NULL id. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch, mix, rolling, ship, word_hashes, use_memos, words

BLOCK_ITEMS = 5_000
REPEATS = 32
SAMPLES = 3
SIMILARITY = 0.8
LOT_WORDS = 2_000_000
LOT_WINDOWS = 20_000


def max_edits(m: int, similarity: float = SIMILARITY) -> int:
    return int((1 - similarity) * m + 1e-9)


def _walk_keys(seq: np.ndarray, m: np.ndarray) -> np.ndarray:
    """LSH keys, one column per walk, of rows of word hashes. Row k holds
    ``m[k]`` words and zeros after them; sampled steps are shares of ``3 m``."""
    rows = len(seq)
    line = np.arange(rows)
    out = np.empty((rows, REPEATS), np.uint64)
    for r in range(REPEATS):
        rng = np.random.default_rng(1_000_003 + r)
        at = (3 * m[:, None] * np.sort(rng.random(SAMPLES))).astype(np.int64)
        steps = int(at.max(initial=0)) + 1
        odd = rng.integers(0, 1 << 63, size=3 * seq.shape[1] + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        pos = np.zeros(rows, np.int64)
        got = np.zeros((rows, SAMPLES), np.uint64)
        for step in range(steps):
            word = seq[line, pos]
            for j in range(SAMPLES):
                k = at[:, j] == step
                if k.any():
                    got[k, j] = word[k]
            pos += ((word * odd[step]) >> np.uint64(63)).astype(np.int64)
            np.minimum(pos, m, out=pos)
        key = np.full(rows, r, np.uint64)
        for j in range(SAMPLES):
            key = mix(key * np.uint64(3) + got[:, j])
        out[:, r] = key
    return out


def edit_best(item: np.ndarray, run: np.ndarray) -> tuple[int, int]:
    """Least edit distance of ``item`` to any part of ``run``, and the end of
    the first such part."""
    n = len(run)
    row = np.zeros(n + 1, np.int64)
    idx = np.arange(n + 1)
    for i, w in enumerate(item, 1):
        new = np.empty(n + 1, np.int64)
        new[0] = i
        new[1:] = np.minimum(row[:-1] + (run != w), row[1:] + 1)
        row = np.minimum.accumulate(new - idx) + idx
    end = int(np.argmin(row))
    return int(row[end]), end


class Items:
    """One block of items, ready for matching."""

    def __init__(self, rows, similarity: float = SIMILARITY):
        self.ids, self.seq, self.edits = [], [], []
        for item_id, text in rows:
            ws = words(text, True)
            if ws:
                self.ids.append(item_id)
                self.seq.append(word_hashes(ws).copy())
                self.edits.append(max_edits(len(ws), similarity))
        self.vocab = [np.unique(s) for s in self.seq]
        self.width = max(map(len, self.seq), default=0)
        by_q: dict[int, list[int]] = {}
        for i, (s, e) in enumerate(zip(self.seq, self.edits)):
            by_q.setdefault(min(max(1, (len(s) - e) // (e + 1)), 4), []).append(i)
        self.grams = []
        for q, who in sorted(by_q.items()):
            flat = np.concatenate([rolling(self.seq[i], q) for i in who])
            own = np.repeat(who, [len(self.seq[i]) - q + 1 for i in who])
            k = np.lexsort((own, flat))
            flat, own = flat[k], own[k]
            new = np.r_[True, (flat[1:] != flat[:-1]) | (own[1:] != own[:-1])]
            mask = np.zeros(1 << 20, bool)
            mask[(flat >> np.uint64(44)).astype(np.int64)] = True
            self.grams.append((q, flat[new], own[new], mask))
        if self.ids:
            m = np.array([len(s) for s in self.seq])
            seq = np.zeros((len(m), self.width + 1), np.uint64)
            for k, s in enumerate(self.seq):
                seq[k, :len(s)] = s
            self.keys = _walk_keys(seq, m)

    def near(self, h: np.ndarray):
        """(item, starts) whose windows share a run of words with the item and
        hold enough of its words to be within the edit bound."""
        for q, gram, own, mask in self.grams:
            g = rolling(h, q)
            at = np.flatnonzero(mask[(g >> np.uint64(44)).astype(np.int64)]) if len(g) else ()
            if not len(at):
                continue
            lo, hi = np.searchsorted(gram, g[at], "left"), np.searchsorted(gram, g[at], "right")
            n = hi - lo
            if not n.any():
                continue
            pos = np.repeat(at, n)
            item = own[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            k = np.argsort(item, kind="stable")
            pos, item = pos[k], item[k]
            cut = np.flatnonzero(np.r_[True, item[1:] != item[:-1]])
            for a, z in zip(cut, np.append(cut[1:], len(item))):
                i, p = int(item[a]), pos[a:z]
                m, e = len(self.seq[i]), self.edits[i]
                new = np.flatnonzero(np.r_[True, np.diff(p) > 2 * (m + e)])
                for x, y in zip(new, np.append(new[1:], len(p))):
                    first, last = max(0, int(p[x]) - (m + e - q)), min(len(h), int(p[y - 1]) + m + 2 * e + q)
                    seg = h[first:last]
                    v = self.vocab[i]
                    own_word = v[np.minimum(np.searchsorted(v, seg), len(v) - 1)] == seg
                    sums = np.concatenate([[0], np.cumsum(own_word)])
                    s = np.arange(len(seg))
                    enough = sums[np.minimum(s + m + e, len(seg))] - sums[s] >= m - e
                    cover = np.zeros(len(seg) + 1, np.int64)
                    np.add.at(cover, np.maximum(p[x:y] - (m + e - q) - first, 0), 1)
                    np.add.at(cover, np.minimum(p[x:y] + e - first, len(seg) - 1) + 1, -1)
                    starts = first + np.flatnonzero(enough & (np.cumsum(cover)[:-1] > 0))
                    if len(starts):
                        yield i, starts

    def hits(self, docs: list[np.ndarray]) -> list[tuple[int, int, int, int]]:
        """(document, item, end, edits): the best match of each item in each
        of the documents' word hashes."""
        doc, item, start = [], [], []
        for d, h in enumerate(docs):
            for i, s in self.near(h) if self.ids else ():
                doc.append(np.full(len(s), d))
                item.append(np.full(len(s), i))
                start.append(s)
        if not doc:
            return []
        doc, item, start = np.concatenate(doc), np.concatenate(item), np.concatenate(start)
        sizes = np.array([len(s) for s in self.seq])
        agree = np.zeros(len(doc), bool)
        for a in range(0, len(doc), LOT_WINDOWS):
            z = min(a + LOT_WINDOWS, len(doc))
            m = sizes[item[a:z]]
            seq = np.zeros((z - a, self.width + 1), np.uint64)
            for k in range(z - a):
                part = docs[doc[a + k]][start[a + k]:start[a + k] + m[k]]
                seq[k, :len(part)] = part
            agree[a:z] = (_walk_keys(seq, m) == self.keys[item[a:z]]).any(axis=1)
        out = []
        doc, item, start = doc[agree], item[agree], start[agree]
        k = np.lexsort((start, item, doc))
        doc, item, start = doc[k], item[k], start[k]
        new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])]) if len(doc) else ()
        for a, z in zip(new, np.append(new[1:], len(doc)) if len(doc) else ()):
            h, i = docs[doc[a]], int(item[a])
            m, e, best = len(self.seq[i]), self.edits[i], None
            s = start[a:z]
            cut = np.flatnonzero(np.r_[True, np.diff(s) > m + e])
            for x, y in zip(cut, np.append(cut[1:], len(s))):
                lo, hi = max(0, int(s[x]) - e), min(len(h), int(s[y - 1]) + m + e)
                d, end = edit_best(self.seq[i], h[lo:hi])
                if d <= e and (best is None or d < best[1]):
                    best = (lo + end, d)
            if best is not None:
                out.append((int(doc[a]), i, *best))
        return out


def _lots(texts):
    """Word hashes of the texts, in lots of about LOT_WORDS words."""
    lot, held = [], 0
    for t in texts:
        ws = words(t, True)
        lot.append(word_hashes(ws))
        held += len(ws)
        if held >= LOT_WORDS:
            yield lot
            lot, held = [], 0
    if lot:
        yield lot


def _blocks(items: DataFrame, block: int):
    """The items in blocks of bounded size."""
    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    n = max(1, -(-rows.count() // block))
    for b in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        yield [(r.item_id, r.text) for r in part.toLocalIterator()]


def matches(spark: SparkSession, docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY,
            block: int = BLOCK_ITEMS) -> DataFrame:
    """``doc_id, item_id, end_word, n_words, edits``: each document and item
    that match, with the best place (the word index after its end)."""
    ship(spark)
    out = None
    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    for rows in _blocks(items, block):
        held = spark.sparkContext.broadcast(Items(rows, similarity))

        def run(batches, held=held):
            use_memos("words")
            it = held.value
            for b in batches:
                got, at = [], 0
                ids = b.column(0).to_pylist()
                for lot in _lots(t.as_py() for t in b.column(1)):
                    got += [(ids[at + d], it.ids[k], end, len(it.seq[k]), n) for d, k, end, n in it.hits(lot)]
                    at += len(lot)
                cols = list(zip(*got)) if got else [[]] * 5
                yield batch(**{c: (pa.int64(), list(v)) for c, v in
                               zip(("doc_id", "item_id", "end_word", "n_words", "edits"), cols)})

        part = src.mapInArrow(run, "doc_id long, item_id long, end_word long, n_words long, edits long")
        out = part if out is None else out.unionByName(part)
    return out


def clean(spark: SparkSession, text: Column, items: DataFrame, similarity: float = SIMILARITY,
          block: int = BLOCK_ITEMS) -> Column:
    """Boolean column: no item matches the text. For filters that keep all columns."""
    ship(spark)
    held = [spark.sparkContext.broadcast(Items(rows, similarity)) for rows in _blocks(items, block)]

    @F.pandas_udf("boolean")
    def ok(texts):
        import pandas as pd
        use_memos("words")
        out = []
        for lot in _lots(texts):
            part = np.ones(len(lot), bool)
            for x in held:
                part[[d for d, *_ in x.value.hits(lot)]] = False
            out.append(part)
        return pd.Series(np.concatenate(out) if out else [], dtype=bool)

    return ok(text)
