"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target
and the raw corpus.

Two multinomials over hashed cells are counted on all data: the raw corpus
(every document) and the target (documents whose id is trusted). A feature is
a word (lower case, edge punctuation cut), the word's shape, or two shapes in
a row. The score of a document is the mean over its features of
log(p_target / p_raw); cells whose ratio is within ``floor`` of zero count as
zero, which keeps sampling noise of common words out. A document is kept when
its score reaches the threshold, the point of least error between two
histograms: the trusted documents and the rejected ones (labelled 0 or toxic).
It is never so high that more than ``MAX_LOST`` of the trusted documents are
lost; where the two do not overlap none is, and without rejected labels the
method rejects nothing.

A labelled document is part of the counts. Its score for the histograms is that
of a model without it (its own counts are taken out of both multinomials), so
the threshold holds for documents that the model has not seen.

Sizes: the cell tables are fixed (``WORD_CELLS + SHAPE_CELLS`` numbers are
broadcast, two such tables for the histograms). Labels are joined to documents:
all of them are used, in counts and histograms alike, and no list of ids is held.

Edge cases: NULL or empty text has no words, fails the base rule (under 50
words) and scores 0. Without trusted documents the threshold is minus
infinity, so the method rejects nothing. Repeated rows are scored alike, and
columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch, memo, mix, rolling, ship, stored, use_memos, word_hashes, words

WORD_CELLS = 1 << 19
SHAPE_CELLS = 1 << 17
CELLS = WORD_CELLS + SHAPE_CELLS
SLICE = 1 << 13
BIN = 1.0 / 4096
#: Label ids that are joined by a broadcast (some 50 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: Share of the trusted documents that the threshold may lose at most.
MAX_LOST = 0.02
#: Log-ratios nearer to zero than this count as zero.
FLOOR = 0.5
MIN_WORDS = 50
MAX_REPEAT_PCT = 50

_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\r\x0b\x0c"
_RUN = re.compile(rb"(.)\1+", re.S)
_SHAPE = bytes(57 if 48 <= c < 58 else 65 if 65 <= c < 91 else
               97 if 97 <= c < 123 or c >= 128 else c for c in range(256))


class _Cells(dict):
    """word -> word cell and shape hash, packed in one integer."""

    def __missing__(self, w: bytes) -> int:
        word = xxhash.xxh3_64_intdigest(w.lower().strip(b".,;:!?")) % WORD_CELLS
        shape = xxhash.xxh3_64_intdigest(_RUN.sub(rb"\1", w.translate(_SHAPE))) >> 32
        v = word | (shape << 24)
        if len(self) < 400_000:
            self[w] = v
        return v


_CELLS = memo("quality", _Cells())


def features(ws: list[bytes]) -> np.ndarray:
    """Cell of every feature of a document."""
    if not ws:
        return np.empty(0, np.int64)
    v = np.fromiter(map(_CELLS.__getitem__, ws), np.uint64, len(ws))
    shape = v >> np.uint64(24)
    pair = mix(shape[:-1] * np.uint64(1_000_003) + shape[1:])
    cut = np.uint64(SHAPE_CELLS - 1)
    return np.concatenate([v & np.uint64(0xFFFFFF), (mix(shape) & cut) + np.uint64(WORD_CELLS),
                           (pair & cut) + np.uint64(WORD_CELLS)]).astype(np.int64)


def base_rules(text: str | None, ws: list[bytes]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0
    b = text.encode("utf-8")
    chars = len(text) - (len(b) - len(b.translate(None, _SPACE)))
    symbols = len(b) - len(b.translate(None, _SYMBOLS))
    dup = 0
    lines = text.split("\n")
    if len(lines) > 1:
        with_word = [x for x in lines if x.strip(" \t\r\x0b\x0c")]
        dup = len(with_word) - len(set(with_word))
    repeat = 0
    if len(ws) >= 4:
        g = rolling(word_hashes(ws), 3)
        _, back, n = np.unique(g, return_inverse=True, return_counts=True)
        again = n[back] >= 2
        if again.any():
            covered = np.zeros(len(ws), bool)
            for j in range(3):
                covered[j:j + len(again)] |= again
            repeat = int(covered.sum())
    return chars, symbols, dup, repeat


def flags(spark: SparkSession, labels: DataFrame) -> DataFrame:
    """``_id, trusted, rejected`` of every label id: labelled good and not toxic,
    and labelled poor or toxic. An id with several label rows can be both."""
    trusted, rejected = (F.col("quality") == 1) & (F.col("toxic") == 0), (F.col("quality") == 0) | (F.col("toxic") == 1)
    got = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("_id"))
           .agg(*[F.max(F.coalesce(c, F.lit(False))).alias(n) for c, n in ((trusted, "trusted"), (rejected, "rejected"))]))
    # written first, so the texts need no shuffle where the ids are few enough for a broadcast
    got = stored(spark, got, "labels")
    return F.broadcast(got) if got.count() <= BROADCAST_IDS else got


def marked(docs: DataFrame, flagged: DataFrame, how: str = "left") -> DataFrame:
    """``text, trusted, rejected`` of every document (``inner``: of the labelled ones)."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(
        flagged, F.col("doc_id") == F.col("_id"), how)
    return rows.select("text", *[F.coalesce(n, F.lit(False)).alias(n) for n in ("trusted", "rejected")])


def least_error(bins: list[int], trusted: list[float], rejected: list[float], max_lost: float = 1.0) -> float:
    """Threshold with the fewest labelled documents judged wrongly, the lowest
    such, of those that lose at most the share ``max_lost`` of the trusted;
    ``bins`` rise. It lies midway between the bins it parts."""
    best, threshold = sum(rejected), float("-inf")
    lost, kept = 0, sum(rejected)
    for k in range(1, len(bins)):
        lost, kept = lost + trusted[k - 1], kept - rejected[k - 1]
        if lost > max_lost * sum(trusted):
            break
        if lost + kept < best:
            best, threshold = lost + kept, (bins[k - 1] + 1 + bins[k]) * BIN / 2
    return threshold


_PARTS = (slice(0, WORD_CELLS), slice(WORD_CELLS, CELLS))


def log_ratio(raw: np.ndarray, tgt: np.ndarray, floor: float = FLOOR) -> np.ndarray:
    """log(p_target / p_raw) of every cell, add-one smoothed; 0 within ``floor``."""
    ratio = np.zeros(CELLS)
    for k in _PARTS:
        n = k.stop - k.start
        ratio[k] = (np.log((tgt[k] + 1) / (tgt[k].sum() + n)) - np.log((raw[k] + 1) / (raw[k].sum() + n)))
    ratio[np.abs(ratio) < floor] = 0.0
    return ratio


def score_without(f: np.ndarray, raw: np.ndarray, tgt: np.ndarray, totals: np.ndarray, trusted: bool,
                  floor: float = FLOOR) -> float:
    """Score of a document of the corpus under the model without it. ``f`` are
    its features, ``totals`` the sums (raw, target) of both parts of the cells."""
    cell, own = np.unique(f, return_counts=True)
    of_shape = cell >= WORD_CELLS
    mine = np.array([own[~of_shape].sum(), own[of_shape].sum()])
    part = of_shape.astype(np.int64)
    size = np.array([k.stop - k.start for k in _PARTS])
    r = (raw[cell] - own + 1) / (totals[0] - mine + size)[part]
    t = (tgt[cell] - own * trusted + 1) / (totals[1] - mine * trusted + size)[part]
    ratio = np.log(t) - np.log(r)
    ratio[np.abs(ratio) < floor] = 0.0
    return float((ratio * own).sum() / len(f))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, floor: float = FLOOR) -> dict:
    """Ratio of every cell and the threshold."""
    ship(spark)
    flagged = flags(spark, labels)
    # without trusted labels nothing is rejected
    any_trusted = bool(flagged.where("trusted").take(1))
    src = marked(docs, flagged)

    def count(batches):
        use_memos("quality")
        raw, tgt = np.zeros(CELLS, np.int64), np.zeros(CELLS, np.int64)
        lots = {id(raw): [], id(tgt): []}

        def flush(into, least):
            lot = lots[id(into)]
            if sum(map(len, lot)) >= least:
                into += np.bincount(np.concatenate(lot or [np.empty(0, np.int64)]), minlength=CELLS)
                lot.clear()

        for b in batches:
            for t, is_trusted in zip(b.column(0), b.column(1).to_pylist()):
                f = features(words(t.as_py()))
                lots[id(raw)].append(f)
                if is_trusted:
                    lots[id(tgt)].append(f)
                if len(lots[id(raw)]) >= 500 or len(f) > 100_000:
                    flush(raw, 1)
                    flush(tgt, 1)
        flush(raw, 0)
        flush(tgt, 0)
        for s in range(CELLS // SLICE):
            k = slice(s * SLICE, (s + 1) * SLICE)
            if raw[k].any():
                yield batch(s=(pa.int32(), [s]), raw=(pa.binary(), [raw[k].astype("<u4").tobytes()]),
                            tgt=(pa.binary(), [tgt[k].astype("<u4").tobytes()]))

    def total(pdf):
        import pandas as pd
        out = {"s": [int(pdf["s"].iloc[0])]}
        for c in ("raw", "tgt"):
            out[c] = [sum(np.frombuffer(x, "<u4").astype(np.int64) for x in pdf[c]).astype("<i8").tobytes()]
        return pd.DataFrame(out)

    raw, tgt = np.zeros(CELLS), np.zeros(CELLS)
    parts = src.mapInArrow(count, "s int, raw binary, tgt binary")
    for r in parts.groupBy("s").applyInPandas(total, "s int, raw binary, tgt binary").collect():
        k = slice(r.s * SLICE, (r.s + 1) * SLICE)
        raw[k] = np.frombuffer(bytes(r.raw), "<i8")
        tgt[k] = np.frombuffer(bytes(r.tgt), "<i8")
    table = spark.sparkContext.broadcast(log_ratio(raw, tgt, floor))
    counts = spark.sparkContext.broadcast((raw, tgt, np.array([[c[k].sum() for k in _PARTS] for c in (raw, tgt)])))

    def histogram(batches):
        use_memos("quality")
        bins: dict[int, list[int]] = {}
        for b in batches:
            good, bad = (b.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
            for i in range(b.num_rows):
                ws = words(b.column(0)[i].as_py())
                if len(ws) >= MIN_WORDS:  # the base rule decides on shorter ones
                    score = score_without(features(ws), *counts.value, bool(good[i]), floor)
                    n = bins.setdefault(int(np.floor(score / BIN)), [0, 0])
                    n[0] += int(good[i])
                    n[1] += int(bad[i])
        if bins:
            yield batch(bin=(pa.int64(), list(bins)), good=(pa.int64(), [n[0] for n in bins.values()]),
                        bad=(pa.int64(), [n[1] for n in bins.values()]))

    known = marked(docs, flagged, "inner").where("trusted or rejected")
    got = (known.mapInArrow(histogram, "bin long, good long, bad long").groupBy("bin")
           .agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).orderBy("bin").collect()) if any_trusted else []
    threshold = least_error([r.bin for r in got], [r.good for r in got], [r.bad for r in got], MAX_LOST)
    return {"table": table, "threshold": threshold}


def score_documents(docs: DataFrame, model: dict) -> DataFrame:
    """Counts, score and verdict of every document."""
    table, threshold = model["table"], model["threshold"]

    def run(batches):
        use_memos("quality", "words")
        for b in batches:
            ids = b.column(0)
            out = []
            for t in b.column(1):
                t = t.as_py()
                ws = words(t)
                f = features(ws)
                score = float(table.value[f].mean()) if len(f) else 0.0
                rule = base_rules(t, ws)
                failed = len(ws) < MIN_WORDS or 100 * rule[3] > MAX_REPEAT_PCT * len(ws)
                out.append((len(ws), *rule, failed, not failed and score >= threshold, score))
            cols = list(zip(*out)) if out else [[]] * 8
            names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [ids] + [pa.array(list(c), type=k) for c, k in zip(cols, kinds)],
                names=["doc_id", *names, "base_failed", "kept", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
             "n_repeat_words long, base_failed boolean, kept boolean, score double")


def verdict(model: dict, text: Column) -> Column:
    """Boolean column: the document stays. For filters that keep all columns."""
    table, threshold = model["table"], model["threshold"]

    @F.pandas_udf("boolean")
    def keep(texts):
        import pandas as pd
        use_memos("quality", "words")
        out = []
        for t in texts:
            ws = words(t)
            f = features(ws)
            ok = len(ws) >= MIN_WORDS and 100 * base_rules(t, ws)[3] <= MAX_REPEAT_PCT * len(ws)
            out.append(ok and float(table.value[f].mean()) >= threshold)
        return pd.Series(out, dtype=bool)

    return keep(text)
