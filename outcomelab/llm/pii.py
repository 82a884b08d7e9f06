"""Personal data: candidate spans scored by gradient-boosted trees.

Base spans follow fixed formats (email, ip, card, phone) and always stay.
High-recall generators also propose overlapping candidate spans: tokens with
digits, runs of digits with separators, tokens with ``@`` or a spelled "at",
and values after a key word. Boosted trees use the span's format and its
context; the margin is calibrated on held-out candidates, and the threshold is
the least calibrated probability that reaches ``PRECISION`` there. Chosen
candidates that overlap no base span and no better candidate are added.

The trees are fitted on the candidates of all documents (equal spans after the
same text count once): tasks keep the bins of theirs and a pass returns the
gradient sums by feature and bin, two passes a tree. Sums are whole numbers, so
every run grows the same trees. The labels are weak: a candidate
is positive when it is a base span or carries a key (fixed forms below), and
negative otherwise.

All patterns take linear time: a run without blanks is cut first and looked at
once, whatever its length.

Edge cases: NULL or empty text has no spans (the digest is that of the empty
string). Without positive or without negative candidates nothing
is added. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomelab.operators.ordered import running

from .common import batch, ship, stored, use_memos

PRECISION = 0.99
ROUNDS = 40
RATE = 0.3
BINS = 24
#: Candidates a task of the fit reads.
FIT_ROWS = 100_000
#: Steps of the whole numbers in which sums are held, so that they are exact in any order.
FIXED, MOMENT = 2.0 ** 32, 2.0 ** 28
N_FEATURES = 21

#: Base kinds in their order, then the kinds that the method adds.
KINDS = ("email", "ip", "card", "phone", "secret", "number", "address")

# Digits cannot match a dot and a run is tried from its first digit only, so
# possessive runs and the look-behind change no match; they keep long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from their ``@``."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)
    return out


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """Base spans, by start and then kind."""
    if not text:
        return []
    out = [("email", a, z) for a, z in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            d = _digits(m.group())
            if 14 <= len(d) <= 19 and luhn(d):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m.group())) <= 15:
                out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


# Tried at the starts of tokens only, so a long token is read once.
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
_NUMBER = re.compile(r"[+(]?[0-9](?:[\x20().\-/]{0,2}[0-9])++")
_NAMED = re.compile(r"(?i)\b(?:password|passwd|pwd|token|secret|api[_-]?key)\s{0,2}[=:]\s{0,2}\"?[^\s\"]+\"?")
_AT = re.compile(r"(?i)[(\[]at[)\]] ?+[a-z0-9.-]++")
#: Fixed forms that make a candidate a positive example besides base spans.
_KEY = re.compile(r"AKIA[0-9A-Z]{16}|(?i:password|passwd|pwd|token|secret|api[_-]?key)\s{0,2}[=:]")


def spelled_addresses(text: str) -> list[tuple[int, int]]:
    """``name (at) host``, found from the bracket: the name is read backwards."""
    out, done = [], 0
    for m in _AT.finditer(text):
        start = end = m.start() - (m.start() > done and text[m.start() - 1] == " ")
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < end:
            out.append((start, m.end()))
            done = m.end()
    return out


def candidates(text: str | None) -> list[tuple[str, int, int]]:
    """Proposed spans of every generator; they may overlap."""
    if not text:
        return []
    out = []
    for m in _TOKEN.finditer(text):
        a, z = m.span()
        while a < z and text[a] in "\"'([<":
            a += 1
        while z > a and text[z - 1] in "\"').,;:!?]>":
            z -= 1
        if z - a >= 4:
            out.append(("address" if "@" in text[a:z] else "secret", a, z))
    for m in _NUMBER.finditer(text):
        if len(_digits(m.group())) >= 7:
            out.append(("number", *m.span()))
    low = "=" in text or ":" in text
    out += [("secret", *m.span()) for m in _NAMED.finditer(text)] if low else []
    if "at)" in text.lower() or "at]" in text.lower():
        out += [("address", *x) for x in spelled_addresses(text)]
    return out


def features(text: str, span: tuple[str, int, int]) -> list[float]:
    kind, a, z = span
    s = text[a:z]
    n = len(s)
    digits = _digits(s)
    letters = sum(c.isalpha() for c in s)
    upper = sum(c.isupper() for c in s)
    runs = re.findall(r"[0-9]+", s)
    turns = sum(x.isdigit() != y.isdigit() for x, y in zip(s, s[1:]))
    before, after = text[max(0, a - 12):a], text[z:z + 2]
    return [KINDS.index(kind), min(n, 200), len(digits), letters, upper, len(runs),
            max(map(len, runs), default=0), turns / n, s.count("."), s.count("-"), s.count(" "),
            s.count("@"), float("+" in s), float("(" in s or ")" in s), float("=" in s or ":" in s),
            float(14 <= len(digits) <= 19 and luhn(digits)), len(set(s)) / n,
            float(before[-1:].isalnum()), float("=" in before or ":" in before), float(after[:1].isalnum()),
            max((int(r) for r in runs if len(r) < 5), default=0)]


class Boosted:
    """Depth-2 trees on binned features, logistic loss."""

    def __init__(self, edges: list[np.ndarray], start: float):
        self.edges, self.start = edges, start
        self.trees: list[tuple] = []

    def bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T)]).astype(np.uint8)

    @staticmethod
    def split(sums: np.ndarray) -> tuple[int, int]:
        """Feature and last bin of the left side, from (feature, g and h, bin) sums."""
        best = (-1.0, 0, 0)
        for f, (g, h) in enumerate(sums):
            gs, hs = np.cumsum(g), np.cumsum(h)
            gain = gs ** 2 / (hs + 1) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1)
            k = int(np.argmax(gain))
            if gain[k] > best[0] + 1e-9:
                best = (float(gain[k]), f, k)
        return best[1], best[2]

    def grow(self, sums) -> None:
        """One more tree; ``sums(root)`` gives the sums of the whole, or of both sides of a root."""
        (whole,) = sums(None)
        root = self.split(whole)
        sides = sums(root)
        low, high = (self.split(x) for x in sides)
        leaf = []
        for x, (f, k) in zip(sides, (low, high)):
            for part in (slice(0, k + 1), slice(k + 1, None)):
                g, h = x[f, :, part].sum(axis=1)
                leaf.append(float(RATE * g / (h + 1.0)))
        self.trees.append((root, low, high, leaf))

    def margin_of(self, binned: np.ndarray) -> np.ndarray:
        out = np.full(binned.shape[1], self.start)
        for root, low, high, leaf in self.trees:
            left = binned[root[0]] <= root[1]
            a, b = binned[low[0]] <= low[1], binned[high[0]] <= high[1]
            out += np.where(left, np.where(a, leaf[0], leaf[1]), np.where(b, leaf[2], leaf[3]))
        return out

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.margin_of(self.bin(x))


def calibrate(sums) -> tuple[float, float]:
    """Slope and shift of a logistic curve through held-out margins (Newton
    steps); ``sums(a, b)`` gives those of the residuals and of the weights."""
    a, b = 1.0, 0.0
    for _ in range(30):
        ga, gb, haa, hab, hbb = sums(a, b)
        ga, gb, haa, hbb = ga - 1e-3 * (a - 1), gb - 1e-3 * b, haa + 1e-3, hbb + 1e-3
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a + np.clip(da, -2, 2), b + np.clip(db, -2, 2)
        if abs(da) + abs(db) < 1e-8:
            break
    return float(a), float(b)


class Model:
    """Fitted trees, calibration and threshold; ``None`` trees add nothing."""

    def __init__(self, trees: Boosted | None = None, slope: float = 1.0, shift: float = 0.0):
        self.trees, self.slope, self.shift = trees, slope, shift
        self.threshold = 2.0

    def _probability(self, margin):
        return 1 / (1 + np.exp(-(self.slope * margin + self.shift)))

    def added(self, text: str | None, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        if self.trees is None or not text:
            return []
        free = [c for c in dict.fromkeys(candidates(text)) if not _overlaps(c, base)]
        if not free:
            return []
        p = self._probability(self.trees.margin(np.array([features(text, c) for c in free], float)))
        out: list[tuple[str, int, int]] = []
        taken = _Taken()
        for k in sorted(np.flatnonzero(p >= self.threshold).tolist(), key=lambda k: (-p[k], free[k][1], free[k][0])):
            if taken.add(free[k][1], free[k][2]):
                out.append(free[k])
        return out


def _overlaps(c, spans) -> bool:
    """``spans`` sorted by start; long span lists are searched from the left."""
    import bisect
    k = bisect.bisect_left(spans, c[2], key=lambda s: s[1])
    return any(s[2] > c[1] for s in spans[max(0, k - 8):k])


class _Taken:
    """Disjoint intervals, kept sorted."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def add(self, a: int, z: int) -> bool:
        import bisect
        k = bisect.bisect_left(self.starts, z)
        if k and self.ends[k - 1] > a:
            return False
        self.starts.insert(k, a)
        self.ends.insert(k, z)
        return True


def labelled(text: str) -> list[tuple[tuple[str, int, int], int, int]]:
    """Candidates of a text with their weak label and a hash of what they are."""
    base = base_spans(text)
    exact = {(a, z) for _, a, z in base}
    out = []
    for c in dict.fromkeys(candidates(text)):
        kind, a, z = c
        hit = (a, z) in exact or bool(_KEY.match(text, a, z))
        if not hit and _overlaps(c, base):
            continue  # part of a base span: neither
        key = f"{kind} {text[max(0, a - 12):a]}\0{text[a:z]}".encode()
        out.append((c, int(hit), xxhash.xxh3_64_intdigest(key) >> 4))
    return out


def _lots(trees: Boosted):
    """Candidates as lots of bins: ``held, b, y``."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            y, held = b.column(1).to_numpy().astype(np.uint8), b.column(2).to_numpy(zero_copy_only=False)
            binned = trees.bin(x)
            for part in (False, True):
                m = held == part
                if m.any():
                    yield batch(held=(pa.bool_(), [part]), b=(pa.binary(), [binned[:, m].tobytes()]),
                                y=(pa.binary(), [y[m].tobytes()]))
    return run


def _opened(batches):
    """Bins (feature, row) and labels of every lot."""
    for b in batches:
        for x, y in zip(b.column(1), b.column(2)):
            y = np.frombuffer(y.as_py(), np.uint8)
            yield np.frombuffer(x.as_py(), np.uint8).reshape(-1, len(y)), y.astype(float)


def _summed(lots: DataFrame, each, scale: float) -> np.ndarray:
    """Sum over all lots of the whole numbers that ``each`` gives for a lot: a task
    adds up its own, and the sum does not depend on how rows are dealt."""
    def run(batches):
        total = None
        for binned, y in _opened(batches):
            got = each(binned, y).astype(np.int64)
            total = got if total is None else total + got
        if total is not None:
            yield batch(v=(pa.binary(), [total.tobytes()]))

    return sum(np.frombuffer(bytes(r.v), np.int64) for r in lots.mapInArrow(run, "v binary").collect()) / scale


def _tree_sums(lots: DataFrame, trees: Boosted):
    def sums(root):
        def each(binned, y):
            q = 1 / (1 + np.exp(-trees.margin_of(binned)))
            g, h = np.rint((y - q) * FIXED), np.rint(q * (1 - q) * FIXED)
            left = None if root is None else binned[root[0]] <= root[1]
            sides = [slice(None)] if root is None else [left, ~left]
            return np.array([[[np.bincount(c[m], w[m], BINS + 1) for w in (g, h)] for c in binned] for m in sides])

        n = 1 if root is None else 2
        return _summed(lots, each, FIXED).reshape(n, len(trees.edges), 2, BINS + 1)
    return sums


def _curve_sums(lots: DataFrame, trees: Boosted):
    def sums(a, b):
        def each(binned, y):
            m = trees.margin_of(binned)
            p = 1 / (1 + np.exp(-(a * m + b)))
            w = p * (1 - p) + 1e-9
            return np.array([np.rint(v * MOMENT).sum() for v in ((y - p) * m, y - p, w * m ** 2, w * m, w)])
        return _summed(lots, each, MOMENT)
    return sums


def _least_margin(lots: DataFrame, trees: Boosted, slope: float, precision: float) -> float | None:
    """The last margin, from the likeliest on, up to which the share of positive
    candidates is at least ``precision``; equal margins are taken together."""
    def margins(batches):
        for binned, y in _opened(batches):
            yield batch(m=(pa.float64(), trees.margin_of(binned)), y=(pa.int64(), y.astype(np.int64)))

    at = (lots.mapInArrow(margins, "m double, y long").groupBy("m")
          .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("hit")))
    at = running(at, [F.col("m").desc() if slope > 0 else F.col("m").asc()], ["n", "hit"])
    good = at.where((F.col("hit_before") + F.col("hit")) / (F.col("n_before") + F.col("n")) >= precision)
    return good.agg((F.min if slope > 0 else F.max)("m")).first()[0]


def fit(spark: SparkSession, docs: DataFrame, fit_each: int | None = None) -> Model:
    """Trees from the candidates of all documents (``fit_each``: from about so
    many of either label, the least by hash)."""
    ship(spark)

    def run(batches):
        use_memos()
        for b in batches:
            xs, ys, hs = [], [], []
            for t in b.column(0):
                t = t.as_py()
                for c, y, h in labelled(t):
                    xs.append(features(t, c))
                    ys.append(y)
                    hs.append(h)
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.list_(pa.float64())), pa.array(ys, pa.int32()),
                                              pa.array(hs, pa.int64())], names=["x", "y", "h"])

    src = docs.where("text is not null").select("text")
    # 200 bytes a candidate: small next to the texts
    found = stored(spark, src.mapInArrow(run, "x array<double>, y int, h long"), "candidates")
    if fit_each:
        # the hash up to which candidates are taken, by label
        upto = {r.y: (1 << 60) if r.n <= fit_each else int((1 << 60) * (fit_each / r.n))
                for r in found.groupBy("y", "h").agg(F.lit(1)).groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
        found = found.where(F.col("h") < F.when(F.col("y") == 1, F.lit(upto.get(1, 0))).otherwise(F.lit(upto.get(0, 0))))
    # equal candidates may differ in what follows them: the least is taken
    got = found.groupBy("h", "y").agg(F.min("x").alias("x"))
    # every third in the order of the hash is held out
    placed = stored(spark, running(got, [F.col("h"), F.col("y")]).select("x", "y", (F.col("pos") % 3 == 0).alias("held")), "fit")
    n = {(r.held, r.y): r["count"] for r in placed.groupBy("held", "y").count().collect()}
    if len(n) < 4:
        return Model()
    cuts = F.array(*[F.lit(float(q)) for q in np.linspace(0, 1, BINS + 1)[1:-1]])
    edges = placed.where("not held").agg(*[F.percentile(F.col("x")[i], cuts) for i in range(N_FEATURES)]).first()
    p = min(max(n[False, 1] / (n[False, 0] + n[False, 1]), 1e-4), 1 - 1e-4)
    trees = Boosted([np.unique(e) for e in edges], float(np.log(p / (1 - p))))
    lots = (placed.repartition(-(-sum(n.values()) // FIT_ROWS)).mapInArrow(_lots(trees), "held boolean, b binary, y binary")
            .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        sums = _tree_sums(lots.where("not held"), trees)
        for _ in range(ROUNDS):
            trees.grow(sums)
        held = lots.where("held")
        model = Model(trees, *calibrate(_curve_sums(held, trees)))
        least = _least_margin(held, trees, model.slope, PRECISION)
        if least is not None:
            model.threshold = max(float(model._probability(np.array([least]))[0]), 0.5)
    finally:
        lots.unpersist()
    return model


def spelled(spans) -> str:
    return ",".join(f"{k}:{a}:{z}" for k, a, z in spans)


def find(docs: DataFrame, model: Model) -> DataFrame:
    """Counts, digest of base spans and all spans of every document."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        use_memos()
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            for t in b.column(1):
                t = t.as_py()
                base = base_spans(t)
                for c, k in zip(cols, KINDS):
                    if k in KINDS[:4]:
                        c.append(sum(s[0] == k for s in base))
                cols[4].append(hashlib.sha256(spelled(base).encode()).hexdigest())
                every = sorted(base + held.value.added(t, base), key=lambda s: (s[1], KINDS.index(s[0])))
                cols[5].append(spelled(every))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [b.column(0)] + [pa.array(c, k) for c, k in zip(cols, kinds)],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact_text(text: str | None, model: Model) -> str | None:
    if not text:
        return text
    base = base_spans(text)
    out, at = [], 0
    for k, a, z in sorted(base + model.added(text, base), key=lambda s: (s[1], KINDS.index(s[0]))):
        if a >= at:
            out += [text[at:a], f"[{k.upper()}]"]
        at = max(at, z)
    return "".join(out) + text[at:]


def redacted(spark: SparkSession, text: Column, model: Model) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping
    spans become one."""
    ship(spark)
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def run(texts):
        import pandas as pd
        use_memos()
        return pd.Series([redact_text(t, held.value) for t in texts], dtype=object)

    return run(text)
