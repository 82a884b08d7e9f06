"""Many class-balanced support vector machines fitted in one pass over the rows a step.

A grid search fits one machine per (fold, kernel width, C, class). They all
read the same rows, so they are fitted together: a *training set* (all rows
outside one fold, of one group if groups are given) has its own z-scores and
kernel width, its machines are the columns of one coefficient matrix, and a
step is one aggregate that returns the gradients of every matrix. There are two
kernels:

- ``Fourier``: the RBF kernel by random Fourier features (Rahimi and Recht,
  2007), which a task computes from its rows once per training set and step;
  they are not stored, so memory does not grow with the number of features.
  Categories are never listed: the projection of a category is a draw keyed by
  its text.
- ``Linear``: z-scores and one indicator a category, kept sparse.

A machine minimises ``lam / 2 * |v|^2 + mean_w loss(y z.v)``, ``lam = 1 / (C *
sum of weights)``, over z with a constant appended. The loss is the hinge with
its corner rounded over ``DELTA``. Its dual is explicit, so every step also
gives the duality gap of every machine: a bound on how far its objective is
from the optimum, whatever the optimiser did. Machines stop at ``gap``.

Newton steps go along a path of smooth hinges ``tau log(1 + exp(u / tau))``,
widest first (``SMOOTH``), as a corner that is narrow from the start makes them
zigzag. The slopes of a smooth hinge are weights from 0 to 1, so they are a dual
point of the rounded hinge too, and its gap is measured from the first pass on;
for a wide ``gap`` the path ends before its narrowest hinge does. The last stage
is the rounded hinge itself: it is piecewise quadratic, so steps end at the
optimum once they know which rows stand on the corner. Rows beyond it have no
curvature; they are given a share of that of the parabola through their loss
(``damp``), which falls with every full step and rises when a step fails.
The machine of another fold with the same width, C and class differs by a fifth
of its rows; the first fold's machines end first, and those of other folds start
from them, at the narrowest smooth hinge.
All machines step together, each at its own stage and damping. A pass returns a gradient and a Hessian of
every machine that is not done; beyond ``NEWTON_WIDTH`` features, where a
Hessian would be too large, only gradients travel and the steps are L-BFGS.
Features are single numbers for gaps of ``SINGLE_GAP`` or more; sums are double.

What reaches the driver is fixed by parameters: means, variances and class
counts by (group, fold), and for each machine its coefficients, gradient and
Hessian (``Linear``: coefficients and gradient for each category). "Seen in
training" comes from a joined table of (group, category).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomelab.functions.draws import HASH_SPAN
from outcomelab.operators.ordered import category_index
from outcomelab.session import scratch_path, ship

DELTA = 0.1
# Widths of the smooth hinge on the way to the rounded one, and the share of a
# width that a step must promise to stay there.
SMOOTH = (1.0, 0.5, 0.3, 0.2, 0.13, 0.08, 0.05)
STAY = 0.1
# Gap left by the steps of the narrowest smooth hinge, at least.
SMOOTH_GAP = 1e-4
# Rows with less than this curvature (times the width) are left out of a smooth
# hinge's Hessian: they are flat. Losses, gradients and gaps have all rows.
FLAT = 1e-3
DAMP = 1e-3
SINGLE_GAP = 1e-4
NEWTON_WIDTH = 600
FEATURES = 200
GAP = 2e-3
MAX_STEPS = 300
MEMORY = 10
CHUNK = 4096
# Kernel entries (rows x training sets x features) a task computes in a step, at
# least. There are at most TASKS_PER_CORE tasks a core, as each sends the sums of
# all machines (39 MB for the 240 of the grid).
TASK_ENTRIES = 1_000_000
TASKS_PER_CORE = 1
# Partial sums added up in one task, before a last one adds those.
LOT = 64


# ---- rows and training sets ---------------------------------------------------

def training_rows(df: DataFrame, numeric: Sequence[str], categorical: str | None, label: str,
                  fold: str | None = None, group: str | None = None, index: DataFrame | None = None) -> DataFrame:
    """(grp, fold, label, cat, present, cat_id, num): ``num`` is ARRAY<DOUBLE>;
    bit f of ``present`` says that the category occurs in fold f of the group;
    ``cat_id`` comes from ``index`` (``category_index``) or is -1.

    Rows with a NULL or NaN number, NULL label, fold or group are not used. A
    NULL category is no category; without a fold column all rows are in fold 0.
    """
    xs = [f"_x{i}" for i in range(len(numeric))]
    out = df.select((F.col(group).cast("string") if group else F.lit("")).alias("grp"),
                    (F.col(fold).cast("int") if fold else F.lit(0)).alias("fold"),
                    F.col(label).cast("int").alias("label"),
                    (F.col(categorical).cast("string") if categorical else F.lit(None).cast("string")).alias("cat"),
                    *[F.col(c).cast("double").alias(x) for c, x in zip(numeric, xs)])
    out = out.na.drop(subset=["grp", "fold", "label", *xs]).withColumn("num", F.array(*xs)).drop(*xs)
    seen = (out.where(F.col("cat").isNotNull()).groupBy(F.col("grp").alias("_g"), F.col("cat").alias("_c"))
            .agg(F.bit_or(F.expr("shiftleft(1L, fold)")).alias("present")))
    out = out.join(seen, (F.col("grp") == F.col("_g")) & (F.col("cat") == F.col("_c")), "left")
    if index is None:
        at = F.lit(-1)
    else:
        out = out.join(index.select(F.col("category").alias("_i"), "category_id"), F.col("cat") == F.col("_i"), "left")
        at = F.coalesce("category_id", F.lit(-1))
    return out.select("grp", "fold", "label", "cat", F.coalesce("present", F.lit(0)).cast("long").alias("present"),
                      at.cast("long").alias("cat_id"), "num")


@dataclass
class TrainingSet:
    """Rows of ``group`` outside fold ``held_out`` (-1: all), with one width."""
    group: str
    held_out: int
    gamma: float
    mean: np.ndarray
    scale: np.ndarray
    counts: np.ndarray            # rows of each class
    weights: np.ndarray = field(init=False)

    def __post_init__(self):
        there = self.counts > 0
        n = float(self.counts.sum())
        self.weights = np.where(there, n / (max(int(there.sum()), 1) * np.maximum(self.counts, 1)), 0.0)


def training_sets(rows: DataFrame, d: int, k: int, gammas: Sequence[float], folds: int | None) -> list[TrainingSet]:
    """One per (group, held-out fold, gamma); a gamma of 0 or less means
    'scale': 1 / (features * variance of all entries of the training matrix).
    Variances are merged from per-fold means and squared deviations."""
    x = [F.col("num")[i] for i in range(d)]
    stats = (rows.groupBy("grp", "fold").agg(
        F.count(F.lit(1)).alias("n"), F.count("cat").alias("with_cat"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(x)],
        *[F.var_pop(c).alias(f"v{i}") for i, c in enumerate(x)],
        *[F.sum(F.when(F.col("label") == c, 1).otherwise(0)).alias(f"c{c}") for c in range(k)]).collect())
    present = (rows.where(F.col("cat").isNotNull()).groupBy("grp", "present")
               .agg(F.count_distinct("cat").alias("n")).collect())
    out = []
    for group in sorted({r["grp"] for r in stats}):
        mine = [r for r in stats if r["grp"] == group]
        for held in (range(folds) if folds else [-1]):
            part = [r for r in mine if r["fold"] != held]
            n = sum(r["n"] for r in part)
            if not n:
                continue
            mean = np.array([sum(r["n"] * r[f"m{i}"] for r in part) / n for i in range(d)])
            var = np.array([sum(r["n"] * (r[f"v{i}"] + (r[f"m{i}"] - mean[i]) ** 2) for r in part) / n
                            for i in range(d)])
            std = np.sqrt(var)
            cats = sum(r["n"] for r in present if r["grp"] == group
                       and (r["present"] & ~(1 << held) if held >= 0 else r["present"]))
            hot = sum(r["with_cat"] for r in part) / n
            width = d + cats
            entry = (float((std > 0).sum()) + hot) / width - (hot / width) ** 2
            for gamma in gammas:
                g = float(gamma) if gamma > 0 else (1.0 / (width * entry) if entry > 0 else 1.0)
                out.append(TrainingSet(group, held, g, mean, np.where(std > 0, std, 1.0),
                                       np.array([sum(r[f"c{c}"] for r in part) for c in range(k)], float)))
    return out


def _unit(key: str) -> float:
    """The draw of ``functions.draws`` for a key, in [0, 1)."""
    return float(int(hashlib.md5(key.encode()).hexdigest()[:15], 16)) / HASH_SPAN


def _normals(key: str, n: int) -> np.ndarray:
    """``n`` standard normal draws (Box and Muller), the same in every engine."""
    u = np.array([(_unit(f"{key}-{j}-a"), _unit(f"{key}-{j}-b")) for j in range(n)]).reshape(n, 2)
    return np.sqrt(-2.0 * np.log(1.0 - u[:, 0])) * np.cos(2.0 * math.pi * u[:, 1])


class _Dense:
    def __init__(self, z: np.ndarray):
        self.z = z

    def times(self, v: np.ndarray) -> np.ndarray:
        return (self.z @ v.astype(self.z.dtype, copy=False)).astype(float, copy=False)

    def back(self, r: np.ndarray) -> np.ndarray:
        return (self.z.T @ r.astype(self.z.dtype, copy=False)).astype(float, copy=False)

    def square(self, w: np.ndarray) -> np.ndarray:
        """Sum of w z z' for weights of at least 0: a product of one matrix with
        itself, which takes half the work of a product of two."""
        some = np.flatnonzero(w)
        z = self.z if len(some) == len(w) else self.z[some]
        z = z * np.sqrt(w[some]).astype(z.dtype, copy=False)[:, None]
        return z.T @ z


class _Indicator:
    """Numbers, one indicator (place -1: none) and the constant."""

    def __init__(self, num: np.ndarray, at: np.ndarray, width: int):
        self.num, self.ok, self.width = num, at >= 0, width
        self.at = at[self.ok] + num.shape[1]

    def times(self, v: np.ndarray) -> np.ndarray:
        out = self.num @ v[:self.num.shape[1]] + v[-1]
        out[self.ok] += v[self.at]
        return out

    def back(self, r: np.ndarray) -> np.ndarray:
        out = np.zeros((self.width, r.shape[1]))
        out[:self.num.shape[1]] = self.num.T @ r
        for j in range(r.shape[1]):
            out[:, j] += np.bincount(self.at, r[self.ok, j], self.width)
        out[-1] = r.sum(axis=0)
        return out


class Fourier:
    """Random projection of unit width: numbers by a matrix, a category by
    draws keyed by its text; features sqrt(2 / D) cos(sqrt(2 gamma) u + b)."""

    def __init__(self, d: int, features: int = FEATURES, seed: int = 42):
        self.matrix = np.stack([_normals(f"{seed}-num{i}", features) for i in range(d)]).reshape(d, features)
        self.offset = np.array([2.0 * math.pi * _unit(f"{seed}-offset-{j}") for j in range(features)])
        self.seed, self.width = seed, features + 1
        self.memo: dict[str, np.ndarray] = {}

    def prepare(self, cats: list, codes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        draws = np.zeros((len(cats) + 1, len(self.offset)))  # the last row: no category
        for i, c in enumerate(cats):
            got = self.memo.get(c)
            if got is None:
                got = _normals(f"{self.seed}-cat-{c}", len(self.offset))
                if len(self.memo) < 10_000:
                    self.memo[c] = got
            draws[i] = got
        return draws[codes]

    def design(self, num: np.ndarray, cat: np.ndarray, seen: np.ndarray, t: TrainingSet, single: bool = False) -> _Dense:
        u = ((num - t.mean) / t.scale) @ self.matrix
        u += cat if seen.all() else cat * seen[:, None]
        u *= math.sqrt(2.0 * t.gamma)
        u += self.offset
        if single:
            # whole turns go in double, so that a large angle loses nothing
            u *= 0.5 / math.pi
            u -= np.rint(u)
            u = u.astype(np.float32)
            u *= np.float32(2.0 * math.pi)
        z = np.ones((len(u), self.width), u.dtype)
        np.multiply(np.cos(u, out=u), math.sqrt(2.0 / len(self.offset)), out=z[:, :-1])
        return _Dense(z)


class Linear:
    """z-scores and an indicator for each of ``categories`` numbered ones;
    sparse where no Hessian is made."""

    def __init__(self, d: int, categories: int = 0):
        self.width = d + categories + 1

    def prepare(self, cats: list, codes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return ids

    def design(self, num: np.ndarray, cat: np.ndarray, seen: np.ndarray, t: TrainingSet, single: bool = False):
        num, at = (num - t.mean) / t.scale, np.where(seen > 0, cat, -1)
        if self.width > NEWTON_WIDTH:
            return _Indicator(num, at, self.width)
        z = np.zeros((len(num), self.width))
        z[:, :num.shape[1]], z[:, -1] = num, 1.0
        hot = np.flatnonzero(at >= 0)
        z[hot, num.shape[1] + at[hot]] = 1.0
        return _Dense(z)


def _chunks(batches):
    """(groups, group code, fold, label, categories, category code, present, cat_id, num,
    times) of at most ``CHUNK`` rows. Texts come once each; a code of -1 is NULL."""
    for b in batches:
        for at in range(0, b.num_rows, CHUNK):
            s = b.slice(at, CHUNK)
            num = s.column(6)
            num = num.flatten().to_numpy(zero_copy_only=False).reshape(s.num_rows, -1)
            grp, cat = s.column(0).dictionary_encode(), s.column(3).dictionary_encode()
            yield (grp.dictionary.to_pylist(), grp.indices.to_numpy(zero_copy_only=False),
                   s.column(1).to_numpy(), s.column(2).to_numpy(), cat.dictionary.to_pylist(),
                   cat.indices.fill_null(-1).to_numpy(zero_copy_only=False), s.column(4).to_numpy(),
                   s.column(5).to_numpy(), num, s.column(7).to_numpy() if s.num_columns > 7 else None)


def _rows_of(t: TrainingSet, groups: list, grp: np.ndarray, fold: np.ndarray, held: bool) -> np.ndarray:
    """Places of the rows that train (or, ``held``, that are held out of) a set."""
    if t.group not in groups:
        return np.empty(0, np.int64)
    mine = (fold == t.held_out) if held else (fold != t.held_out)
    if len(groups) > 1:
        mine &= grp == groups.index(t.group)
    return np.flatnonzero(mine)


def _seen(present: np.ndarray, t: TrainingSet) -> np.ndarray:
    mask = ~(1 << t.held_out) if t.held_out >= 0 else -1
    return ((present & mask) != 0).astype(float)


# ---- one step -------------------------------------------------------------------

def step(rows: DataFrame, parts: int, sets: list[TrainingSet], kernel, k: int, m: int, coefs: dict[int, np.ndarray],
         widths: dict[int, float], damps: dict[int, float] | None = None, single: bool = False) -> dict[int, np.ndarray]:
    """For each machine of ``coefs`` (number = set * m + column, class the
    fastest): its loss under the smooth hinge of its width (0: the rounded one)
    and under the rounded one, dual sum, loss gradient and, with ``damps``, the
    upper triangle of the (damped) loss Hessian, in one array. One job: a task
    adds up its rows, a second stage the tasks.
    """
    p = kernel.width
    second = damps is not None
    upper = np.triu_indices(p)
    by_set: dict[int, list[int]] = {}
    for i in sorted(coefs):
        by_set.setdefault(i // m, []).append(i)
    packed = {s: (np.array([coefs[i] for i in ids]).T.copy(), np.array([widths[i] for i in ids])) for s, ids in by_set.items()}

    def partial(batches):
        first: dict[int, np.ndarray] = {}
        hess: dict[int, np.ndarray] = {}
        for groups, grp, fold, label, cats, codes, present, places, num, times in _chunks(batches):
            cat = kernel.prepare(cats, codes, places)
            for s, (v, tau) in packed.items():
                t, ids = sets[s], by_set[s]
                take = _rows_of(t, groups, grp, fold, False)
                if not len(take):
                    continue
                y = label[take]
                z = kernel.design(num[take], cat[take], _seen(present[take], t), t, single)
                sign = np.where(y[:, None] == np.array(ids) % m % k, 1.0, -1.0)
                w = ((t.weights / t.counts.sum())[y] * times[take])[:, None]
                u = 1.0 - sign * z.times(v)
                a = np.clip(u / DELTA, 0.0, 1.0)
                corner = own = a * u - DELTA / 2 * a * a
                soft = np.flatnonzero(tau)
                if len(soft):
                    own = own.copy()
                    x = u[:, soft] / tau[soft]
                    e = np.exp(-np.abs(x))
                    a[:, soft] = np.where(x > 0, 1.0, e) / (1.0 + e)
                    own[:, soft] = tau[soft] * (np.maximum(x, 0.0) + np.log1p(e))
                grad = -z.back(w * a * sign)
                loss, dual = (w * corner).sum(axis=0), (w * (a - DELTA / 2 * a * a)).sum(axis=0)
                own = (w * own).sum(axis=0)
                for j, i in enumerate(ids):
                    sums = first.setdefault(i, np.zeros(p + 3))
                    sums += np.concatenate([[own[j], loss[j], dual[j]], grad[:, j]])
                    if second:
                        if tau[j]:
                            curve = a[:, j] * (1.0 - a[:, j])
                            curve = np.where(curve > FLAT, curve / tau[j], 0.0)
                        else:
                            over = u[:, j]
                            curve = np.where(over < DELTA, 1.0 / DELTA, damps[i] / np.maximum(over, DELTA))
                            curve = np.where(over > 0, curve, 0.0)
                        h = z.square(w[:, 0] * curve)
                        if i in hess:
                            hess[i] += h
                        else:
                            hess[i] = h.astype(float, copy=False)
        for i, sums in first.items():
            if second:
                sums = np.concatenate([sums, hess[i][upper]])
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([sums.tobytes()], pa.binary())], names=["i", "sums"])

    def total(pdf):
        import pandas as pd
        # one after the other, in an order that does not depend on the tasks
        out = None
        for x in sorted(pdf["sums"]):
            x = np.frombuffer(x)
            out = x.copy() if out is None else out + x
        return pd.DataFrame({"i": pdf["i"].iloc[:1], "sums": [out.tobytes()]})

    kind = "i int, sums binary"
    sums = rows.mapInArrow(partial, kind)
    if parts > LOT:
        sums = (sums.withColumn("lot", (F.spark_partition_id() / LOT).cast("int"))
                .groupBy("i", "lot").applyInPandas(total, kind))
    if parts > 1:
        sums = sums.groupBy("i").applyInPandas(total, kind)
    return {r["i"]: np.frombuffer(bytes(r["sums"])) for r in sums.collect()}


class _Search:
    """L-BFGS for many independent problems in lockstep: every evaluation is one
    shared pass, and each problem accepts or shortens its own step."""

    def __init__(self, n: int, p: int):
        self.s, self.y = np.zeros((MEMORY, n, p)), np.zeros((MEMORY, n, p))
        self.rho = np.zeros((MEMORY, n))

    def add(self, at: np.ndarray, s: np.ndarray, y: np.ndarray) -> None:
        sy = np.einsum("np,np->n", s, y)
        ok = sy > 1e-12 * np.einsum("np,np->n", y, y)
        at, s, y, sy = at[ok], s[ok], y[ok], sy[ok]
        for store, new in ((self.s, s), (self.y, y)):
            store[:-1, at] = store[1:, at]
            store[-1, at] = new
        self.rho[:-1, at] = self.rho[1:, at]
        self.rho[-1, at] = 1.0 / sy

    def direction(self, at: np.ndarray, g: np.ndarray) -> np.ndarray:
        q = g.copy()
        alpha = np.zeros((MEMORY, len(at)))
        for i in range(MEMORY - 1, -1, -1):
            alpha[i] = self.rho[i, at] * np.einsum("np,np->n", self.s[i, at], q)
            q -= alpha[i][:, None] * self.y[i, at]
        sy = 1.0 / np.where(self.rho[-1, at] > 0, self.rho[-1, at], 1.0)
        yy = np.einsum("np,np->n", self.y[-1, at], self.y[-1, at])
        q *= np.where(self.rho[-1, at] > 0, sy / np.where(yy > 0, yy, 1.0), 1.0)[:, None]
        for i in range(MEMORY):
            beta = self.rho[i, at] * np.einsum("np,np->n", self.y[i, at], q)
            q += (alpha[i] - beta)[:, None] * self.s[i, at]
        return -q


@dataclass
class Fit:
    """Machines of every training set: ``coefs[s][:, c * k + j]`` is class j
    under the c-th C; ``gaps[s]`` their duality gaps."""
    sets: list[TrainingSet]
    cs: list[float]
    k: int
    kernel: object
    coefs: list[np.ndarray]
    gaps: list[np.ndarray]
    steps: int


def task_count(rows: DataFrame, sets: int, width: int) -> int:
    """Tasks of about ``TASK_ENTRIES`` kernel entries, a few a core at most."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return max(1, min(math.ceil(rows.count() * sets * width / TASK_ENTRIES), TASKS_PER_CORE * cores))


def fit_many(rows: DataFrame, d: int, k: int, cs: Sequence[float], kernel, gammas: Sequence[float] = (1.0,),
             folds: int | None = None, gap: float = GAP, max_steps: int = MAX_STEPS) -> Fit:
    """Fit all machines of ``training_rows``; see the module. With ``folds``
    there is a training set for each held-out fold."""
    sets = training_sets(rows, d, k, gammas, folds)
    m = k * len(cs)
    if not sets:
        return Fit(sets, list(cs), k, kernel, [], [], 0)
    # weights of a set add up to its rows, so mean_w has total weight 1
    lam = np.concatenate([np.repeat([1.0 / (c * t.counts.sum()) for c in cs], k) for t in sets])
    # rows that repeat (a bootstrap draws each many times) are one row with a number
    rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("times")).persist(StorageLevel.MEMORY_AND_DISK)
    # an indicator is one entry, however many categories there are
    parts = task_count(rows, len(sets), d + 2 if isinstance(kernel, Linear) else kernel.width)
    ship(rows.sparkSession)
    dealt = rows.repartition(parts).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        solve = _newton if kernel.width <= NEWTON_WIDTH else _descend
        x, gaps, steps = solve(dealt, parts, sets, kernel, k, m, lam, gap, max_steps)
    finally:
        dealt.unpersist()
        rows.unpersist()
    return Fit(sets, list(cs), k, kernel, [x[s * m:(s + 1) * m].T.copy() for s in range(len(sets))],
               [gaps[s * m:(s + 1) * m] for s in range(len(sets))], steps)


def _newton(rows, parts, sets, kernel, k, m, lam, gap, max_steps):
    """Newton steps of all machines together; a machine that did not descend
    tries a shorter step in the next pass. ``max_steps`` is for each machine."""
    n, p = len(lam), kernel.width
    upper = np.triu_indices(p)
    last = len(SMOOTH)
    x, trial, direction = np.zeros((n, p)), np.zeros((n, p)), np.zeros((n, p))
    stage, t, damp, failed = np.zeros(n, int), np.ones(n), np.full(n, DAMP), np.zeros(n, bool)
    f, slope = np.full(n, np.inf), np.zeros(n)
    best, best_gap = np.zeros((n, p)), np.full(n, np.inf)
    done, taken = np.zeros(n, bool), np.zeros(n, int)
    # the same machine of the group's first fold (a fold has a set for each width)
    widths = sum((s.group, s.held_out) == (sets[0].group, sets[0].held_out) for s in sets)
    start = {}
    for s, one in enumerate(sets):
        start.setdefault((one.group, s % widths), s)
    lead = np.repeat([start[one.group, s % widths] for s, one in enumerate(sets)], m) * m + np.tile(np.arange(m), len(sets))
    steps = 0
    while not done.all():
        steps += 1
        live = [int(i) for i in np.flatnonzero(~done & ((lead == np.arange(n)) | done[lead]))]
        for i in live:
            if not taken[i] and lead[i] != i and np.isfinite(best_gap[lead[i]]):
                trial[i], stage[i] = best[lead[i]], last - 1
        got = step(rows, parts, sets, kernel, k, m, {i: trial[i] for i in live},
                   {i: SMOOTH[stage[i]] if stage[i] < last else 0.0 for i in live},
                   {i: float(damp[i] if failed[i] else damp[i] / 2) for i in live}, gap >= SINGLE_GAP)
        for i in live:
            sums = got.get(i, np.zeros(p + 3 + len(upper[0])))
            own, loss, dual, grad = sums[0], sums[1], sums[2], sums[3:p + 3]
            size = lam[i] / 2 * trial[i] @ trial[i]
            value, g = own + size, grad + lam[i] * trial[i]
            # the dual point of the machine: its loss gradient is - sum(a w y z)
            off = loss + size - (dual - grad @ grad / (2 * lam[i]))
            if off < best_gap[i]:
                best[i], best_gap[i] = trial[i], off
            taken[i] += 1
            done[i] = off <= gap or taken[i] >= max_steps
            if done[i]:
                continue
            if taken[i] == 1 and loss + size > 1.0:
                # a start that is worse than none
                trial[i], stage[i] = 0.0, 0
                continue
            if value > f[i] + 1e-4 * t[i] * slope[i] + 1e-14:
                # the least point of the parabola through both values
                fall = slope[i] * t[i]
                t[i] *= min(max(-fall / (2 * (value - f[i] - fall)), 0.1), 0.5)
                damp[i], failed[i] = min(max(3 * damp[i], 1e-6), 1.0), True
                done[i] = t[i] < 1e-10
                trial[i] = x[i] + t[i] * direction[i]
                continue
            if stage[i] == last and not failed[i]:
                damp[i] = damp[i] / 2 if damp[i] > 2e-8 else 0.0
            x[i], f[i], failed[i] = trial[i], value, False
            hess = np.zeros((p, p))
            hess[upper] = sums[p + 3:]
            hess += np.triu(hess, 1).T
            hess[np.arange(p), np.arange(p)] += lam[i]
            direction[i] = -np.linalg.solve(hess, g)
            slope[i] = direction[i] @ g
            t[i] = min(1.0, 2 * t[i])
            if stage[i] < last - 1:
                narrower = -slope[i] / 2 < STAY * SMOOTH[stage[i]]
            else:
                # the gap of the smooth objective itself
                narrower = stage[i] < last and g @ g / (2 * lam[i]) <= max(gap / 10, SMOOTH_GAP)
            if narrower:
                # a narrower hinge is nowhere above a wider one, so the step must descend from f as well
                stage[i], t[i], damp[i], failed[i] = stage[i] + 1, 1.0, DAMP, False
            trial[i] = x[i] + t[i] * direction[i]
    return best, best_gap, steps


def _descend(rows, parts, sets, kernel, k, m, lam, gap, max_steps):
    """L-BFGS steps of all machines together."""
    n, p = len(lam), kernel.width

    def evaluate(x: np.ndarray, live: np.ndarray):
        ids = [int(i) for i in np.flatnonzero(live)]
        got = step(rows, parts, sets, kernel, k, m, {i: x[i] for i in ids}, {i: 0.0 for i in ids})
        f, g, gaps = np.zeros(n), np.zeros((n, p)), np.full(n, np.inf)
        for i in ids:
            sums = got.get(i, np.zeros(p + 3))
            f[i] = sums[1] + lam[i] / 2 * x[i] @ x[i]
            g[i] = sums[3:] + lam[i] * x[i]
            gaps[i] = f[i] - (sums[2] - sums[3:] @ sums[3:] / (2 * lam[i]))
        return f, g, gaps

    x = np.zeros((n, p))
    f, g, gaps = evaluate(x, np.ones(n, bool))
    search = _Search(n, p)
    best, best_gap = x.copy(), gaps.copy()
    every = np.arange(n)
    direction = -g
    t = np.minimum(1.0 / np.maximum(np.linalg.norm(g, axis=1), 1e-12), 1.0 / np.maximum(lam, 1e-12))
    slope = np.einsum("np,np->n", direction, g)
    done = best_gap <= gap
    steps = 0
    while not done.all() and steps < max_steps:
        steps += 1
        trial = np.where(done[:, None], x, x + t[:, None] * direction)
        f2, g2, gaps = evaluate(trial, ~done)
        ok = ~done & (f2 <= f + 1e-4 * t * slope + 1e-14)
        better = ~done & (gaps < best_gap)
        best[better], best_gap[better] = trial[better], gaps[better]
        at = every[ok]
        search.add(at, trial[at] - x[at], g2[at] - g[at])
        x[at], f[at], g[at] = trial[at], f2[at], g2[at]
        direction[at] = search.direction(at, g[at])
        slope[at] = np.einsum("np,np->n", direction[at], g[at])
        wrong = at[slope[at] >= 0]
        direction[wrong], slope[wrong] = -g[wrong], -np.einsum("np,np->n", g[wrong], g[wrong])
        t[at] = 1.0
        t[~ok & ~done] *= 0.4
        done |= (best_gap <= gap) | (t < 1e-10)
    return best, best_gap, steps


# ---- predictions ------------------------------------------------------------------

def held_out_predictions(rows: DataFrame, fit: Fit) -> DataFrame:
    """(set, grp, c, fold, label, prediction): each row under every machine of
    the sets that held its fold out."""
    sets, coefs, kernel, k, n_c = fit.sets, fit.coefs, fit.kernel, fit.k, len(fit.cs)

    def run(batches):
        for groups, grp, fold, label, cats, codes, present, places, num, _ in _chunks(batches):
            cat = kernel.prepare(cats, codes, places)
            for s, t in enumerate(sets):
                take = _rows_of(t, groups, grp, fold, True)
                if not len(take):
                    continue
                z = kernel.design(num[take], cat[take], _seen(present[take], t), t)
                margin = z.times(coefs[s])
                n = len(margin)
                pred = margin.reshape(n, n_c, k).argmax(axis=2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n * n_c, s, np.int32)), pa.array([t.group] * (n * n_c)),
                     pa.array(np.tile(np.arange(n_c, dtype=np.int32), n)),
                     pa.array(np.repeat(fold[take], n_c).astype(np.int32)),
                     pa.array(np.repeat(label[take], n_c).astype(float)), pa.array(pred.ravel().astype(float))],
                    names=["set", "grp", "c", "fold", "label", "prediction"])

    return rows.mapInArrow(run, "set int, grp string, c int, fold int, label double, prediction double")


class SvmModel:
    """One training set and one C: adds ``rawPrediction`` (ARRAY<DOUBLE> of
    margins) and ``prediction`` to any rows with the feature columns. A category
    that training did not see, or NULL, adds nothing to the features."""

    def __init__(self, fit: Fit, s: int, c: int, numeric: Sequence[str], categorical: str | None,
                 index: DataFrame | None):
        self.set, self.kernel, self.k, self.c = fit.sets[s], fit.kernel, fit.k, fit.cs[c]
        self.coef = fit.coefs[s][:, c * fit.k:(c + 1) * fit.k]
        self.gap = float(fit.gaps[s][c * fit.k:(c + 1) * fit.k].max())
        self.numeric, self.categorical, self.index = list(numeric), categorical, index

    def transform(self, df: DataFrame) -> DataFrame:
        kernel, t, coef = self.kernel, self.set, self.coef

        @F.pandas_udf("array<double>")
        def margins(num, cat, ids):
            import pandas as pd
            out = []
            for at in range(0, len(num), CHUNK):
                x = np.array([np.asarray(v, float) for v in num.iloc[at:at + CHUNK]])
                place = ids.iloc[at:at + CHUNK].to_numpy(np.int64)
                codes, cats = pd.factorize(cat.iloc[at:at + CHUNK])
                z = kernel.design(x, kernel.prepare(list(cats), codes, place), (place >= 0).astype(float), t)
                out += list(z.times(coef))
            return pd.Series(out, dtype=object)

        keep = list(df.columns)
        num = F.array(*[F.col(c).cast("double") for c in self.numeric])
        if self.categorical:
            known = self.index.select(F.col("category").alias("_seen"), F.col("category_id").alias("_id"))
            cat = F.col(self.categorical).cast("string")
            df = df.join(known, cat == F.col("_seen"), "left")
            ids = F.coalesce("_id", F.lit(-1)).cast("long")
        else:
            cat, ids = F.lit(None).cast("string"), F.lit(-1).cast("long")
        out = df.withColumn("rawPrediction", margins(num, cat, ids)).select(*keep, "rawPrediction")
        best = F.array_position("rawPrediction", F.array_max("rawPrediction")) - 1
        return out.withColumn("prediction", best.cast("double"))


def fit_one(spark: SparkSession, train: DataFrame, numeric: Sequence[str], categorical: str | None, label: str,
            k: int, c: float, gamma: float | None = None, n_features: int = FEATURES, seed: int = 42,
            gap: float = GAP, max_steps: int = MAX_STEPS) -> SvmModel:
    """The one-vs-rest machines of one C on all of ``train``: linear without a
    ``gamma``, else of that width (0 or less: 'scale')."""
    # read many times below, whatever it takes to make them
    path = scratch_path(spark, "fit-rows")
    train.select(*dict.fromkeys([*numeric, *([categorical] if categorical else []), label])).write.parquet(path)
    train = spark.read.parquet(path)
    index = category_index(train, categorical).persist() if categorical else None
    rows = training_rows(train, numeric, categorical, label, index=index)
    if gamma is None:
        kernel, gammas = Linear(len(numeric), index.count() if categorical else 0), (1.0,)
    else:
        kernel, gammas = Fourier(len(numeric), n_features, seed), (gamma,)
    fit = fit_many(rows, len(numeric), k, [c], kernel, gammas, None, gap, max_steps)
    if not fit.sets:
        raise ValueError("no complete row to fit")
    return SvmModel(fit, 0, 0, numeric, categorical, index)


def width_name(gamma: float) -> str:
    return f"{gamma}" if gamma > 0 else "scale"


GRID = ("rank bigint, grid_index bigint, c double, gamma string, mean_score double, std_score double, "
        "n_folds bigint, duality_gap double")


def grid_search(spark: SparkSession, train: DataFrame, numeric: Sequence[str], categorical: str | None, label: str,
                k: int, cs: Sequence[float], gammas: Sequence[float], fold: str, folds: int,
                n_features: int = FEATURES, seed: int = 42, gap: float = GAP,
                max_steps: int = MAX_STEPS) -> tuple[DataFrame, Fit]:
    """Cross-validated grid over C and width on the given folds.

    The table ranks the candidates by the mean macro-F1 of their folds; equal
    scores rank by grid order (C outermost). ``duality_gap`` is the largest of a
    candidate's machines. The fit holds every machine of every fold.
    """
    from outcomelab.operators import metrics
    rows = training_rows(train, numeric, categorical, label, fold).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fit = fit_many(rows, len(numeric), k, cs, Fourier(len(numeric), n_features, seed), gammas, folds, gap, max_steps)
        scored = metrics.macro_f1_present(held_out_predictions(rows, fit), "label", "prediction",
                                          [float(i) for i in range(k)], by=["set", "c"]).collect()
    finally:
        rows.unpersist()
    # sets run fold by fold, the widths inside
    by_cell: dict[tuple[int, int], list[float]] = {}
    for r in scored:
        by_cell.setdefault((r["c"], r["set"] % len(gammas)), []).append(float(r["macro_f1"] or 0.0))
    table = []
    for i, (c, g) in enumerate((c, g) for c in range(len(cs)) for g in range(len(gammas))):
        x = np.array(by_cell.get((c, g), [0.0]))
        worst = max((float(fit.gaps[s][c * k:(c + 1) * k].max()) for s in range(g, len(fit.sets), len(gammas))),
                    default=0.0)
        table.append((i, float(cs[c]), width_name(gammas[g]), float(x.mean()), float(x.std()), len(x), worst))
    table.sort(key=lambda r: (-r[3], r[0]))
    return spark.createDataFrame([(n + 1, *r) for n, r in enumerate(table)], GRID), fit


def group_scores(spark: SparkSession, df: DataFrame, group: str, groups: Sequence[str], numeric: Sequence[str],
                 categorical: str | None, label: str, k: int, c: float, gamma: float, fold: str, folds: int,
                 min_rows: int, n_features: int = FEATURES, seed: int = 42, gap: float = GAP,
                 max_steps: int = MAX_STEPS) -> DataFrame:
    """Cross-validation inside each listed group with fixed parameters: one row
    a group, in the given order. A group with fewer than ``min_rows`` rows is
    not fitted and reports mean NULL, std 0. All machines of all groups and
    folds are fitted together."""
    from outcomelab.operators import metrics
    mine = df.where(F.col(group).isin(*groups))
    sizes = {r[0]: r[1] for r in mine.groupBy(F.col(group).cast("string")).agg(F.count(F.lit(1))).collect()}
    large = [g for g in groups if sizes.get(str(g), 0) >= min_rows]
    scores: dict[str, list[float]] = {}
    if large:
        rows = training_rows(mine.where(F.col(group).isin(*large)), numeric, categorical, label, fold, group) \
            .persist(StorageLevel.MEMORY_AND_DISK)
        try:
            fit = fit_many(rows, len(numeric), k, [c], Fourier(len(numeric), n_features, seed), (gamma,), folds,
                           gap, max_steps)
            for r in metrics.macro_f1_present(held_out_predictions(rows, fit), "label", "prediction",
                                              [float(i) for i in range(k)], by=["grp", "set"]).collect():
                scores.setdefault(r["grp"], []).append(float(r["macro_f1"] or 0.0))
        finally:
            rows.unpersist()
    out = []
    for i, g in enumerate(groups):
        x = np.array(scores.get(str(g), []))
        out.append((str(g), i, int(sizes.get(str(g), 0)), float(x.mean()) if len(x) else None,
                    float(x.std()) if len(x) else 0.0))
    return spark.createDataFrame(
        out, f"{group} string, group_order bigint, n_rows bigint, mean_score double, std_score double")
