"""Source divergence, filter interaction and sharding against brute force."""

import collections
import itertools
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from outcomelab.llm import divergence, interaction, sharding

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n", T.LongType()), T.StructField("part", T.StringType()),
                    T.StructField("shard", T.LongType()), T.StructField("size", T.StringType()),
                    T.StructField("digest", T.StringType())])
LABEL = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()),
                      T.StructField("toxic", T.IntegerType()), T.StructField("n", T.LongType()),
                      T.StructField("mask", T.LongType())])
EXTRA = (7, "x", 5, "y", "z")


def make(seed=3):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeé字") for _ in range(rng.randint(1, 3))) for _ in range(60)]
    rows = []
    for i in range(260):
        ws = [rng.choice(vocab) for _ in range(rng.choice([0, 3, 40, 60, 120]))]
        if rng.random() < 0.3:
            ws = [w.upper() for w in ws]
        if rng.random() < 0.2:
            ws.append("#tag|")
        text = rng.choice([" ", "\n", "\x0b ", ", "]).join(ws)
        rows.append((i, text, rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", "s3", None])) + EXTRA)
    copy = rows[5][1]
    rows += [(1000 + i, copy, "en", "s1") + EXTRA for i in range(90)]
    rows += [rows[7], rows[7], (None, copy, "en", "s2") + EXTRA, (None, None, None, None) + EXTRA,
             (400, None, "en", "s1") + EXTRA, (401, "", "en", "s2") + EXTRA, (402, " \n ", "zz", "lonely") + EXTRA,
             (403, "word " * 40_000, "en", "s3") + EXTRA, (404, "x" * 200_000, "de", "s9") + EXTRA,
             (405, "A" * 50 + " b", "de", "s8") + EXTRA, (7, "another text under an id seen before", "fr", "s1") + EXTRA]
    return rows


@pytest.fixture(scope="module")
def rows():
    return make()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOC).repartition(6)


# --- source divergence -------------------------------------------------------------

def brute_divergence(rows, least):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n, df, groups = collections.Counter(), collections.Counter(), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        ts = term.findall((text or "").translate(low))
        n.update((lang, source, t) for t in ts)
        df.update((lang, t) for t in set(ts))
    out = []
    for lang, source in groups:
        kept = [t for (g, t), k in df.items() if g == lang and k >= least]
        peers = [s for g, s in groups if g == lang]

        def p(count, total):
            return 1 + 1_000_000_000 * (count + 2) // (total + 2 * len(kept))

        def shares(ss):
            total = sum(n[lang, s, t] for s in ss for t in kept)
            return {t: p(sum(n[lang, s, t] for s in ss), total) for t in kept}

        def f(a, b):
            return (a - b) ** 2 // (a + b)
        mine, whole = shares([source]), shares(peers)
        pair = [(s, sum(f(mine[t], q) for t, q in shares([s]).items())) for s in peers if s != source]
        top = [(t, f(mine[t], whole[t])) for t in kept if n[lang, source, t] and mine[t] > whole[t]]
        for part, items in (("pair", pair), ("term", top)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, v, k + 1) for k, (item, v) in enumerate(items)
                    if part == "pair" or k < 10]
    return sorted(out)


@pytest.mark.parametrize("block,sources", [(8192, 64), (16, 64), (8, 2), (64, 1)])
def test_divergence_equals_brute_force(spark, docs, rows, block, sources):
    got = divergence.audit(spark, docs, block=block, sources=sources)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute_divergence(rows, 10)


def test_divergence_without_kept_terms_and_empty(spark, docs, rows):
    got = divergence.audit(spark, docs, min_docs=10_000).collect()
    assert sorted(map(tuple, got)) == brute_divergence(rows, 10_000)
    assert got and all(r.value == 0 and r.part == "pair" for r in got)
    assert divergence.audit(spark, spark.createDataFrame([], DOC)).collect() == []


def test_divergence_counts_flushed_midway(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(divergence, "OPEN_TERMS", 50)
    counts = collections.Counter()
    for b in divergence._counted(docs).collect():
        counts[b.lang, b.source, b.term] += b.n
    want = collections.Counter()
    for _, text, lang, source, *_ in rows:
        want.update((lang or "", source or "", t.decode()) for t in divergence.terms(text))
    assert counts == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), min_size=13, max_size=13), min_size=2, max_size=5))
def test_forest_meets_every_pair_of_counts(grid):
    forest = divergence.Forest(np.array(grid, np.int64))
    for a, b in itertools.combinations(range(len(grid)), 2):
        ca, cb, times = forest.meet(a, b)
        got = {(int(x), int(y)): int(t) for x, y, t in zip(ca, cb, times)}
        assert got == collections.Counter(zip(grid[a], grid[b]))


def test_forest_shares_equal_subtrees():
    row = np.random.default_rng(0).integers(0, 50, 1024)
    one, many = divergence.Forest(row[None]), divergence.Forest(np.stack([row] * 40))
    assert many.nodes() == one.nodes()
    other = row.copy()
    other[3] += 1
    # a changed leaf costs one path to the root
    assert divergence.Forest(np.stack([row, other])).nodes() <= one.nodes() + 12


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10 ** 13), st.integers(0, 10 ** 15))
def test_share_is_exact(count, more):
    whole = count + 2 + more
    assert int(divergence.share(np.array([count]), whole)[0]) == 1 + 10 ** 9 * (count + 2) // whole


# --- filter interaction --------------------------------------------------------------

def brute_interaction(rows, labels):
    words = re.compile(r"[^\x20\x09-\x0D]+")
    good = {d for d, q, *_ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x, *_ in labels if x == 1 and d is not None}
    docs = []
    for i, text, _, source, *_ in rows:
        t = text or ""
        ws = words.findall(t)
        fails = {k for k, bad in (
            ("A", len(ws) < 50), ("B", 100 * len(set(ws)) < 65 * len(ws)),
            ("C", 100 * len(re.findall("[A-Z]", t)) > 5 * len(t)), ("D", bool(re.search("[#$%&*|]", t))),
            ("E", i is not None and any(o[0] is not None and o[0] < i and (o[1] or "") == t for o in rows))) if bad}
        docs.append((source or "", fails, i in good, i in toxic))
    out = []
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = list(mine)
            for step, k in enumerate(order, 1):
                hit = [d for d in left if k in d[1]]
                left = [d for d in left if k not in d[1]]
                fails = sum(k in d[1] for d in mine)
                out.append([part, "".join(order), step, len(left), len(hit), fails - len(hit),
                            sum(d[1] == {k} for d in mine), sum(d[2] for d in hit), sum(d[3] for d in hit), k])
    total = collections.Counter()
    for r in out:
        total[r[0], r[-1]] += r[4]
    return sorted(tuple(r[:-1]) + (total[r[0], r[-1]],) for r in out)


def test_interaction_equals_brute_force(spark, docs, rows):
    rng = random.Random(4)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None]), 1, 1) for i in range(0, 200, 2)]
    labels += [(4, 1, 0, 1, 1), (4, 0, 1, 1, 1), (None, 1, 1, 1, 1), (99_999, 1, 1, 1, 1), (1001, 1, 1, 2, 2)]
    got = interaction.audit(spark, docs, spark.createDataFrame(labels, LABEL))
    assert sorted(map(tuple, got.collect())) == brute_interaction(rows, labels)


def test_interaction_empty(spark, docs):
    no_docs, no_labels = spark.createDataFrame([], DOC), spark.createDataFrame([], LABEL)
    assert interaction.audit(spark, no_docs, no_labels).collect() == []
    got = interaction.audit(spark, docs, no_labels).collect()
    assert got and not any(r.good_lost or r.toxic_lost for r in got)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-1000, 1000), min_size=31, max_size=31))
def test_least_squares_gives_shapley_of_any_game(values):
    value = [0, *values]
    got = interaction.shapley(value)
    for i in range(5):
        want = sum(Fraction(value[s] - value[s & ~(1 << i)], 1) for o in itertools.permutations(range(5))
                   for s in [sum(1 << j for j in o[:o.index(i) + 1])]) / 120
        assert got[i] == want


# --- sharding --------------------------------------------------------------------------

def slow_differencing(sizes, k):
    """Karmarkar-Karp on explicit sets; returns the final sizes, falling."""
    parts = [([s] + [0] * (k - 1), n) for n, s in enumerate(sizes)]
    age = len(parts)
    while len(parts) > 1:
        parts.sort(key=lambda p: (-(p[0][0] - p[0][-1]), p[1]))
        (a, _), (b, _) = parts[:2]
        parts = parts[2:] + [(sorted((x + y for x, y in zip(a, reversed(b))), reverse=True), age)]
        age += 1
    return parts[0][0]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=40), st.integers(2, 6))
def test_differencing_gives_the_sizes_of_the_plain_method(sizes, k):
    subset = sharding.difference(sizes, k)
    total = [0] * k
    for s, j in zip(sizes, subset):
        total[j] += s
    want = slow_differencing(sizes, k)
    assert sum(total) == sum(want)
    # ties of spread may be met in another order
    assert max(total) - min(total) <= max(want[0] - want[-1], max(sizes))
    if len(set(sizes)) == len(sizes):
        assert max(total) - min(total) <= 2 * (want[0] - want[-1]) + max(sizes) // 2


def test_differencing_beats_greedy():
    rng = random.Random(1)
    wins = 0
    for _ in range(20):
        sizes = [rng.randrange(1_000, 100_000) for _ in range(600)]
        greedy = [0] * 8
        for s in sorted(sizes, reverse=True):
            greedy[greedy.index(min(greedy))] += s
        wins += sharding.spread(sizes, sharding.difference(sizes, 8), 8) <= max(greedy) - min(greedy)
    assert wins >= 18


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=0, max_size=200), st.lists(st.integers(0, 2000), min_size=4, max_size=4))
def test_differencing_fills_a_start(sizes, start):
    total = list(start)
    for s, j in zip(sizes, sharding.difference(sizes, 4, start)):
        total[j] += s
    # no subset that got something lies above the rest by more than a group
    assert max(total) <= max(max(start), min(total) + 50)


def placed_right(rows, got, k):
    want = collections.Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert collections.Counter((g.doc_id, g.size, g.text_crc32) for g in got) == want
    assert all(g.law == "bytes" and g.grown_shard is None and 0 <= g.shard < k for g in got)
    home = collections.defaultdict(set)
    slots = collections.defaultdict(list)
    for g in got:
        home[g.size, g.text_crc32].add(g.shard)
        slots[g.shard].append(g.slot)
    assert all(len(s) == 1 for s in home.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    load = [0] * k
    for g in got:
        load[g.shard] += g.size
    return load


def test_sharding_places_every_row(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(sharding, "HOT", 10)
    monkeypatch.setattr(sharding, "BLOCK_ROWS", 7)
    load = placed_right(rows, sharding.shard_documents(spark, docs).collect(), 24)
    big = collections.Counter()
    for r in rows:
        big[r[1] or ""] += len((r[1] or "").encode()) + 8
    sizes = sorted(big.values(), reverse=True)
    # the two giants have a shard each, the others share what is left evenly
    assert sorted(load, reverse=True)[:2] == sizes[:2]
    others = sorted(load, reverse=True)[2:]
    assert others[0] <= max(sizes[2], sum(sizes[2:]) / 22 * 1.05)


@pytest.mark.parametrize("lot", [150, 300, 10_000])
def test_lots_even_out(spark, lot, monkeypatch):
    monkeypatch.setattr(sharding, "HEAVY", 4)
    rng = random.Random(lot)
    sizes = [rng.randrange(8, 4000) for _ in range(900)] + [90_000, 70_000, 400_000]
    groups = spark.createDataFrame([(bytes([i % 256, i // 256]), s) for i, s in enumerate(sizes)],
                                   "digest binary, size long")
    got = {bytes(r.digest): r.shard for r in sharding.assign_groups(spark, groups, 6, lot).collect()}
    load = [0] * 6
    for i, s in enumerate(sizes):
        load[got[bytes([i % 256, i // 256])]] += s
    assert len(got) == len(sizes)
    best = (sum(sizes) - max(sizes)) / 5 if max(sizes) > sum(sizes) / 6 else sum(sizes) / 6
    rest = sorted(load)[:5] if max(sizes) > sum(sizes) / 6 else load
    assert max(rest) - min(rest) <= 0.002 * best


def test_sharding_empty_and_single(spark):
    assert sharding.shard_documents(spark, spark.createDataFrame([], DOC)).collect() == []
    one = [(1, None, None, None) + EXTRA]
    got = sharding.shard_documents(spark, spark.createDataFrame(one, DOC)).collect()
    assert [(g.doc_id, g.size, g.text_crc32, g.slot) for g in got] == [(1, 8, 0, 0)]
