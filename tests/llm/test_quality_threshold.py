"""The threshold comes from trusted and rejected labels."""

import random

import pytest

from outcomelab.llm import quality

from test_llm_operators import vocabulary


def rows(n, v, rng, start):
    return [(start + k, " ".join(rng.choice(v) for _ in range(rng.randint(60, 120)))) for k in range(n)]


def kept(spark, docs, labels):
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return {r.doc_id: r.kept for r in quality.score_documents(docs, quality.fit(spark, docs, labels)).collect()}


def test_clean_documents_stay(spark):
    rng, v = random.Random(6), vocabulary()
    clean = rows(200, v[:200], rng, 0)
    got = kept(spark, clean, [(i, 1, 0) for i, _ in clean])
    assert len(got) == 200 and all(got.values())


def test_no_loss_where_labels_do_not_overlap(spark):
    rng, v = random.Random(6), vocabulary()
    clean, poor, toxic = rows(200, v[:200], rng, 0), rows(60, v[200:250], rng, 1000), rows(60, v[250:], rng, 2000)
    got = kept(spark, clean + poor + toxic, [(i, 1, 0) for i, _ in clean] + [(i, 0, 0) for i, _ in poor] + [(i, 1, 1) for i, _ in toxic])
    assert all(got[i] for i, _ in clean) and not any(got[i] for i, _ in poor + toxic)


def test_least_error():
    inf = float("inf")
    assert quality.least_error([], [], []) == -inf
    assert quality.least_error([1, 2], [3, 4], [0, 0]) == -inf
    assert quality.least_error([0, 10], [0, 5], [5, 0]) == 5.5 * quality.BIN
    assert quality.least_error([0, 1, 2], [1, 1, 9], [9, 3, 1]) == 2 * quality.BIN


@pytest.mark.parametrize("most", [2_000_000, 1])
def test_all_labels_are_used(spark, monkeypatch, most):
    monkeypatch.setattr(quality, "BROADCAST_IDS", most)
    docs = spark.range(0, 420_000, 1, 4).selectExpr("id as doc_id", "'a b' as text")
    labels = spark.range(0, 420_000, 1, 4).selectExpr("id as doc_id", "cast(id % 2 as int) as quality", "0 as toxic")
    rows = quality.marked(docs, quality.flags(spark, labels.union(labels.limit(10))))
    assert rows.where("trusted").count() == rows.where("rejected").count() == 210_000
    # an id that has both labels is both, one without any is neither, a NULL id has none
    few = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "doc_id long, text string")
    marks = spark.createDataFrame([(1, 1, 0), (1, None, 1), (None, 1, 0), (2, 1, None)], "doc_id long, quality int, toxic int")
    assert sorted(tuple(r) for r in quality.marked(few, quality.flags(spark, marks)).collect()) == [
        ("a", True, True), ("b", True, True), ("c", False, False), ("d", False, False)]
