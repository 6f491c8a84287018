"""Classifiers: accuracy on the fold that is not learnt from, and edge rows."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
from conftest_llm import by_id, documents
from marginlab.llm import queries
from marginlab.llm.labelled import once, training_sample
from marginlab.llm.quality_classifier import BoostParameters, boost, fit_quality, quality_scores
from marginlab.llm.toxicity import FtrlParameters, coordinates, fit_toxicity, ftrl, toxicity_scores
from pyspark.sql import functions as F

LARGER = "/root/testdata/sf0.1"


def folds(spark, name, label):
    """(scores, predictions, labels) of the held-out rows."""
    df = queries.QUERIES[name](spark, LARGER)
    assert df.columns == ["doc_id", "held_out", "score", "predicted"]
    found = by_id(df, "held_out", "score", "predicted")
    assert len(found) == 10_000
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= s <= 1 for i, (h, s, _) in found.items())
    labels = queries.table(spark, LARGER, "labels").select("doc_id", label).collect()
    return np.array([(found[i][1], found[i][2], y) for i, y in labels if found[i][0]])


def test_quality_on_held_out_rows(spark):
    got = folds(spark, "op7_quality_classifier", "quality")
    assert (got[:, 1] == got[:, 2]).mean() > 0.97
    assert (got[got[:, 2] == 1, 1] == 1).mean() > 0.97


def test_toxicity_on_held_out_rows(spark):
    got = folds(spark, "op4_toxicity", "toxic")
    assert (got[got[:, 2] == 0, 1] == 0).mean() > 0.99
    assert (got[got[:, 2] == 1, 1] == 1).mean() > 0.6
    order = got[got[:, 0].argsort()][:, 2]
    ranks = np.flatnonzero(order) + 1
    pos, neg = order.sum(), (1 - order).sum()
    assert (ranks.sum() - pos * (pos + 1) / 2) / (pos * neg) > 0.97


def test_flattened_trees_walk_like_plain_ones():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = boost(x, y, BoostParameters(trees=30, depth=3))

    def walk(row):
        total = trees.base
        for t in range(len(trees.feature)):
            k = 0
            for _ in range(3):
                k = 2 * k + 1 + int(row[trees.feature[t, k]] > trees.limit[t, k])
            total += trees.value[t, k - 7]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(trees.score(x), [walk(r) for r in x])
    assert ((trees.score(x) > 0.5) == y).mean() > 0.95
    assert np.allclose(boost(x, np.ones(600), BoostParameters()).score(x), 601 / 602)


def test_ftrl_drops_coordinates_that_tell_nothing():
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(800):
        y = int(rng.random() < 0.3)
        at = set(rng.integers(10, 500, 20).tolist()) | ({1} if y else set())
        rows.append((np.array(sorted(at), np.uint32), y))
    w = ftrl(rows, FtrlParameters(bits=10))
    assert w.at[w.weight.argmax()] == 1 and len(w.at) < 100


def test_coordinates_cover_words_pairs_and_skips():
    assert len(coordinates("one two three four", 20)) == 4 + 3 + 2
    assert len(coordinates(None, 20)) == len(coordinates(" ! ", 20)) == 0
    assert coordinates("Ähre x", 20).tolist() == coordinates("ähre X", 20).tolist()


def test_sample_is_bounded_and_leaves_the_fold_out(spark):
    docs = documents(spark, ["x"] * 3000)
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    found = training_sample(docs, labels, "quality", 900).collect()
    assert 600 < len(found) <= 900
    assert all(zlib.crc32(str(r.key).encode()) % 3 != 1 for r in found)
    assert len(training_sample(docs, labels, "quality", 10_000).collect()) == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(3000))


def test_edge_rows(spark):
    docs = documents(spark, [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c"), (4, "long words " * 50_000)])
    docs = docs.withColumn("score", F.lit("x")).withColumn("label", F.lit("y"))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(3, 1, 0), (3, 1, 1), (9, 0, 0), (None, 1, 1), (2, None, None)], none.schema)
    for labels in (none, some):
        for df in (quality_scores(docs, fit_quality(docs, labels)), toxicity_scores(docs, fit_toxicity(docs, labels))):
            rows = df.collect()
            assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
            assert [r.held_out for r in rows if r.doc_id is None] == [False]
    assert quality_scores(docs.limit(0), fit_quality(docs, none)).collect() == []
    assert toxicity_scores(docs.limit(0), fit_toxicity(docs, none)).collect() == []


def test_sample_is_bounded_however_often_a_key_is_repeated(spark):
    """Key 1 has a third of all rows and labels, in equal and in different texts."""
    labels = spark.createDataFrame([(i, i % 2) for i in range(2, 1500)] + [(1, 1)] * 700, "doc_id long, quality int")
    for own in (["same"] * 3000, [f"t{i}" for i in range(3000)]):
        docs = documents(spark, [(i, f"x{i}") for i in range(2, 1500)] + [(1, t) for t in own])
        for most in (400, 100_000):
            found = once(training_sample(docs, labels, "quality", most), "text").collect()
            assert 0 < len(found) <= most
            assert len({(r.key, r.label, r.text) for r in found}) == len(found)
        assert sum(r.key == 1 for r in found) == (zlib.crc32(b"1") % 3 != 1) * len(set(own))


def plain_ftrl(examples, p):
    """The published update, one coordinate at a time, in dictionaries."""
    z, n, bias = {}, {}, "bias"

    def weight(i):
        if abs(z.get(i, 0.0)) <= p.l1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * p.l1) / ((p.beta + n[i] ** 0.5) / p.alpha + p.l2)

    for _ in range(p.epochs):
        for found, label in examples:
            at = [*found.tolist(), bias]
            w = {i: weight(i) for i in at}
            g = (1 / (1 + math.exp(-sum(w.values()))) - label) * (p.positive if label else 1)
            for i in at:
                rate = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / p.alpha
                z[i] = z.get(i, 0.0) + g - rate * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z if i != bias and weight(i)}, weight(bias)


def test_ftrl_equals_the_plain_update():
    rnd = random.Random(1)
    p = FtrlParameters(bits=6, l1=0.5, epochs=3, positive=2.0)
    examples = []
    for _ in range(200):
        label = int(rnd.random() < 0.3)
        found = {rnd.randrange(64) for _ in range(6)} | ({3, 9} if label else {5})
        examples.append((np.array(sorted(found), np.uint32), label))
    got, (want, bias) = ftrl(examples, p), plain_ftrl(examples, p)
    assert set(got.at.tolist()) == set(want) and 3 in want
    assert np.allclose(got.weight, [want[i] for i in got.at.tolist()], atol=1e-5) and abs(got.bias - bias) < 1e-9


def test_the_sample_is_bounded_by_its_coordinates(spark):
    docs = documents(spark, [(i, " ".join(f"w{i}x{k}" for k in range(100))) for i in range(400)])
    labels = spark.range(400).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    few = fit_toxicity(docs, labels, FtrlParameters(l1=0.01, epochs=1, most_coordinates=9_000))
    every = fit_toxicity(docs, labels, FtrlParameters(l1=0.01, epochs=1))
    assert 0 < len(few.at) < 15_000 < len(every.at)


@pytest.mark.parametrize("seed", range(3))
def test_the_first_split_is_the_best_of_all(seed):
    """Every limit of every feature is tried; the gain is that of the second-order expansion of the loss."""
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, size=(300, 3)).astype(float)
    y = ((x[:, seed] > 5) ^ (rng.random(300) < 0.2)).astype(float)
    p = BoostParameters(trees=1, depth=1, bins=64, leaf=1.0)
    trees = boost(x, y, p)
    prob = 1 / (1 + math.exp(-trees.base))
    g, h = prob - y, np.full(300, prob * (1 - prob))
    score = lambda rows: g[rows].sum() ** 2 / (h[rows].sum() + p.ridge)
    gains = {
        (f, c): score(x[:, f] <= c) + score(x[:, f] > c) - score(np.ones(300, bool))
        for f in range(3) for c in range(11) if min(h[x[:, f] <= c].sum(), h[x[:, f] > c].sum()) >= p.leaf
    }
    f, c = trees.feature[0, 0], trees.limit[0, 0]
    assert (f, np.floor(c)) == max(gains, key=gains.get) and f == seed
    left = x[:, f] <= c
    want = [-p.rate * g[rows].sum() / (h[rows].sum() + p.ridge) for rows in (left, ~left)]
    assert np.allclose(trees.value[0], want)
