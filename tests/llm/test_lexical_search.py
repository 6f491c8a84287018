"""Lexical search against scores of every item and document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest_llm import documents
from pyspark.sql import functions as F

from marginlab.llm import lexical_search as module
from marginlab.llm.lexical_search import norms, search, terms

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def brute_force(docs, items, k):
    held = [(i, split(t)) for i, t in docs]
    n_docs, total = sum(bool(t) for _, t in held), sum(len(t) for _, t in held)
    df = Counter(x for _, t in held for x in set(t))
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(split(t))
    out = []
    for item, words in wanted.items():
        scored = []
        for doc, t in held:
            tf = Counter(t)
            m = 10 + 90 * len(t) * n_docs // total if total else 10
            w = {x: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) for x in words if tf[x]}
            scored.append((sum(w[x] * (10**9 * tf[x] // (1000 * tf[x] + 8 * m)) for x in w), doc))
        scored = sorted((x for x in scored if x[0] > 0), key=lambda x: (-x[0], x[1] is not None, x[1] or 0))
        out += [(item, r, doc, s) for r, (s, doc) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def words(seed, n, most=12):
    rnd = random.Random(seed)
    vocabulary = ["a", "A", "b2", "c", "d", "é", "É", "x\x85y", "f", "g", "h", "7"]
    ends = [" ", "-", "\n", "_", "@", "\x7f", "["]
    return [
        rnd.choice([None, "", "".join(rnd.choice(vocabulary) + rnd.choice(ends) for _ in range(rnd.randint(1, most)))] + ["a b2 c"] * (rnd.random() < 0.3))
        for _ in range(n)
    ]


def tables(spark, docs, items):
    return documents(spark, docs).repartition(4), spark.createDataFrame(items, "item_id long, text string")


def result(df):
    return sorted([tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()], key=str)


@pytest.mark.parametrize("seed,k", [(1, 10), (2, 3), (3, 1000)])
def test_equals_brute_force_with_many_ties(spark, seed, k):
    docs, items = list(enumerate(words(seed, 150))), list(enumerate(words(seed + 50, 20)))
    assert result(search(*tables(spark, docs, items), k=k)) == brute_force(docs, items, k)


def test_small_tiles_and_blocks_change_no_result(spark, monkeypatch):
    docs, items = list(enumerate(words(7, 100))), list(enumerate(words(8, 12)))
    for name, value in {"TILE_DOCS": 3, "PRODUCT_TERMS": 2, "BLOCK_ITEMS": 4, "BLOCK_PAIRS": 5, "CUT_BYTES": 4}.items():
        monkeypatch.setattr(module, name, value)
    assert result(search(*tables(spark, docs, items), k=4)) == brute_force(docs, items, 4)


def test_keys_that_are_null_or_repeated(spark):
    docs = [(None, "a b2"), (None, "a b2"), (3, "a b2"), (3, "a b2"), (1, "a c"), (4, None)]
    items = [(None, "a"), (None, "b2"), (5, "c"), (5, "c a"), (6, None), (7, "zz")]
    assert result(search(*tables(spark, docs, items), k=3)) == brute_force(docs, items, 3)


def test_odd_tables(spark):
    some, none = [(1, "a")], []
    for docs, items in ((none, some), (some, none), (none, none), ([(1, None)], some)):
        assert search(*tables(spark, docs, items)).count() == 0
    docs, items = tables(spark, [(1, "a b"), (2, "c")], [(9, "b")])
    for name in ("key", "item", "term", "score", "rank", "place", "some"):
        docs, items = docs.withColumn(name, F.lit("x")), items.withColumn(name, F.lit("x"))
    assert [r[:3] for r in result(search(docs, items))] == [(9, 1, 1)]


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = " ".join(words(11, 1, 400)[0] or "a-b c" for _ in range(9)).encode()
    whole = list(terms(text))[0]
    for size in (1, 7, 64):
        monkeypatch.setattr(module, "CUT_BYTES", size)
        assert [x for some in terms(text) for x in some] == whole


def test_norms_of_very_many_documents_stay_exact():
    lengths = np.array([10**7, 1])
    assert list(norms(lengths, 10**12, 10**15)) == [10 + 90 * 10**7 * 10**12 // 10**15, 10]
