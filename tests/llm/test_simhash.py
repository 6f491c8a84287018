"""SimHash groups against all pairs on small tables."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from conftest_llm import SF_DIR, by_id, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from marginlab.llm import queries
from marginlab.llm.components import components
from marginlab.llm.simhash import drop_near_copies, fingerprint, fingerprint_links, link_groups, masks, simhash_groups
from pyspark.sql import functions as F


def plain_fingerprint(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(pairs, radius):
    """{key: smallest key reachable} by comparing all pairs."""
    label = dict.fromkeys(range(len(pairs)))
    for i in label:
        label[i] = i

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(pairs)):
        for j in range(i):
            if (pairs[i][1] ^ pairs[j][1]).bit_count() <= radius:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    least = {}
    for i, (k, _) in enumerate(pairs):
        least[root(i)] = min(least.get(root(i), k), k)
    return {k: least[root(i)] for i, (k, _) in enumerate(pairs)}


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aBÉ \t\n c", max_size=80), st.integers(1, 5))
def test_fingerprint(text, width):
    assert fingerprint(text.encode(), width) % 2**64 == plain_fingerprint(text, width)


def test_every_close_pair_shares_a_mask():
    rng = np.random.default_rng(1)
    for radius, blocks in ((4, 5), (4, 6), (4, 7), (7, 9)):
        keys = masks(radius, blocks)
        for _ in range(200):
            flips = rng.choice(64, radius, replace=False)
            differ = sum(1 << int(f) for f in flips)
            assert any(m % 2**64 & differ == 0 for m in keys)


@pytest.mark.parametrize("radius", [0, 3, 4, 9, 20])
def test_links_connect_what_all_pairs_connect(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**64, 40, dtype=np.uint64)
    fps = base[rng.integers(0, 40, 900)]
    for _ in range(radius):
        fps = fps ^ (np.uint64(1) << rng.integers(0, 64, 900).astype(np.uint64))
    group = np.sort(rng.integers(0, 6, 900))
    a, b = link_groups(group, fps, np.zeros(900), np.zeros(900, bool), radius)
    for g in range(6):
        pairs = [(i, int(f)) for i, f in enumerate(fps[group == g])]
        inside = {f for _, f in pairs}
        links = [(int(x), int(y)) for x, y in zip(a, b) if int(x) in inside and int(y) in inside]
        want = plain_groups(pairs, radius)
        seen = {f: f for f in inside}
        for _ in range(len(seen)):
            for x, y in links:
                seen[x] = seen[y] = min(seen[x], seen[y])
        got = {}
        for k, f in pairs:
            got.setdefault(seen[f], []).append(k)
        assert sorted(map(sorted, got.values())) == sorted(
            [k for k in want if want[k] == r] for r in set(want.values())
        )


@pytest.mark.parametrize("cell", [1024, 20])
def test_a_hot_key_is_split_without_losing_links(spark, cell):
    rng = np.random.default_rng(5)
    near = [0] + [int(sum(1 << int(b) for b in rng.choice(12, k, replace=False))) for k in range(1, 9) for _ in range(60)]
    fps = sorted(set(near)) + [int(x) >> 1 for x in rng.integers(0, 2**63, 200)]
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    roots = {r.node: r.root for r in components(fingerprint_links(df, 4, 6, cell)).collect()}
    assert {f: roots.get(f, f) for f in fps} == plain_groups([(f, f) for f in fps], 4)


def test_components_of_paths_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(200, 200), (300, None), (7, 8)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.root for r in components(df).collect()}
    assert found == {**{i: 0 for i in range(1, 51)}, **{i: 100 for i in range(101, 140)}}
    assert components(df.limit(0)).collect() == []


def test_query_equals_all_pairs(spark):
    docs = queries.table(spark, SF_DIR, "documents").select("doc_id", "text").collect()
    pairs = [(r[0], plain_fingerprint(r[1], 4)) for r in docs]
    found = by_id(queries.QUERIES["op3_simhash"](spark, SF_DIR), "fingerprint", "component_id")
    groups = plain_groups(pairs, 4)
    assert found == {k: (f"{f:016x}", groups[k]) for k, f in pairs}
    assert any(k != g for k, g in groups.items())


def test_edge_rows(spark):
    long = " ".join(f"w{i % 977}" for i in range(150_000))
    docs = documents(spark, [(5, None), (3, ""), (4, " \n"), (9, long), (7, long + " x"), (7, long + " x"), (None, long), (None, None)])
    docs = docs.withColumn("fp", F.lit("x")).withColumn("key", F.lit(1)).withColumn("root", F.lit(2))
    rows = [(r.doc_id, r.component_id) for r in simhash_groups(docs).collect()]
    assert sorted(rows, key=str) == sorted([(5, 3), (3, 3), (4, 3), (None, 3), (9, 7), (7, 7), (7, 7), (None, 7)], key=str)
    assert simhash_groups(docs.limit(0)).collect() == []
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted([3, 7, None, None], key=str)


def test_rows_that_share_a_key_are_told_apart(spark):
    one, two, three = (" ".join(f"{w}{i}" for i in range(60)) for w in "abc")
    rows = [(0, one), (1, one), (1, two), (1, two), (2, two), (None, three), (None, three), (None, three), (5, one), (5, three)]
    docs = documents(spark, rows).repartition(3)
    kept = sorted([(r.doc_id, r.text) for r in drop_near_copies(docs).collect()], key=str)
    assert kept == sorted([(0, one), (1, two), (5, three), (None, three)], key=str)


def test_many_rows_of_one_key_keep_their_texts(spark):
    texts = [" ".join(f"w{k}x{i}" for i in range(40)) for k in range(50)]
    docs = documents(spark, [(7, t) for t in texts] * 2 + [(8, t) for t in texts])
    assert sorted((r.doc_id, r.text) for r in drop_near_copies(docs).collect()) == sorted((7, t) for t in texts)
