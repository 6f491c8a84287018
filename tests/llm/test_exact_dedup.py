"""Exact dedup: groups, collisions, the directory, hot groups, odd tables."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from conftest_llm import documents
from pyspark.sql import functions as F

from marginlab.llm.exact_dedup import build_index, directory, distinct_texts, exact_groups, index_groups


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_force(rows):
    """(doc_id, keep_id, group_size, text_sha256), sorted, and the number of groups."""
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    top = {t: max(ids, key=lambda i: (i is not None, i or 0)) for t, ids in groups.items()}
    out = [(i, top[lower(t)], len(groups[lower(t)]), hashlib.sha256(lower(t).encode()).hexdigest()) for i, t in rows]
    return sorted(out, key=str), len(groups)


def check(found, rows):
    found = found.collect()
    expected, n_groups = brute_force(rows)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found], key=str) == expected
    kept = [r for r in found if r.kept]
    assert len(kept) == n_groups and all(r.doc_id == r.keep_id for r in kept)


def texts(n=400, seed=3):
    rnd = random.Random(seed)
    words = ["Ä", "ä", "a", "A", "é", "É", "İ", "", " ", "\n", "straße", "STRASSE"]
    return [(i, rnd.choice([None, "".join(rnd.choices(words, k=rnd.randint(0, 4)))])) for i in range(n)]


def test_groups_equal_brute_force(spark):
    rows = texts()
    check(exact_groups(documents(spark, rows).repartition(7)), rows)


@pytest.mark.parametrize("hash_of", [lambda t: 0, lambda t: (len(t) % 3) << 62, lambda t: 2**64 - 1 - t.count(b"a")])
def test_texts_of_one_hash_are_told_apart_by_their_bytes(spark, hash_of):
    rows = texts(200)
    check(exact_groups(documents(spark, rows).repartition(5), hash_of=hash_of, full=64), rows)


def test_keys_that_are_null_or_repeated(spark):
    rows = [(None, "x"), (None, "X"), (1, "x"), (1, "X"), (1, "x"), (None, "y"), (None, "y"), (2, None), (None, "")]
    check(exact_groups(documents(spark, rows).repartition(4)), rows)


def test_empty_table_and_clashing_names(spark):
    assert exact_groups(documents(spark, [])).count() == 0
    rows = [(1, "a"), (2, "A")]
    clash = documents(spark, rows)
    for name in ("page", "h", "key", "keys", "bucket", "chain", "kept", "slot", "n"):
        clash = clash.withColumn(name, F.lit("x"))
    check(exact_groups(clash), rows)
    named = documents(spark, rows).withColumnsRenamed({"doc_id": "h", "text": "page"})
    assert {r["h"]: r.keep_id for r in exact_groups(named, "h", "page").collect()} == {1: 2, 2: 2}


def test_a_hot_text_is_one_page_for_each_task(spark, tmp_path):
    hot = spark.range(30_000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'Same Text', cast(id AS string)) AS text").repartition(6)
    build_index(hot, f"{tmp_path}/index", full=10_000)
    buckets = spark.read.parquet(f"{tmp_path}/index/buckets")
    assert buckets.groupBy("h", "chain").count().agg(F.max("count")).first()[0] <= 6
    got = index_groups(spark, f"{tmp_path}/index").where("group_size > 1")
    assert got.count() == 10_000 and got.where("kept").select("doc_id").first()[0] == 29_997
    one = distinct_texts(spark, f"{tmp_path}/index").where("group_size > 1").collect()
    assert [tuple(r) for r in one] == [(29_997, 10_000, "same text")]


def test_a_bucket_is_a_file_of_its_owner(spark, tmp_path):
    build_index(documents(spark, [(i, f"text {i}" * 20) for i in range(500)]), f"{tmp_path}/index", full=5_000)
    slots = spark.read.parquet(f"{tmp_path}/index/directory")
    assert slots.count() >= 8 and slots.count() & (slots.count() - 1) == 0
    buckets = spark.read.parquet(f"{tmp_path}/index/buckets").withColumn("file", F.input_file_name())
    assert buckets.groupBy("bucket").agg(F.countDistinct("file").alias("n")).where("n > 1").count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_directory_doubles_until_no_bucket_is_overfull(seed):
    rnd = np.random.default_rng(seed)
    loads = rnd.integers(0, 20, 256)
    loads[rnd.integers(256)] = 5_000
    slots, depths = directory(loads, 100)
    depth = len(slots).bit_length() - 1
    assert len(slots) == 1 << depth and sorted(set(slots)) == list(range(len(depths)))
    assert (np.diff(slots) >= 0).all()
    held = loads.reshape(len(slots), -1).sum(axis=1)
    for b, d in enumerate(depths):
        assert (slots == b).sum() == 1 << (depth - d)
        assert held[slots == b].sum() <= 100 or d == 8


def test_directory_of_little_is_one_slot():
    slots, depths = directory(np.zeros(32, np.int64), 10)
    assert list(slots) == [0] and list(depths) == [0]
