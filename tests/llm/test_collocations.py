"""Collocations against a count of every phrase."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from conftest_llm import DOC
from pyspark.sql import functions as F

from marginlab.llm import collocations as module
from marginlab.llm.collocations import collocations

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute_force(rows, least, longest, top, scale=2_000_000, subsumed=80):
    found, words = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for size in range(1, longest + 1):
                for i in range(len(w) - size + 1):
                    found[lang, tuple(w[i : i + size])] += 1
    candidates = {k: a for k, a in found.items() if len(k[1]) > 1 and a >= least}
    out = []
    for (lang, p), a in candidates.items():
        inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        if any(g == lang and len(q) > len(p) and 100 * f >= subsumed * a and inside(q) for (g, q), f in candidates.items()):
            continue
        cuts = [(scale * a // (found[lang, p[:k]] + found[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((lang, score, a, " ".join(p), found[lang, p[:k]], found[lang, p[k:]], words[lang]))
    ranked = []
    for g in sorted({x[0] for x in out}):
        mine = sorted((x for x in out if x[0] == g), key=lambda x: (-x[1], -x[2], x[3].encode()))
        ranked += [(g, i, x[3], x[2], x[4], x[5], x[6], x[1]) for i, x in enumerate(mine[:top], 1)]
    return ranked


def texts(seed, n=120):
    rnd = random.Random(seed)
    words = ["a", "B", "b", "c", "dé", "É", "e\x85f", "\x1c", "x"]
    ends = [" ", " ", " ", "\t", "  ", ".", ", ", "\n", "\x0b", "\r"]
    text = lambda: "".join(rnd.choice(words) + rnd.choice(ends) for _ in range(rnd.randint(0, 60)))
    return [(rnd.choice(["en", "en", "de", None, "und", ""]), rnd.choice([text(), text(), None, ""])) for _ in range(n)]


def table(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", 0) for i, (g, t) in enumerate(rows)], DOC)


def result(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.mark.parametrize("seed,least,longest,top", [(1, 3, 4, 1000), (2, 2, 4, 7), (3, 5, 3, 50), (4, 2, 2, 50)])
def test_equals_brute_force(spark, seed, least, longest, top):
    rows = texts(seed)
    found = collocations(table(spark, rows).repartition(5), least=least, longest=longest, top=top)
    assert result(found) == sorted(brute_force(rows, least, longest, top))


@pytest.mark.parametrize("bits", [6, 10])
def test_a_full_map_changes_no_result(spark, bits):
    rows = texts(5)
    assert result(collocations(table(spark, rows), least=2, bits=bits)) == sorted(brute_force(rows, 2, 4, 2000))


def test_small_lots_and_parts_change_no_result(spark, monkeypatch):
    rows = texts(6)
    monkeypatch.setattr(module, "COUNTED_WORDS", 50)
    monkeypatch.setattr(module, "CUT_BYTES", 40)
    counted = collocations(table(spark, rows), least=2)
    assert result(counted) == sorted(brute_force(rows, 2, 4, 2000))


def test_a_longer_phrase_subsumes_its_parts(spark):
    rows = [("en", "new york city. " * 8 + "new york. " * 2 + "york city hall")]
    found = {r.phrase for r in collocations(table(spark, rows), least=2).collect()}
    assert found == {"new york city"}
    found = {r.phrase for r in collocations(table(spark, rows), least=2, subsumed=90).collect()}
    assert found == {"new york city", "new york", "york city"}


def test_odd_tables(spark):
    assert collocations(table(spark, [])).count() == 0
    assert collocations(table(spark, [(None, None), ("en", ""), ("en", " .. ")]), least=1).count() == 0
    rows = [("en", "a b " * 5)] * 3
    clash = table(spark, rows)
    for name in ("prefix", "next", "part", "phrase", "f", "a", "l", "r", "n", "rank", "score", "slot", "suffix"):
        clash = clash.withColumn(name, F.lit("x"))
    assert result(collocations(clash, least=2)) == sorted(brute_force(rows, 2, 4, 2000))


def test_counts_beyond_32_bits_stay_exact(spark):
    known = spark.createDataFrame([("en", b"", b"a", None, 3 << 60), ("en", b"", b"b", None, 3 << 60)], "lang string, prefix binary, next binary, suffix binary, f long")
    pairs = spark.createDataFrame([("en", b"a", b"b", b"b", (3 << 60) - 7)], known.schema)
    [row] = module._scores([known, pairs], 2_000_000).collect()
    assert row.score == 2_000_000 * ((3 << 60) - 7) // (6 << 60)
