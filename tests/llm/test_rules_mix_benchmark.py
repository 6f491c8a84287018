"""Quality rules, mixing and decontamination against plain definitions on small tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest
from conftest_llm import SF_DIR, by_id, documents
from marginlab.llm import queries
from marginlab.llm.decontaminate import contamination, drop_contaminated
from marginlab.llm import mixing
from marginlab.llm.mixing import Level, domain_tree, mix
from marginlab.llm.quality_rules import LineRules, clean_documents, quality_verdicts
from pyspark.sql import functions as F
from run_checks import compare, connect

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert compare(queries.QUERIES[name](spark, SF_DIR), duck, queries.ORACLES[name]) is None


# Quality rules


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    places = defaultdict(list)
    for i in range(len(words) - 2):
        places[tuple(words[i : i + 3])].append(i)
    repeated = {p for at in places.values() if len(at) > 1 for i in at for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed


PROSE = " ".join(f"word{i}" for i in range(60)) + "."
NAV = " | ".join(f"Item{i}" for i in range(80))
TEXTS = [
    None, "", " \n\n", PROSE, PROSE + "\n" + NAV, NAV, "one two three " * 40, PROSE + "\n" + PROSE,
    "a b\n" * 60, " ".join(f"thing{i}%%%" for i in range(70)), PROSE + "\nAll rights reserved.\n\nHome", "é# *" * 30 + "\x0b\x0c\x1f x",
    " ".join(f"long{i % 3000}" for i in range(30_000)), "x y " * 30 + " ".join(f"tail{i}" for i in range(61)),
]
NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_counts_of_edge_texts(spark):
    docs = documents(spark, TEXTS).withColumn("words", F.lit(1)).withColumn("n_words", F.lit("x"))
    found = by_id(quality_verdicts(docs), *NAMES, "kept", "clean_text")
    for i, t in enumerate(TEXTS):
        assert found[i][:6] == plain_counts(t), i
        assert not (found[i][5] and found[i][6])
    assert [i for i in found if found[i][6]] == [3, 10, 13]
    assert found[10][7] == PROSE + "\n" and found[0][7] == ""


def test_cleaned_documents(spark):
    docs = documents(spark, TEXTS).withColumn("__x", F.lit(1))
    kept = clean_documents(docs)
    assert kept.columns == docs.columns
    rows = {r.doc_id: r for r in kept.collect()}
    assert set(rows) == {3, 10, 13} and rows[10].text == PROSE + "\n" and rows[10].n_chars == len(PROSE) + 1
    assert quality_verdicts(documents(spark, [(1, PROSE), (1, PROSE), (None, PROSE)])).where("kept").count() == 3
    assert clean_documents(docs.limit(0)).collect() == []
    strict = LineRules(most_lost=0.0)
    assert {r.doc_id for r in clean_documents(docs, strict).collect()} == {3, 13}


# Mixing


def water_level(children, budget):
    """The least level at which vessels of (capacity, width) hold the budget, or that fills them all; by bisection, then exactly."""
    held = lambda x: sum(min(Fraction(c), w * x) for c, w in children)
    top = max(Fraction(c, w) for c, w in children)
    if held(top) <= budget:
        return top
    low, high = Fraction(0), top
    corners = {Fraction(c, w) for c, w in children}
    while any(low < c < high for c in corners):
        middle = sorted(c for c in corners if low < c < high)[0]
        low, high = (middle, high) if held(middle) <= budget else (low, middle)
    rising = sum(w for c, w in children if Fraction(c, w) > low)
    return low + (budget - held(low)) / rising


def plain_mix(rows, weights, budget, epochs, seed):
    """{(doc_id, epoch)} of rows (doc_id, path, tokens); weights by depth and name.

    A node holds what its leaves hold that a budget can reach. Nodes of a family are vessels as wide
    as their weight with a common water level.
    """
    weight = lambda p: weights.get((len(p), p[-1]), 1)
    reached = [(p, n) for _, p, n in rows if all(weight(p[:k]) > 0 for k in (1, 2, 3))]
    got = {(): budget}
    for depth in (1, 2, 3):
        for above in [p for p in got if len(p) == depth - 1]:
            family = {p[:depth] for p, n in reached if p[: depth - 1] == above and n > 0}
            caps = {p: epochs * sum(n for q, n in reached if q[:depth] == p) for p in family}
            if family:
                level = water_level([(caps[p], weight(p)) for p in family], got[above])
                got |= {p: min(caps[p], int(level * weight(p))) for p in family}
    out = set()
    for path in {p for p in got if len(p) == 3}:
        docs = [(i, n) for i, p, n in rows if p == path]
        total = sum(n for _, n in docs)
        if not total:
            continue
        passes, rest = divmod(got[path], total)
        out |= {(i, e) for i, _ in docs for e in range(passes)}
        upto = 0
        for i, n in sorted(docs, key=lambda d: (hashlib.md5(f"{seed}:{passes}:{d[0]}".encode()).hexdigest(), d[0])):
            upto += n
            if rest and upto <= rest:
                out.add((i, passes))
    return out


@pytest.mark.parametrize("seed, budget, epochs", [(1, 0.5, 1), (2, 0.9, 3), (3, 400, 2), (4, 0, 1), (5, 10**9, 2)])
def test_mix_equals_the_definition(spark, seed, budget, epochs):
    rnd = random.Random(seed)
    rows = [
        (i, rnd.choice(["x", "y", "z", None]), rnd.choice(["s1", "s1", "s1", "s2", None]), rnd.choice([0, 1, 5, 30]))
        for i in range(300)
    ]
    df = spark.createDataFrame([(i, "w " * n, a, s) for i, a, s, n in rows], "doc_id long, text string, lang string, source string")
    levels = [
        Level("top", F.when(F.col("source") == "s1", "a").otherwise("b"), F.expr("case top when 'a' then 3 else 1 end")),
        Level("lang", F.col("lang"), F.expr("case lang when 'x' then 5 when 'z' then 0 else 2 end")),
        Level("source", F.col("source"), F.lit(1)),
    ]
    plain = [(i, ("a" if s == "s1" else "b", a or "", s or ""), n) for i, a, s, n in rows]
    tokens = sum(n for *_, n in plain)
    weights = {(1, "a"): 3, (2, "x"): 5, (2, "y"): 2, (2, ""): 2, (2, "z"): 0}
    want = plain_mix(plain, weights, int(budget * tokens) if isinstance(budget, float) else budget, epochs, seed)
    found = mix(df, levels, budget, epochs, seed).select("doc_id", "__mix.epoch").collect()
    assert len(found) == len(set(found))
    assert {(r.doc_id, r.epoch) for r in found} == want


def test_tokens_without_weight_leave_their_share_to_others(spark):
    rows = [(i, "w", "a", "z") for i in range(100)] + [(100 + i, "w", "a", "x") for i in range(10)]
    rows += [(200 + i, "w", "b", "x") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    levels = [Level("top", F.col("source"), F.lit(1)), Level("lang", F.col("lang"), F.expr("case lang when 'z' then 0 else 1 end"))]
    found = {r[0]: r[1] for r in mix(df, levels, 100).groupBy("source").count().collect()}
    assert found == {"a": 10, "b": 90}


def test_equal_rows_are_taken_as_far_as_they_fit(spark):
    levels = [Level("top", F.lit("a"), F.lit(1))]
    equal = documents(spark, [(1, "w " * 10)] * 10)
    found = mix(equal, levels, 255, 4).groupBy("__mix.epoch").count().orderBy("epoch").collect()
    assert [tuple(r) for r in found] == [(0, 10), (1, 10), (2, 5)]
    beside = equal.withColumn("extra", F.monotonically_increasing_id())
    assert mix(beside, levels, 55).select("extra").distinct().count() == 5


def test_rows_that_share_a_key_are_told_apart(spark, monkeypatch):
    levels = [Level("top", F.lit("a"), F.lit(1))]
    same_key = documents(spark, [(1, f"w{i} " * 10) for i in range(40)] + [(2, "x"), (None, "y")])
    texts = lambda df: sorted(r[0] for r in mix(df, levels, 255).select("text").collect())
    found = texts(same_key)
    assert 24 <= len(found) <= 27 and len(set(found)) == len(found)
    monkeypatch.setattr(mixing, "CROWD", 3)
    assert texts(same_key.repartition(3)) == found


def test_mix_keeps_columns_of_any_name(spark):
    docs = documents(spark, [(1, "a b"), (2, "c")])
    names = ["__times", "__epoch", "__leaf", "__plan", "row", "mix", "key", "tie", "leaf", "cut", "times", "epochs", "place", "a.b", "domain", "n"]
    for n in names:
        docs = docs.withColumn(n, F.concat(F.lit(n), F.col("doc_id").cast("string")))
    found = mix(docs, domain_tree(), 10, out="chosen")
    assert found.columns == [*docs.columns, "chosen"]
    assert sorted(tuple(r)[:-1] for r in found.collect()) == sorted(tuple(r) for r in docs.collect())


def test_mix_edge_rows(spark):
    docs = documents(spark, [(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "c")]).withColumn("domain", F.lit(1)).withColumn("rest", F.lit(1))
    found = mix(docs, domain_tree(), 1.0, 1)
    assert found.columns == [*docs.columns, "__mix"]
    assert sorted((r.doc_id for r in found.collect()), key=str) == [1, 1, 2, 3, None]
    assert mix(docs.limit(0), domain_tree(), 0.5, 1).collect() == []


# Decontamination


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_contamination(text, items, length=13):
    words, hit, names = plain_words(text), set(), set()
    for name, item in items:
        item = plain_words(item)
        n = min(length, len(item))
        windows = {tuple(item[i : i + n]) for i in range(len(item) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
                names.add(str(name))
    digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    return len(words), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(words)


COLUMNS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.mark.parametrize("seed", range(3))
def test_contamination_equals_the_definition(spark, seed):
    """Few words, so that anchors recur and windows overlap, touch the ends and repeat."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(6 if seed else 60)]
    line = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    items = [(i, line(rnd.choice([1, 3, 12, 13, 14, 30]) if i < 30 else 20)) for i in range(40) if seed or i >= 20]
    docs = []
    for _ in range(80):
        words = []
        for _ in range(rnd.randint(0, 4)):
            words += line(rnd.randint(0, 30))
            part = rnd.choice(items)[1]
            words += part[rnd.randint(0, 3) :] if rnd.random() < 0.7 else []
        docs.append(" ".join(w.upper() if rnd.random() < 0.3 else w for w in words))
    items = [(i, ", ".join(w)) for i, w in items]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = by_id(contamination(documents(spark, docs), bench), *COLUMNS)
    assert found == {i: plain_contamination(t, items) for i, t in enumerate(docs)}


def test_contamination_edge_rows(spark):
    line = " ".join(f"b{i}" for i in range(15))
    items = [(1, line), (1, line), (2, None), (3, " ! "), (4, "É solo"), (None, "lone words")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("word", F.lit(1))
    texts = [None, "", "É Solo", "é solo", line, "x " * 400 + line, "x " * 200 + line + " y" * 5000, "Lone-Words", "b0 " * 20]
    docs = documents(spark, texts).withColumn("words", F.lit(1)).withColumn("tie", F.lit(1)).withColumn("item", F.lit(1))
    found = by_id(contamination(docs, bench), *COLUMNS)
    named = [x for x in items if x[0] is not None]
    for i, t in enumerate(texts):
        if i != 7:
            assert found[i] == plain_contamination(t, named), i
    assert found[7] == (2, 2, 0, hashlib.sha256(b"").hexdigest(), True)
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {0, 1, 3, 5, 6, 8}


def test_contamination_of_repeated_and_no_rows(spark):
    bench = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    docs = documents(spark, [(1, "some words"), (1, "some words"), (1, "other"), (None, "some words")])
    rows = [(r.doc_id, r.contaminated) for r in contamination(docs, bench).collect()]
    assert sorted(rows, key=str) == sorted([(1, True), (1, True), (1, False), (None, True)], key=str)
    assert [r.text for r in drop_contaminated(docs, bench).collect()] == ["other"]
    assert contamination(docs.limit(0), bench).collect() == []
    assert contamination(docs, bench.limit(0)).where("contaminated or n_hit > 0").collect() == []
