"""Repeated passages against the definition, window by window."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from conftest_llm import SF_DIR, by_id, documents
from marginlab.llm import queries
from marginlab.llm.substring_dedup import Windows, _word_hashes, remove_repeats
from pyspark.sql import functions as F


def plain(rows, length=20):
    """{key: (words, removed, digest)} from all windows in order; rows are (key, text) in order."""
    seen, out = set(), {}
    for key, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - length + 1):
            window = tuple(words[i : i + length])
            if window in seen:
                gone.update(range(i, i + length))
            seen.add(window)
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out[key] = (len(words), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def result(df):
    return by_id(df, "n_words", "n_removed", "kept_sha256")


def test_query_equals_the_definition(spark):
    docs = queries.table(spark, SF_DIR, "documents").select("doc_id", "text").collect()
    want = plain(sorted((r[0], r[1]) for r in docs))
    assert result(queries.QUERIES["op6_substring_dedup"](spark, SF_DIR)) == want
    assert sum(w[1] for w in want.values()) > 1000


@pytest.mark.parametrize("seed", range(4))
def test_random_passages(spark, seed):
    """Few words, so that anchors recur with other surroundings, shared passages and copies."""
    rnd = random.Random(seed)
    vocabulary = ["a", "b", "c"] if seed % 2 else [f"w{i}" for i in range(40)]
    passages = [[rnd.choice(vocabulary) for _ in range(rnd.choice([15, 20, 25, 60]))] for _ in range(6)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rnd.randint(0, 5)):
            words += rnd.choice(passages) if rnd.random() < 0.5 else [rnd.choice(vocabulary) for _ in range(rnd.randint(1, 40))]
        if rnd.random() < 0.2:
            words += ["same"] * rnd.randint(10, 60)
        rows.append((i, " ".join(words)))
    rows += [(60 + i, rows[i][1]) for i in range(0, 60, 7)]
    assert result(remove_repeats(documents(spark, rows))) == plain(rows)


def turns(n, a, b):
    """2^n letters or words in the order of the Thue-Morse sequence."""
    return [b if bin(i).count("1") % 2 else a for i in range(1 << n)]


def test_long_words_and_windows_that_cancel_out_in_sums(spark):
    """Sums modulo 2^64 cannot tell the sequence from its complement."""
    before = [f"w{i}" for i in range(19)]
    rows = [(1, " ".join([*before, "".join(turns(10, "a", "b"))])), (2, " ".join([*before, "".join(turns(10, "b", "a"))])),
            (3, " ".join(turns(10, "xx", "yy"))), (4, " ".join(turns(10, "yy", "xx")))]
    found = result(remove_repeats(documents(spark, rows)))
    assert found == plain(rows) and found[2][1] == 0
    assert result(remove_repeats(documents(spark, rows), length=600)) == plain(rows, 600)


def test_edge_rows(spark):
    words = [f"w{i}" for i in range(20)]
    line, long = " ".join(words), " ".join(f"x{i % 40_000}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, " ".join(words[:19])), (5, line), (6, "p\n" + "\t".join(words) + " q"),
            (7, "same " * 50), (8, long), (9, "é " * 19 + "é"), (10, line + " " + line), (11, "a b" * 3)]
    docs = documents(spark, rows).withColumn("row", F.lit("x")).withColumn("key", F.lit(1))
    df = remove_repeats(docs)
    assert result(df) == plain(rows)
    kept = by_id(df, "kept_text")
    assert kept[6] == "p q" and kept[5] == line and kept[7] == "same" and kept[10] == ""


def test_repeated_rows_null_keys_and_no_rows(spark):
    line = " ".join(f"w{i}" for i in range(30))
    docs = documents(spark, [(1, line), (1, line), (None, line)])
    found = [(r.doc_id, r.n_removed) for r in remove_repeats(docs).collect()]
    assert sorted(found, key=str) == sorted([(1, 30), (1, 30), (None, 0)], key=str)
    assert remove_repeats(docs.limit(0)).collect() == []


def test_words_of_any_length_have_hashes_of_their_own():
    words = [b"ab"[k % 2 : k % 2 + 1] * n + tail for k in range(2) for n in range(40) for tail in (b"", b"\0", b"\0\0", b"x", "é".encode())]
    words = sorted({w for w in words if w})
    raw = b" ".join(words * 2)
    ends = np.cumsum([len(w) + 1 for w in words * 2]) - 1
    found = _word_hashes(raw, ends - [len(w) for w in words * 2], ends)
    assert len(set(found.tolist())) == len(words) and (found[: len(words)] == found[len(words) :]).all()


def test_equal_windows_share_their_anchor():
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice("ab") for _ in range(80)).encode() for _ in range(30)]
    w, seen = Windows(texts, 20, 8), {}
    words = [t.split() for t in texts]
    for h, a, d, s in zip(w.hashes(np.arange(len(w.at)), np.arange(len(w.at)) + 1), w.anchor, w.doc, w.start):
        key = tuple(words[d][s : s + 20])
        assert seen.setdefault(key, (h, a)) == (h, a)
    assert len({h for h, _ in seen.values()}) == len(seen)
    assert set(w.anchor) == set(w.seeds())
