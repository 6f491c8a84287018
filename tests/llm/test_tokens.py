"""Token counts and token files against the tokenizers library on whole texts."""

from __future__ import annotations

import random
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest
from conftest_llm import SF_DIR, by_id, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from marginlab.llm import queries, token_output
from marginlab.llm.pieces import PieceCounter, PieceEncoder
from marginlab.llm.token_counts import token_counts
from marginlab.llm.token_output import pack, read_tokens, token_digests, unpack, write_tokens
from marginlab.session import new_shared_path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
EDGE = [
    "", None, " ", "  \n ", "a  b", "x\n\ny  <|endoftext|>  z <|endoftext|>", " lead", "trail ",
    "a　b ́c é x", "it's I'll  can't 12 3,4", "İ ẞ ΑΣ ΑΣ. \t\t a \n b", "<|startoftext|> <|endoftext|>",
    "word, word. word!? word's x.y|z", "é, é, ſ. ŉ; ᾳ! 好, 好。 ①. ٣,", "\x00 a\x01 \x85 b c ​ d",
    "SERGİ.", "GALERİ, SERGİ!", "YENİ: x", "İ. ŉ, ſ! ĸ? Ŀ; Ǆ: ß. ẞ.",
    "long" * 5000, "many words " * 3000,
]


def ids(path):
    t = Tokenizer.from_file(path)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab e'́.,!|9\n\t 　sS<|endoftext>É好", max_size=60))
def test_pieces_encode_as_the_whole_text(text):
    whole = ids_byte(text)
    assert np.frombuffer(PIECES["byte"].encode([text])[0], np.uint32).tolist() == whole
    assert PIECES["word"].count([text]) == [len(ids_word(text))]


@pytest.mark.parametrize("seed", range(4))
def test_letters_before_punctuation(seed):
    rnd = random.Random(seed)
    letters = [chr(c) for c in range(0x41, 0x250)] + ["\u0301", "\u0307", "Σ", "ς", "ﬁ", "K", "Å"]
    marks = [" ", " ", ".", ", ", "!", "?", ";", ":", "|", "%", "#", "$", "&", "*", "'", "’", "<", "_"]
    for _ in range(1500):
        text = "".join(rnd.choice(letters if rnd.random() < 0.6 else marks) for _ in range(rnd.randint(1, 12)))
        assert PIECES["word"].count([text]) == [len(ids_word(text))], text
        assert np.frombuffer(PIECES["byte"].encode([text])[0], np.uint32).tolist() == ids_byte(text), text


PIECES = {"byte": PieceEncoder(BYTE, 50), "word": PieceCounter(WORD, 50)}
ids_word, ids_byte = ids(WORD), ids(BYTE)


def test_new_words_of_known_parts_need_no_library():
    pieces = PieceEncoder(BYTE)
    pieces.encode(["x beta.\ngamma, gamma!"])
    pieces.tokenizer, pieces.model = None, SimpleNamespace(tokenize=None)
    text = "x gamma.\ngamma! beta, beta.\ngamma!"
    assert np.frombuffer(pieces.encode([text])[0], np.uint32).tolist() == ids_byte(text)


@pytest.mark.parametrize("remembered", [5, 800_000])
@pytest.mark.parametrize("texts", [["a b", " a  b", None, "c\n", "a b", "", "b \nc a"], [" a", "b ", "a  b "], ["a", "b c"], []])
def test_texts_with_and_without_white_space_beside_spaces(texts, remembered):
    pieces = PieceEncoder(BYTE, remembered)
    for batch in (texts, texts[::-1]):
        found = [np.frombuffer(x, np.uint32).tolist() for x in pieces.encode(batch)]
        assert found == [ids_byte(t) for t in batch]


def test_counts_of_edge_texts(spark):
    docs = documents(spark, EDGE).withColumn("key", F.lit("x")).withColumn("n_tokens", F.lit("y"))
    found = by_id(token_counts(docs, WORD), "n_bytes", "n_tokens", "over_limit")
    for i, t in enumerate(EDGE):
        n = len(ids_word(t))
        assert found[i] == (len((t or "").encode()), n, n > 2048), i


def test_counts_of_repeated_and_no_rows(spark):
    docs = documents(spark, [(1, "a b"), (1, "a b"), (None, None)])
    assert sorted(r.n_tokens for r in token_counts(docs, WORD).collect()) == [0, 2, 2]
    assert token_counts(docs.limit(0), WORD).collect() == []


@pytest.mark.parametrize("name", ["op1_token_counts", "op10_token_output"])
def test_queries_equal_the_library(spark, name):
    texts = {r[0]: r[1] for r in queries.table(spark, SF_DIR, "documents").select("doc_id", "text").collect()}
    df = queries.QUERIES[name](spark, SF_DIR)
    if name == "op1_token_counts":
        assert by_id(df, "n_tokens") == {i: len(ids_word(t)) for i, t in texts.items()}
    else:
        assert by_id(df, "start", "n_tokens", "ids_crc32") == expected(sorted(texts.items()))


def expected(rows, end=2):
    encode, start, out = ids(BYTE), 0, {}
    for i, t in rows:
        found = np.array([*encode(t), end], "<u4")
        out[i] = (start, len(found), zlib.crc32(found.tobytes()))
        start += len(found)
    return out


def test_files_of_edge_texts(spark):
    docs = documents(spark, EDGE).withColumn("shard", F.lit("x")).withColumn("tie", F.lit("y"))
    path = new_shared_path(spark, "tokens")
    write_tokens(docs, path, BYTE, 2)
    assert by_id(token_digests(spark, path), "start", "n_tokens", "ids_crc32") == expected(enumerate(EDGE))
    got = by_id(read_tokens(spark, path), "ids")
    assert np.frombuffer(got[9], np.uint32).tolist() == [*ids(BYTE)(EDGE[9]), 2]
    ranks = spark.read.parquet(f"{path}/ranks")
    counts = Counter(i for t in EDGE for i in [*ids(BYTE)(t), 2])
    assert [r.id for r in ranks.orderBy("rank").collect()] == sorted(counts, key=lambda i: (-counts[i], i))


def test_files_of_repeated_and_no_rows(spark):
    path = new_shared_path(spark, "tokens")
    write_tokens(documents(spark, [(None, "z"), (1, "a b"), (1, "a b"), (1, None)]), path, BYTE, 2)
    found = token_digests(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None, 1, 1, 1] and [r.start for r in found][:2] == [0, 2]
    path = new_shared_path(spark, "tokens")
    write_tokens(documents(spark, []), path, BYTE, 2)
    assert token_digests(spark, path).collect() == []


@settings(deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1))))
def test_pack_round_trip(numbers):
    control, data = pack(np.array(numbers, np.uint32))
    assert unpack(control, data, len(numbers)).tolist() == numbers
    assert len(control) == (len(numbers) + 3) // 4


@pytest.fixture
def apart(spark):
    """Small shuffle partitions stay apart."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    was = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, was)


def test_files_in_the_order_of_their_paths_hold_ascending_ids(spark, apart, monkeypatch):
    """Several shards of several files each, of very different sizes."""
    monkeypatch.setattr(token_output, "CHUNK", 2_000)
    monkeypatch.setattr(token_output, "FILE_BYTES", 4_000)
    rnd = random.Random(2)
    docs = documents(spark, [(i, "word " * rnd.choice([1, 5, 400])) for i in range(300)]).repartition(5)
    path = new_shared_path(spark, "tokens")
    write_tokens(docs, path, BYTE, 2)
    stored = spark.read.parquet(f"{path}/ids").withColumn("file", F.input_file_name()).withColumn("at", F.monotonically_increasing_id())
    rows = stored.select("file", "at", "doc_id", "shard", "chunk").orderBy("file", "at").collect()
    assert [r.doc_id for r in rows] == list(range(300))
    assert len({r.file for r in rows}) == len({(r.shard, r.chunk) for r in rows}) > len({r.shard for r in rows}) > 1


def test_equal_rows_are_dealt_over_shards(spark, apart):
    docs = documents(spark, [(None, None)] * 400 + [(7, "same")] * 400).repartition(3)
    path = new_shared_path(spark, "tokens")
    write_tokens(docs, path, BYTE, 2)
    sizes = [r[1] for r in spark.read.parquet(f"{path}/ids").groupBy("shard").count().collect()]
    assert sum(sizes) == 800 and max(sizes) < 400
    found = token_digests(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None] * 400 + [7] * 400 and [r.start for r in found] == [*range(400), *range(400, 1200, 2)]
