"""Benchmark decontamination by a prefix-filtered join.

DataFrame functions only. A window is ``length`` consecutive words of a benchmark
item (all of a shorter item). For a document to contain a window, it must contain
every word of it, so one word suffices to find it: of each window the word that is
rarest over all documents, its necessary prefix in the order of rarity. Windows of
an item that share their rarest word at the same place share one anchor. Document
words join anchors on the word; the place of the anchor bounds how far a match
can reach to both sides; and comparing the words there, up to a window to each
side, tells whether a whole window occurs. All windows that hold the anchor are
verified at once as one run of equal words.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginlab.session import new_shared_path

#: Separators of words, once A-Z are in lower case.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Anchors, or words of the benchmark, that are broadcast at once. More go in further passes over the documents.
BLOCK = 50_000


def plain_words(text: Column) -> Column:
    """Words of a text, only A-Z in lower case; none of a null."""
    text = F.coalesce(text, F.lit(""))
    # lower() would also change other letters; a text of ASCII alone has none.
    ascii_only = F.length(text) == F.octet_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )
    return F.array_remove(F.split(lowered, SEPARATOR), "")


def _blocks(small: DataFrame) -> list[DataFrame]:
    """A table of distinct rows in parts that are broadcast, each of BLOCK rows at most: rows are dealt by a hash, and the parts counted."""
    n = -(-small.count() // BLOCK)

    def part() -> Column:
        return F.pmod(F.xxhash64(*[F.col(c) for c in small.columns]), F.lit(max(n, 1)))

    while n > 1 and small.groupBy(part().alias("part")).count().agg(F.max("count")).first()[0] > BLOCK:
        n += -(-n // 8)
    return [F.broadcast(small.where(part() == k)) for k in range(n)]


def _union(frames: list[DataFrame], empty: DataFrame) -> DataFrame:
    out = empty
    for f in frames:
        out = out.unionByName(f)
    return out


def anchors(items: DataFrame, counts: DataFrame, length: int) -> DataFrame:
    """(word, item, least, left, right): the rarest word of each window, and the words around it.

    ``items`` has ``item``, ``row`` (distinct) and ``words``; ``counts`` has ``word``
    and ``n``. ``left`` and ``right`` run outwards; ``least`` is the length of the
    item's windows.
    """
    placed = items.select("row", F.posexplode("words").alias("at", "word")).join(counts, "word", "left")
    ranked = F.sort_array(F.collect_list(F.struct("at", F.coalesce("n", F.lit(0)).alias("n"), "word")))
    # An item is one row of the benchmark, so its words fit in a row.
    ranked = placed.groupBy("row").agg(ranked.alias("ranked"))
    least = F.least(F.lit(length), F.size("words"))
    df = items.join(ranked, "row").withColumn("least", least)
    df = df.withColumn("ranked", F.transform("ranked", lambda x: F.struct(x["n"], x["word"], x["at"])))
    rarest = F.transform(
        F.sequence(F.lit(0), F.size("words") - F.col("least")),
        lambda s: F.array_min(F.slice("ranked", s + 1, F.col("least")))["at"],
    )
    df = df.withColumn("at", F.explode(F.array_distinct(rarest)))
    return df.select(F.get("words", F.col("at")).alias("word"), "item", "least", *_around("words", "at", length))


def _around(found: str, at: str, length: int) -> list[Column]:
    """Up to ``length`` - 1 words before (nearest first) and after a place."""
    reach = length - 1
    start = F.greatest(F.col(at) - reach, F.lit(0))
    left = F.reverse(F.slice(found, start + 1, F.col(at) - start))
    return [left.alias("left"), F.slice(found, F.col(at) + 2, F.lit(reach)).alias("right")]


def _equal_words(a: str, b: str) -> Column:
    """How many first words two arrays share."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    differ = F.array_position(same, False)
    return F.when(differ > 0, differ - 1).otherwise(F.least(F.size(a), F.size(b))).cast("int")


def benchmark_runs(
    docs: DataFrame, benchmark: DataFrame, length: int = 13, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(key, tie, item, first, last): runs of a document's words in which windows of an item occur.

    Places count words from 0. Every word of a window's occurrence lies in a run of
    that item. ``tie`` is a hash of the text, for rows that share a key.
    """
    spark = docs.sparkSession
    path = new_shared_path(spark, "decontaminate")
    found = benchmark.select(F.col(f"`{item_key}`").alias("item"), plain_words(F.col(f"`{item_text}`")).alias("words"))
    found = found.where(F.size("words") > 0).distinct().withColumn("row", F.struct("item", "words"))
    words = docs.select(
        F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("tie"), plain_words(F.col(f"`{text}`")).alias("words")
    )

    # How often each word of the benchmark occurs in all documents.
    found.select(F.explode("words").alias("word")).distinct().write.parquet(f"{path}/vocabulary")
    vocabulary = spark.read.parquet(f"{path}/vocabulary")
    each = words.select(F.explode_outer("words").alias("word"))
    counted = [each.join(b, "word", "left_semi").groupBy("word").agg(F.count("*").alias("n")) for b in _blocks(vocabulary)]
    counts = _union(counted, vocabulary.select("word", F.lit(0).cast("long").alias("n")).limit(0))

    anchors(found, counts, length).distinct().write.parquet(f"{path}/anchors")
    table = spark.read.parquet(f"{path}/anchors")
    table = table.select("word", "item", "least", F.col("left").alias("item_left"), F.col("right").alias("item_right"))
    # The outer form keeps Spark from cutting each text a second time to filter empty ones.
    places = words.select("key", "tie", "words", F.posexplode_outer("words").alias("at", "word"))
    runs = []
    for block in _blocks(table):
        # Nothing but the word is tested by the join: a test of arrays would take it out of
        # generated code, and every word would then be copied with its whole document.
        met = places.join(block, "word").select(
            "key", "tie", "item", "least", "at", "item_left", "item_right", *_around("words", "at", length)
        )
        # Length bound: the sides together must leave room for a whole window.
        room = F.least(F.size("left"), F.size("item_left")) + 1 + F.least(F.size("right"), F.size("item_right"))
        before, after = _equal_words("left", "item_left"), _equal_words("right", "item_right")
        run = F.struct((F.col("at") - before).alias("first"), (F.col("at") + after).alias("last"))
        whole = (room >= F.col("least")) & (before + 1 + after >= F.col("least"))
        met = met.select("key", "tie", "item", F.explode_outer(F.when(whole, F.array(run))).alias("run"))
        runs.append(met.where("run is not null").select("key", "tie", "item", "run.first", "run.last"))
    kind, item_kind = words.schema["key"].dataType.simpleString(), found.schema["item"].dataType.simpleString()
    empty = spark.createDataFrame([], f"key {kind}, tie long, item {item_kind}, first int, last int")
    return _union(runs, empty)


def contamination(
    docs: DataFrame, benchmark: DataFrame, length: int = 13, least_share: int = 20, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``key``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated`` of each row.

    ``n_hit``: words inside an occurrence of a window of the benchmark; ``n_items``:
    items with occurring windows; ``items_sha256``: of their ids, sorted as texts,
    joined by commas. ``contaminated``: at least one in ``least_share`` words is hit.

    The benchmark's words and anchors are broadcast in blocks of a counted size,
    each of which is a pass over the documents; their words are filtered by them before anything moves, and only runs of
    equal words are shuffled. A passage that very many documents hold adds a few
    rows to each, never pairs of documents.

    A null or empty text has no words and is clean; items without words have no
    windows. Repeated documents keep a row each, repeated items count once, and an
    item with a null id counts for ``n_hit`` but has no id to list. Either table may
    be empty.
    """
    df = _judged(docs, benchmark, length, least_share, key, text, item_key, item_text)
    return df.select(F.col("key").alias(key), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def _judged(docs, benchmark, length, least_share, key, text, item_key, item_text) -> DataFrame:
    """``contamination`` with the columns ``key`` and ``tie``."""
    runs = benchmark_runs(docs, benchmark, length, key, text, item_key, item_text)
    # A document's runs are bounded by its length and the items.
    path = new_shared_path(docs.sparkSession, "runs")
    runs.distinct().write.parquet(path)
    runs = docs.sparkSession.read.parquet(path)
    hit = runs.select("key", "tie", F.explode(F.sequence("first", "last")).alias("at")).distinct()
    hit = hit.groupBy("key", "tie").agg(F.count("*").alias("n_hit"))
    names = F.sort_array(F.collect_set(F.col("item").cast("string")))
    named = runs.select("key", "tie", "item").distinct().groupBy("key", "tie").agg(names.alias("items"))
    rows = docs.select(
        F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("tie"),
        F.size(plain_words(F.col(f"`{text}`"))).cast("long").alias("n_words"),
    )
    hit = hit.withColumnsRenamed({"key": "hit_key", "tie": "hit_tie"})
    named = named.withColumnsRenamed({"key": "named_key", "tie": "named_tie"})
    both = hit.join(named, F.col("hit_key").eqNullSafe(F.col("named_key")) & (F.col("hit_tie") == F.col("named_tie")))
    df = rows.join(both, F.col("key").eqNullSafe(F.col("hit_key")) & (F.col("tie") == F.col("hit_tie")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return df.select(
        "key",
        "tie",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (least_share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, length: int = 13, least_share: int = 20, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated; all columns are kept, whatever their names."""
    path = new_shared_path(docs.sparkSession, "contaminated")
    found = _judged(docs, benchmark, length, least_share, key, text, item_key, item_text).where("contaminated")
    found.select(F.col("key").alias("gone_key"), F.col("tie").alias("gone_tie")).distinct().write.parquet(path)
    gone = docs.sparkSession.read.parquet(path)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{key}`").alias("key"),
        F.xxhash64(F.col(f"`{text}`")).alias("tie"),
    )
    same = F.col("key").eqNullSafe(F.col("gone_key")) & (F.col("tie") == F.col("gone_tie"))
    return rows.join(gone, same, "left_anti").select("row.*")
