"""Exact dedup by an extendible-hash index on shared files.

An index is a folder of Parquet tables:

``pages``      one row per text and combining task: ``page`` (number), ``h`` (64-bit hash),
               ``n_bytes``, ``text`` (normalised), ``keys`` (of its documents, ascending).
``directory``  ``slot`` (leading bits of a hash), ``bucket``, ``depth`` (bits that the bucket shares).
``buckets``    one row per page: ``bucket``, ``page``, ``h``, ``chain`` (place of the text among those
               of its hash), ``n`` (documents), ``last`` (their greatest key), ``sha256``.

Tasks combine equal texts before anything moves, so a group of copies that holds a
third of all rows is one page per task. The directory starts with one bucket and
doubles while a bucket at full depth is overfull; each split sends half the range
of hashes to a new bucket. A bucket is a range of hashes and has one owner task,
which takes its pages in the order of their hashes, chains the different texts of
one hash, and tells them apart by comparing their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginlab.session import new_shared_path

#: Bytes of different texts, and rows, that a task combines before it lets go of them.
COMBINED_BYTES, COMBINED_ROWS = 32 << 20, 200_000
#: Bytes of text in a full bucket, and the most bits of a slot: the directory has 2^18 slots at most.
BUCKET_BYTES, DEEPEST = 16 << 20, 18


def lower_ascii(text: bytes) -> bytes:
    """A-Z in lower case; other letters are bytes beyond ASCII and stay."""
    return text.lower()


def directory(loads: np.ndarray, full: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each slot, local depth of each bucket); buckets are numbered in the order of their hashes.

    ``loads`` are bytes by the leading bits of the hash (a power of two of them). A
    bucket over ``full`` splits; one that shares all bits of ``loads`` cannot, and
    its owner chains what it holds.
    """
    finest = len(loads).bit_length() - 1
    upto = np.concatenate([[0], np.cumsum(loads)])
    slots, depth = np.zeros(1, np.int64), 0
    local, first, todo = [0], [0], [0]
    while todo:
        b = todo.pop()
        width = 1 << (finest - local[b])
        if upto[first[b] + width] - upto[first[b]] <= full or local[b] == finest:
            continue
        if local[b] == depth:
            slots, depth = np.repeat(slots, 2), depth + 1
        half, shift = width // 2, finest - depth
        local[b] += 1
        local.append(local[b])
        first.append(first[b] + half)
        slots[first[-1] >> shift : (first[b] + width) >> shift] = len(local) - 1
        todo += [b, len(local) - 1]
    order = np.argsort(first)
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    return number[slots], np.array(local)[order]


def _hash(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text)


def _pages(rows: DataFrame, kind: str, normalise: Callable, hash_of: Callable) -> DataFrame:
    """``rows`` (key, text) with equal texts of a task combined."""

    def page(held: dict[bytes, list], of: pa.DataType) -> pa.RecordBatch:
        texts = list(held)
        hashes = np.array([hash_of(t) for t in texts], np.uint64).view(np.int64)
        keys = [sorted(k, key=lambda x: (x is not None, x)) for k in held.values()]
        return pa.RecordBatch.from_arrays(
            [pa.array(hashes), pa.array([len(t) for t in texts], pa.int64()), pa.array(texts, pa.binary()), pa.array(keys, pa.list_(of))],
            ["h", "n_bytes", "text", "keys"],
        )

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_bytes, n = {}, 0, 0
        for batch in batches:
            of = batch.schema.field(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = normalise(text or b"")
                keys = held.get(text)
                if keys is None:
                    keys = held[text] = []
                    n_bytes += len(text)
                keys.append(key)
                n += 1
                if n_bytes >= COMBINED_BYTES or n >= COMBINED_ROWS:
                    yield page(held, of)
                    held, n_bytes, n = {}, 0, 0
        if held:
            yield page(held, of)

    return rows.mapInArrow(combine, f"h long, n_bytes long, text binary, keys array<{kind}>")


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages of an owner, in the order of ``h``: the place of each text in the chain of its hash."""
    now, chain, digests = None, [], []
    for batch in batches:
        places, found = [], []
        for h, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if h != now:
                now, chain, digests = h, [], []
            for at, other in enumerate(chain):
                if other == text:
                    break
            else:
                at = len(chain)
                chain.append(text)
                digests.append(hashlib.sha256(text).hexdigest())
            places.append(at)
            found.append(digests[at])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(places, pa.int32()), *batch.columns[3:], pa.array(found)],
            ["page", "h", "chain", "n", "last", "bucket", "sha256"],
        )


def build_index(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", full: int = BUCKET_BYTES,
    normalise: Callable[[bytes], bytes] = lower_ascii, hash_of: Callable[[bytes], int] = _hash,
) -> None:
    """Write the index of ``docs`` to ``path``, a folder that all executors reach.

    Texts are equal if ``normalise`` gives the same bytes. Each is written once per
    combining task and shuffled once, to the owner of its bucket. ``hash_of`` must
    give the same number below 2^64 for equal bytes; its collisions cost time only.
    A bucket holds ``full`` bytes or cannot be split further. Only sums over
    leading bits of the hash, 2^DEEPEST at most, come to the driver.

    A null text counts as empty. Keys may be null or repeated, repeated rows are
    documents of their own. An empty table gives an empty index. Other columns are
    ignored, whatever their names.
    """
    spark, kind = docs.sparkSession, docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("binary").alias("text"))
    pages = _pages(rows, kind, normalise, hash_of).withColumn("page", F.monotonically_increasing_id())
    pages.write.option("compression", "zstd").parquet(f"{path}/pages")
    pages = spark.read.parquet(f"{path}/pages")

    total = pages.agg(F.sum("n_bytes")).first()[0] or 0
    finest = min(max((total // full).bit_length() + 4, 1), DEEPEST)
    prefix = F.shiftrightunsigned("h", 64 - finest)
    loads = np.zeros(1 << finest, np.int64)
    for slot, n in pages.groupBy(prefix.alias("slot")).agg(F.sum("n_bytes").alias("n")).toLocalIterator():
        loads[slot] = n
    slots, depths = directory(loads, full)
    depth = len(slots).bit_length() - 1
    table = pa.table({"slot": np.arange(len(slots)), "bucket": slots, "depth": depths[slots]})
    spark.createDataFrame(table).coalesce(1).write.parquet(f"{path}/directory")

    slot = F.shiftrightunsigned("h", 64 - depth) if depth else F.lit(0).cast("long")
    # At most 2^DEEPEST rows.
    owners = F.broadcast(spark.read.parquet(f"{path}/directory").select("slot", "bucket"))
    routed = pages.select(
        "page", "h", "text", F.size("keys").cast("long").alias("n"), F.element_at("keys", -1).alias("last"), slot.alias("slot")
    )
    routed = routed.join(owners, "slot").drop("slot")
    routed = routed.repartitionById(len(depths), F.col("bucket").cast("int")).sortWithinPartitions("h")
    chained = routed.mapInArrow(
        _chain, f"page long, h long, chain int, n long, last {kind}, bucket long, sha256 string"
    )
    chained.write.parquet(f"{path}/buckets")


def index_groups(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """``key``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` (of the normalised text) of each document of an index.

    The document with the greatest key stays, nulls being least; of several with
    that key one stays. Documents are told by the page that holds them, so a group
    is added up over its pages and its documents never meet in one task.
    """
    buckets = spark.read.parquet(f"{path}/buckets")
    groups = buckets.groupBy("h", "chain").agg(
        F.sum("n").alias("group_size"), F.max(F.struct("last", "page")).alias("top")
    )
    named = buckets.select("page", "h", "chain", "sha256").join(groups, ["h", "chain"])
    named = named.select("page", "sha256", "group_size", "top")
    pages = spark.read.parquet(f"{path}/pages").select("page", F.posexplode("keys").alias("at", "key"), F.size("keys").alias("n"))
    kept = (F.col("page") == F.col("top.page")) & (F.col("at") == F.col("n") - 1)
    return pages.join(named, "page").select(
        F.col("key").alias(key), F.col("top.last").alias("keep_id"), "group_size", kept.alias("kept"), F.col("sha256").alias("text_sha256")
    )


def distinct_texts(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """``key`` of the document that stays, ``group_size`` and the normalised ``text`` of each group of an index."""
    buckets = spark.read.parquet(f"{path}/buckets")
    groups = buckets.groupBy("h", "chain").agg(F.sum("n").alias("group_size"), F.max(F.struct("last", "page")).alias("top"))
    texts = spark.read.parquet(f"{path}/pages").select("page", F.col("text").cast("string").alias("text"))
    groups = groups.select(F.col("top.page").alias("page"), F.col("top.last").alias(key), "group_size")
    return texts.join(groups, "page").select(key, "group_size", "text")


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", **index) -> DataFrame:
    """``index_groups`` of a new index of ``docs`` in the shared folder."""
    path = new_shared_path(docs.sparkSession, "exact-index")
    build_index(docs, path, key, text, **index)
    return index_groups(docs.sparkSession, path, key)
