"""Token ids as binary files, in the order of the documents.

Format. A dataset is Parquet tables in one folder:

``ranks``  (rank, id): ids by falling frequency in the dataset, ties by id.
``ids``    one row per document: ``shard``, ``chunk`` and ``seq`` (its place: shards in
           turn, chunks of a shard in turn, rows in turn), ``doc_id``, ``start`` (ids of the
           shard before it), ``n_tokens``, ``control`` and ``data``. A chunk is one file,
           in a folder named by shard and chunk, so files in the order of their paths hold
           the documents in ascending order.
``key``    no rows; the type of ``doc_id``.

``data`` holds the rank of each id in as many bytes as it needs (1 to 4, low byte
first); the 256 most frequent ids take one. ``control`` holds the byte counts less
one, two bits each, four to a byte, low bits first. The decoder looks a control
byte up in a table of byte counts, sums them to offsets and gathers the bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marginlab.llm.pieces import encoder, slices, strings

#: Bytes of text that a worker cuts and encodes at once.
CHUNK = 4 << 20

#: Bytes of ids of the working table, or of data, that a worker codes or decodes at once.
CODED = 1 << 20

#: Bytes of ids of a chunk, which is one file: less than a row group of Parquet, so no file is split between readers.
FILE_BYTES = 32 << 20

#: Byte counts of the four ids under each control byte.
_COUNTS = 1 + (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.int64)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit numbers."""
    control, data = _pack_rows(ranks, np.array([len(ranks)]))
    return control[0].as_py(), data[0].as_py()


def _pack_rows(ranks: np.ndarray, sizes: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """``pack`` of rows that have the given numbers of ranks in turn."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    more = (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    ends, quads = np.cumsum(sizes), np.concatenate([[0], np.cumsum((sizes + 3) // 4)])
    padded = np.zeros(int(quads[-1]) * 4, np.uint8)
    padded[np.arange(len(ranks)) + np.repeat(quads[:-1] * 4 - (ends - sizes), sizes)] = more
    padded = padded.reshape(-1, 4)
    control = padded[:, 0] | padded[:, 1] << 2 | padded[:, 2] << 4 | padded[:, 3] << 6
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) <= more[:, None]]
    data_ends = np.concatenate([[0], np.cumsum(more, dtype=np.int64) + np.arange(1, len(ranks) + 1)])
    return _rows(control, quads), _rows(data, data_ends[np.concatenate([[0], ends])])


def _rows(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(values.astype(np.uint8))]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers)


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers that ``pack`` was given."""
    return _unpack_rows([control], [data], np.array([n]))


def _unpack_rows(control: list[bytes], data: list[bytes], n: np.ndarray) -> np.ndarray:
    """The numbers of rows in turn, ``n`` of each."""
    quads = (n + 3) // 4
    shift = (np.cumsum(quads) - quads) * 4 - (np.cumsum(n) - n)
    sizes = _COUNTS[np.frombuffer(b"".join(control), np.uint8)].ravel()[np.arange(int(n.sum())) + np.repeat(shift, n)]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    raw = np.frombuffer(b"".join(data), np.uint8)
    out = raw[starts].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(sizes > k)
        if not len(longer):
            break
        out[longer] |= raw[starts[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> None:
    """Encode ``text``, append ``end_id`` to each document and write the dataset to ``path``.

    ``tokenizer`` is the path of a byte-level file of the ``tokenizers`` library,
    at the same place on each executor; no special tokens are added. ``path`` must
    be a folder that all executors reach. Documents are in ascending order of
    ``key``, nulls first, and those with equal keys by a hash of their text, then by their place
    in the input, so that even equal rows that are very many are dealt over many shards.

    Texts are shuffled once, by range, and encoded once. The ids go to a working
    table below ``path``; counts of all of them give the ranks (one row per id of
    the vocabulary, so the table is bounded), and a narrow second pass writes the
    final bytes. All steps write whole tables to shared storage, so a lost
    executor costs only its own tasks.

    A null or empty text is one document with the end id alone. An empty table
    gives an empty dataset. Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = rows.withColumns({"tie": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    rows = rows.repartitionByRange("doc_id", "tie", "place").sortWithinPartitions("doc_id", "tie", "place")
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seq, start, chunk, held = encoder(tokenizer), 0, 0, 0, 0
        for batch in batches:
            keys, shards, b = batch.column(0), batch.column(2), 0
            for some in slices(batch.column(1), CHUNK):
                a, b = b, b + len(some)
                found = [x + end for x in strings(words.encode_array(some))]
                sizes = np.array([len(x) // 4 for x in found], np.int64)
                starts = start + np.cumsum(sizes) - sizes
                chunk, held = (chunk + 1, 0) if held >= FILE_BYTES else (chunk, held)
                held += int(sizes.sum()) * 4
                yield pa.RecordBatch.from_arrays(
                    [
                        shards.slice(a, b - a),
                        pa.array([f"{chunk:06}"] * (b - a)),
                        pa.array(np.arange(seq, seq + b - a)),
                        keys.slice(a, b - a),
                        pa.array(starts),
                        pa.array(sizes),
                        pa.array([_narrow(x) for x in found], pa.binary()),
                    ],
                    ["shard", "chunk", "seq", "doc_id", "start", "n_tokens", "raw"],
                )
                seq, start = seq + b - a, start + int(sizes.sum())

    # The type of the keys, also if there are none.
    rows.select("doc_id").limit(0).write.parquet(f"{path}/key")
    place = _place(kind)
    encoded = rows.select("doc_id", "text", F.format_string("%08d", F.spark_partition_id()).alias("shard"))
    encoded = encoded.mapInArrow(encode, f"{place}, raw binary")
    encoded.write.option("compression", "zstd").partitionBy("shard", "chunk").parquet(f"{path}/work")

    raw = spark.read.schema(f"{place}, raw binary").parquet(f"{path}/work").select("shard", "chunk", "seq", "doc_id", "start", "n_tokens", "raw")
    _ranks(raw).write.parquet(f"{path}/ranks")
    ids = _rank_ids(spark, path)
    rank_of = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.uint32)
    rank_of[ids] = np.arange(len(ids))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = 0
            for some in slices(batch.column(6), CODED):
                a, b = b, b + len(some)
                ids = [_wide(x) for x in strings(some)]
                packed = _pack_rows(rank_of[np.concatenate(ids)], np.array([len(x) for x in ids]))
                rows = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*rows.columns[:6], *packed], [*batch.schema.names[:6], "control", "data"])

    # A task has whole chunks, as their files are not split; in order, each is written as one file.
    coded = raw.mapInArrow(code, f"{place}, control binary, data binary").sortWithinPartitions("shard", "chunk", "seq")
    coded.write.partitionBy("shard", "chunk").parquet(f"{path}/ids")


def _place(kind: str) -> str:
    return f"shard string, chunk string, seq long, doc_id {kind}, start long, n_tokens long"


def _ids(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """The table ``ids`` and the type of its keys."""
    kind = spark.read.parquet(f"{path}/key").schema["doc_id"].dataType.simpleString()
    return spark.read.schema(f"{_place(kind)}, control binary, data binary").parquet(f"{path}/ids"), kind


def _narrow(ids: bytes) -> bytes:
    """Ids of the working table: two bytes each and a mark, four where one needs them."""
    wide = np.frombuffer(ids, "<u4")
    return b"\2" + wide.astype("<u2").tobytes() if wide.max() < 1 << 16 else b"\4" + ids


def _wide(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1)


def _ranks(raw: DataFrame) -> DataFrame:
    """(rank, id) over all rows of the working table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for some in slices(batch.column(0), CODED):
                n = np.bincount(np.concatenate([_wide(x) for x in strings(some)]))
                if len(n) > len(total):
                    total = np.concatenate([total, np.zeros(len(n) - len(total), np.int64)])
                total[: len(n)] += n
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    counts = raw.select("raw").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    # One row for each id of the vocabulary at most.
    order = Window.orderBy(F.desc("n"), "id")
    return counts.select((F.row_number().over(order) - 1).alias("rank"), "id")


def _rank_ids(spark: SparkSession, path: str) -> np.ndarray:
    """Ids by rank; no more than the vocabulary has."""
    found = spark.read.parquet(f"{path}/ranks").toPandas().sort_values("rank")
    return found["id"].to_numpy(np.int64)


def _ids_of_rows(batch: pa.RecordBatch, ids: np.ndarray) -> Iterator[np.ndarray]:
    """Ids of each row of (shard, doc_id, start, n_tokens, control, data)."""
    b = 0
    for data in slices(batch.column(5), CODED):
        a, b = b, b + len(data)
        n = batch.column(3).slice(a, b - a).to_numpy()
        found = ids[_unpack_rows(strings(batch.column(4).slice(a, b - a)), strings(data), n)]
        ends = np.cumsum(n)
        yield from (found[x:y] for x, y in zip((ends - n).tolist(), ends.tolist()))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit)."""
    table, kind = _ids(spark, path)
    ids = _rank_ids(spark, path).astype("<u4")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x.tobytes() for x in _ids_of_rows(batch, ids)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(found, pa.binary())], [*batch.schema.names[:4], "ids"]
            )

    rows = table.select("shard", "doc_id", "start", "n_tokens", "control", "data")
    rows = rows.mapInArrow(decode, f"shard string, doc_id {kind}, start long, n_tokens long, ids binary")
    return _with_start(rows, table)


def _with_start(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Turn the start within a shard into the start within the dataset."""
    sizes = table.groupBy("shard").agg(F.sum("n_tokens").alias("size"))
    # One row per shard, that is per task of the writer.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    return rows.join(base, "shard").select(
        "doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", *[c for c in rows.columns if c[:3] == "ids"]
    )


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of each document, from the files."""
    table, kind = _ids(spark, path)
    ids = _rank_ids(spark, path).astype("<u4")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [zlib.crc32(x) for x in _ids_of_rows(batch, ids)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(found, pa.int64())], [*batch.schema.names[:4], "ids_crc32"]
            )

    rows = table.select("shard", "doc_id", "start", "n_tokens", "control", "data")
    rows = rows.mapInArrow(digest, f"shard string, doc_id {kind}, start long, n_tokens long, ids_crc32 long")
    return _with_start(rows, table)
