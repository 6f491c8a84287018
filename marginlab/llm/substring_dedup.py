"""Removing repeated passages: winnowed anchors as seeds, extended to maximal repeats.

A window is ``length`` consecutive words. Its anchor is the least hash of the
``gram``-word sequences in it, so windows with equal words have equal anchors, and
neighbouring windows mostly share theirs: about one word in seven starts an
anchor. Only anchors that occur twice can seed a repeat.

Extension. The windows of a document that share an anchor are a block: the anchor
with all words to both sides that a window over it can reach. Equal blocks match
over their whole extent, so all but the first occurrence are repeats, however many
there are, and no pair of occurrences is ever made. An anchor with several
different blocks is the edge of a repeat (or a common phrase); there, the first
occurrence of each block is extended window by window, and each window that
occurs earlier is a repeat. Covering windows join up to the maximal repeats.

Words have 64-bit hashes that mix their bytes without sums, and the word hashes of a
block or window that decides what is removed are hashed by XXH64: two different
ones are taken for equal with a chance of 2^-64 a pair. Grams, and the test whether a block repeats itself, use sums that any
range can be cut from; these only choose candidates, so that a collision costs
time and no word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginlab.session import new_shared_path

#: Bytes of text that are hashed together.
CHUNK = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
#: Keeps the first bytes of eight, by their number.
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_UP, _DOWN = _powers(_BASE, CHUNK), _powers(_INVERSE, CHUNK)


def _up_down(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n <= len(_UP):
        return _UP[:n], _DOWN[:n]
    return _powers(_BASE, n), _powers(_INVERSE, n)


def _mix(h: np.ndarray) -> np.ndarray:
    """One number for each, told apart wherever the given are."""
    h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(32)


def _word_hashes(raw: bytes, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words of a text that lie between the given places.

    Words of up to 16 bytes are one or two whole numbers and a length, mixed so that
    those of up to 8 bytes cannot collide; longer words, which are few, are hashed by XXH64.
    """
    size = end - first
    eight = np.ndarray(len(raw) + 9, "<u8", raw + bytes(16), strides=(1,))
    low = eight[first] & _FIRST_BYTES[np.minimum(size, 8)]
    high = eight[np.minimum(first + 8, len(raw))] & _FIRST_BYTES[np.clip(size - 8, 0, 8)]
    h = _mix(_mix(low ^ size.astype(np.uint64) * _BASE) + high * np.uint64(0xC2B2AE3D27D4EB4F))
    for k in np.flatnonzero(size > 16).tolist():
        h[k] = xxhash.xxh64_intdigest(raw[first[k] : end[k]], 20)
    return h


def _prefix(values: np.ndarray) -> np.ndarray:
    """Sums from which ``_span`` makes the hash of any range."""
    up, _ = _up_down(len(values))
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up, out=out[1:])
    return out


def _span(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the values from start to end, wherever they stand."""
    _, down = _up_down(len(prefix))
    return _mix((prefix[end] - prefix[start]) * down[start])


def _least(x: np.ndarray, n: int, pick=np.minimum) -> np.ndarray:
    """Least of each n neighbours."""
    span = 1
    while span * 2 <= n:
        x = pick(x[:-span], x[span:])
        span *= 2
    return pick(x[: len(x) - (n - span)], x[n - span :]) if span < n else x


class Windows:
    """The windows of some texts, hashed together.

    ``at`` is where each window starts among all words, ``doc`` its text, ``start``
    its place in the text, ``anchor`` its least gram.
    """

    def __init__(self, texts: list[bytes], length: int, gram: int):
        self.length, self.gram = length, gram
        joined = b"\n".join(texts)
        edge = np.diff(np.concatenate([[False], _IS_WORD[np.frombuffer(joined, np.uint8)], [False]]).astype(np.int8))
        first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        hashes = _word_hashes(joined, first, end)
        self._raw, self._words = hashes.tobytes(), _prefix(hashes)
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        owner = np.searchsorted(text_ends, first, "right")
        self.words_before = np.searchsorted(first, np.concatenate([[0], text_ends]))
        n = len(first)
        empty = np.zeros(0, np.int64)
        if n < length:
            self.at, self.doc, self.start, self.anchor = empty, empty, empty, empty.astype(np.uint64)
            self._grams = self.anchor
            return
        inside = owner[: n - length + 1] == owner[length - 1 :]
        self._grams = _span(self._words, np.arange(n - gram + 1), np.arange(gram, n + 1))
        least = _least(self._grams, length - gram + 1)
        self._inside, self._all = inside, least
        self.at = np.flatnonzero(inside)
        self.doc = owner[self.at]
        self.start = self.at - self.words_before[self.doc]
        self.anchor = least[self.at]

    def seeds(self) -> np.ndarray:
        """The anchor of every place that is the least gram of some window."""
        if not len(self.at):
            return self.anchor
        per = self.length - self.gram + 1
        least = np.where(self._inside, self._all, np.uint64(0))
        padded = np.concatenate([np.zeros(per - 1, np.uint64), least, np.zeros(per - 1, np.uint64)])
        reach = _least(padded, per, np.maximum)
        return self._grams[reach == self._grams]

    def runs(self, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, end): runs of used windows in a row that share text and anchor."""
        k = np.flatnonzero(used)
        if not len(k):
            return k, k
        new = np.ones(len(k), bool)
        new[1:] = (np.diff(self.at[k]) != 1) | (np.diff(self.doc[k]) != 0) | (self.anchor[k[1:]] != self.anchor[k[:-1]])
        at = np.flatnonzero(new)
        return k[at], np.concatenate([k[at[1:] - 1], k[-1:]]) + 1

    def sums(self, k: np.ndarray) -> np.ndarray:
        """Equal for windows of equal words; others are told apart by ``hashes`` alone."""
        return _span(self._words, self.at[k], self.at[k] + self.length)

    def hashes(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the words of each run of windows."""
        starts, ends = (self.at[first] * 8).tolist(), ((self.at[end - 1] + self.length) * 8).tolist()
        digest, raw = xxhash.xxh64_intdigest, self._raw
        return np.fromiter((digest(raw[a:b], 21) for a, b in zip(starts, ends)), np.uint64, len(starts))


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _chunks(texts: list[bytes | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(place of the first, texts) of about CHUNK bytes each."""
    start, held, some = 0, 0, []
    for k, t in enumerate(texts):
        some.append(t or b"")
        held += len(some[-1])
        if held >= CHUNK:
            yield start, some
            start, held, some = k + 1, 0, []
    if some:
        yield start, some


def _each_chunk(work: Callable, names: list[str]):
    """A mapInArrow function: ``work(windows, batch, first row)`` gives the columns of each chunk of texts (column 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _chunks(batch.column(0).to_pylist()):
                columns = work(texts, batch, start)
                if columns is not None:
                    yield pa.RecordBatch.from_arrays(columns, names)

    return run


def repeated_windows(docs: DataFrame, length: int, gram: int, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(texts, removed): ``text``, ``key``, ``row``; and ``row``, ``ranges`` (starts and numbers of windows that occur earlier).

    ``row`` is a hash of key and text. The texts are shuffled once, by ``row``;
    every step from there on reads that shuffle again.
    """
    spark = docs.sparkSession
    path = new_shared_path(spark, "substrings")
    c, k = F.col(f"`{text}`"), F.col(f"`{key}`")
    texts = docs.select(c.cast("binary").alias("text"), k.alias("key"), F.xxhash64(k, c).alias("row"))
    kind = texts.schema["key"].dataType.simpleString()

    def seeds(some, batch, start):
        return [_signed(Windows(some, length, gram).seeds())]

    def anchors(some, batch, start):
        w = Windows(some, length, gram)
        first, _ = w.runs(np.ones(len(w.at), bool))
        return [_signed(w.anchor[first]), batch.column(1).take(pa.array(start + w.doc[first]))]

    # Seeds that occur twice, then the documents that hold them.
    twice = texts.select("text").mapInArrow(_each_chunk(seeds, ["anchor"]), "anchor long")
    twice = twice.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    held = texts.select("text", "row").mapInArrow(_each_chunk(anchors, ["anchor", "row"]), "anchor long, row long")
    lists = held.join(twice, "anchor", "left_semi").groupBy("row").agg(F.collect_set("anchor").alias("anchors"))
    lists.write.parquet(f"{path}/seeds")
    lists = spark.read.parquet(f"{path}/seeds")

    def blocks(some, batch, start):
        w = Windows(some, length, gram)
        known = batch.column(3).slice(start, len(some)).flatten().to_numpy().view(np.uint64)
        first, end = w.runs(np.isin(w.anchor, known))
        # A block that holds a window twice is extended window by window.
        inner = np.repeat(np.arange(len(first)), end - first)
        flat = np.arange(len(inner)) + np.repeat(first - (np.cumsum(end - first) - (end - first)), end - first)
        own = w.sums(flat) ^ inner.astype(np.uint64) * _BASE
        order = np.argsort(own)
        twin = inner[order[1:][own[order[1:]] == own[order[:-1]]]]
        periodic = np.zeros(len(first), bool)
        periodic[twin] = True
        at = pa.array(start + w.doc[first])
        return [
            _signed(w.hashes(first, end)), _signed(w.anchor[first]), batch.column(1).take(at), batch.column(2).take(at),
            pa.array(w.start[first].astype(np.int32)), pa.array((end - first).astype(np.int32)), pa.array(periodic),
        ]

    seeded = texts.join(lists, "row").select("text", "key", "row", "anchors")
    names = ["block", "anchor", "key", "row", "start", "n", "periodic"]
    found = seeded.mapInArrow(
        _each_chunk(blocks, names), f"block long, anchor long, key {kind}, row long, start int, n int, periodic boolean"
    )
    place = F.struct("key", "row", "start")
    one = found.groupBy("block").agg(
        F.min(place).alias("first"), F.count("*").alias("copies"), F.any_value("anchor").alias("anchor"),
        F.any_value("n").alias("n"), F.any_value("periodic").alias("periodic"),
    )
    later = found.select("block", "key", "row", "start", "n").join(
        one.where("copies > 1").select("block", "first"), "block"
    )
    later = later.where(~place.eqNullSafe(F.col("first"))).select("row", "start", "n")

    # First occurrences of blocks whose anchor has other blocks too.
    shared = one.groupBy("anchor").agg((F.count("*") > 1).alias("several"))
    edges = one.select("anchor", "first", "n", "periodic").join(shared, "anchor").where("several or periodic")
    spans = F.collect_set((F.shiftleft(F.col("first.start").cast("long"), 32)).bitwiseOR(F.col("n").cast("long")))
    edges = edges.select(F.col("first.row").alias("row"), "first", "n").groupBy("row").agg(spans.alias("spans"))

    def windows(some, batch, start):
        w = Windows(some, length, gram)
        out = []
        for d, spans in enumerate(batch.column(3).slice(start, len(some)).to_pylist()):
            spans = np.array(spans, np.int64)
            s, n = spans >> 32, spans & 0xFFFFFFFF
            base = np.searchsorted(w.doc, d)
            out.append(np.repeat(base + s - (np.cumsum(n) - n), n) + np.arange(int(n.sum())))
        k = np.concatenate(out) if out else np.zeros(0, np.int64)
        at = pa.array(start + w.doc[k])
        return [_signed(w.hashes(k, k + 1)), batch.column(1).take(at), batch.column(2).take(at), pa.array(w.start[k].astype(np.int32))]

    edged = texts.join(edges, "row").select("text", "key", "row", "spans")
    single = edged.mapInArrow(
        _each_chunk(windows, ["window", "key", "row", "start"]), f"window long, key {kind}, row long, start int"
    )
    least = single.groupBy("window").agg(F.min(place).alias("first"), F.count("*").alias("copies")).where("copies > 1")
    again = single.join(least.select("window", "first"), "window").where(~place.eqNullSafe(F.col("first")))
    again = again.select("row", "start", F.lit(1).alias("n"))

    ranges = F.shiftleft(F.col("start").cast("long"), 32).bitwiseOR(F.col("n").cast("long"))
    removed = later.unionByName(again).groupBy("row").agg(F.collect_set(ranges).alias("ranges"))
    return texts, removed


def _kept_words(text: bytes | None, ranges: list[int] | None, length: int) -> tuple[int, list[bytes]]:
    """(number of words, words that are not covered)."""
    words = (text or b"").split()
    if not ranges:
        return len(words), words
    spans = np.array(ranges, np.int64)
    start, n = spans >> 32, spans & 0xFFFFFFFF
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + n + length - 1, -1)
    covered = np.cumsum(change)[:-1] > 0
    return len(words), [words[i] for i in np.flatnonzero(~covered)]


def remove_repeats(
    docs: DataFrame, length: int = 20, gram: int = 8, key: str = "doc_id", text: str = "text", with_text: bool = True
) -> DataFrame:
    """``key``, ``n_words``, ``n_removed``, ``kept_sha256`` and, ``with_text``, ``kept_text`` of each row.

    A word is removed if it lies in a window whose words also start earlier: in a
    row of a smaller key, or earlier in the same row. Windows are those of the
    input, not of what is left. ``kept_text`` has the other words joined by one space.

    A null text has no words; shorter texts than a window lose none. Null keys
    come before others; of rows that share a key, those with the smaller hash of
    key and text. Rows equal in key and text count as one document and get the
    same result each. An empty table gives an empty result.
    """
    texts, removed = repeated_windows(docs, length, gram, key, text)
    joined = texts.join(removed, "row", "left").select("key", "text", "ranges")
    kind = texts.schema["key"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, gone, digests, kept = [], [], [], []
            for t, r in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                n, left = _kept_words(t, r, length)
                line = b" ".join(left)
                sizes.append(n)
                gone.append(n - len(left))
                digests.append(hashlib.sha256(line).hexdigest())
                kept.append(line if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests), pa.array(kept, pa.binary())],
                ["key", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    out = joined.mapInArrow(digest, f"key {kind}, n_words long, n_removed long, kept_sha256 string, kept binary")
    out = out.withColumnsRenamed({"key": key, "kept": "kept_text"})
    return out.withColumn("kept_text", F.col("kept_text").cast("string")) if with_text else out.drop("kept_text")
