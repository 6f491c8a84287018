"""Near duplicates by SimHash: fingerprints, bit-sliced comparison, groups.

Fingerprints within a radius are found exactly. 64 bits are cut into ``blocks``
parts; two fingerprints that differ in at most ``radius`` bits agree in some
``blocks - radius`` of them, so each choice of that many parts is one key and the
fingerprints under a key are compared with each other. More blocks give longer
keys and smaller groups (5: 5 keys of 13 bits, 6: 15 of 21, 7: 35 of 27).

Comparison is bit-sliced. Up to 64 fingerprints form a word block that is stored
vertically, one machine word per bit position. For one fingerprint, each word is
XORed with its bit there, which gives 64 differences at once, and carry-save
adders count them in bit planes. After every eight positions those word blocks are
abandoned in which all counts exceed the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginlab.llm.components import components
from marginlab.session import new_shared_path

#: Shingles whose hashes are held at once.
HELD = 1 << 16
#: Pairs of a fingerprint and a word block that are compared at once.
ITEMS = 1 << 15
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes | None, width: int, seed: int = 42) -> int:
    """64-bit SimHash of a text's word shingles, repeats counted; 0 if it has no word."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= width:
        grams = [b" ".join(words)]
        starts, ends = [0], [len(grams[0])]
        line = grams[0]
    else:
        line = b" ".join(words)
        after = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], after[: len(words) - width]]).tolist()
        ends = (after[width - 1 :] - 1).tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(starts), HELD):
        some = zip(starts[k : k + HELD], ends[k : k + HELD])
        h = np.array([digest(line[a:b], seed) for a, b in some], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    high = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(high.view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp) of each row: ``width``-word shingles of the text, A-Z in lower case, words cut at ASCII white space."""
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("binary").alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(x.as_py(), width) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["key", "fp"])

    return rows.mapInArrow(hashed, f"key {rows.schema['key'].dataType.simpleString()}, fp long")


def vertical(fps: np.ndarray) -> np.ndarray:
    """Bit planes [64, blocks] of fingerprints [blocks * 64]."""
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 64, 8), axis=2, bitorder="little")
    packed = np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(packed).view("<u8")[:, :, 0]


def _add(a, b, c):
    """Carry-save adder: sum and carry planes."""
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def _exceeds(counts: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose count (bit planes, low first; ``over``: too large for them) is above the radius."""
    above, equal = over.copy(), ~over
    for k in range(len(counts) - 1, -1, -1):
        if radius >> k & 1:
            equal &= counts[k]
        else:
            above |= equal & counts[k]
            equal &= ~counts[k]
    return above


def within(planes: np.ndarray, blocks: np.ndarray, queries: np.ndarray, lanes: np.ndarray, radius: int) -> np.ndarray:
    """For item i, the lanes of block ``blocks[i]`` (out of ``lanes[i]``) within the radius of ``queries[i]``."""
    digits = max(3, int(radius).bit_length())
    out, at = np.zeros(len(blocks), np.uint64), np.arange(len(blocks))
    counts = [np.zeros(len(blocks), np.uint64) for _ in range(digits)]
    over, lanes = np.zeros(len(blocks), np.uint64), lanes.copy()
    for first in range(0, 64, 8):
        x = [planes[p][blocks] ^ (-(queries >> np.uint64(p) & np.uint64(1))).astype(np.uint64) for p in range(first, first + 8)]
        ones, twos, fours = counts[:3]
        ones, t1 = _add(ones, x[0], x[1])
        ones, t2 = _add(ones, x[2], x[3])
        twos, f1 = _add(twos, t1, t2)
        ones, t1 = _add(ones, x[4], x[5])
        ones, t2 = _add(ones, x[6], x[7])
        twos, f2 = _add(twos, t1, t2)
        fours, carry = _add(fours, f1, f2)
        counts[:3] = ones, twos, fours
        for k in range(3, digits):
            counts[k], carry = counts[k] ^ carry, counts[k] & carry
        over |= carry
        lanes &= ~_exceeds(counts, over, radius)
        left = lanes != 0
        if not left.all():
            at, blocks, queries, lanes, over = at[left], blocks[left], queries[left], lanes[left], over[left]
            counts = [c[left] for c in counts]
            if not len(at):
                break
    out[at] = lanes
    return out


def _hang(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Join the labels of the pairs; each label is the least row of its group."""
    while True:
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return label
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(label, up := label[label]):
            label = up


def link_groups(group: np.ndarray, fps: np.ndarray, part: np.ndarray, apart: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fp, fp) that connect all fingerprints of a group within the radius.

    Rows of a group stand together. Where ``apart``, rows are compared with rows
    of another ``part`` only (another task has the rest). Not every pair within
    the radius is returned, but a link to the first of those it leads to.
    """
    change = np.flatnonzero(np.diff(group)) + 1
    starts = np.concatenate([[0], change])
    sizes = np.diff(np.concatenate([starts, [len(group)]]))
    kept = np.repeat(sizes > 1, sizes)
    fps, part, apart = fps[kept], part[kept], apart[kept]
    sizes = sizes[sizes > 1]
    if not len(sizes):
        return fps[:0], fps[:0]
    starts = np.cumsum(sizes) - sizes
    n_blocks = (sizes + 63) // 64
    first_block = np.cumsum(n_blocks) - n_blocks
    place = np.arange(len(fps)) - np.repeat(starts, sizes)
    slot = (np.repeat(first_block, sizes) + place // 64) * 64 + place % 64
    laid, row = np.zeros(int(n_blocks.sum()) * 64, "<u8"), np.zeros(int(n_blocks.sum()) * 64, np.int64)
    laid[slot], row[slot] = fps, np.arange(len(fps))

    def mask(of: np.ndarray) -> np.ndarray:
        bits = np.zeros(len(laid), np.uint8)
        bits[slot] = of
        return np.packbits(bits.reshape(-1, 64), axis=1, bitorder="little").view("<u8")[:, 0]

    held, low = mask(np.ones(len(fps), np.uint8)), mask(part == np.repeat(part[starts], sizes))
    planes = np.concatenate([vertical(laid[k : k + (1 << 16)]) for k in range(0, len(laid), 1 << 16)], axis=1)
    is_low = part == np.repeat(part[starts], sizes)
    later = np.repeat(n_blocks, sizes) - place // 64
    label, done = np.arange(len(fps)), 0
    reach = np.cumsum(later)
    while done < len(fps):
        upto = max(done + 1, int(np.searchsorted(reach, (reach[done - 1] if done else 0) + ITEMS, "right")))
        count = later[done:upto]
        q = np.repeat(np.arange(done, upto), count)
        step = np.arange(len(q)) - np.repeat(np.cumsum(count) - count, count)
        block = slot[q] // 64 + step
        lane = held[block]
        lane &= np.where(apart[q], np.where(is_low[q], ~low[block], low[block]), ALL)
        # In its own block, a row is compared with those after it.
        own = ALL << (slot[q] % 64).astype(np.uint64) << np.uint64(1)
        own[slot[q] % 64 == 63] = 0
        lane &= np.where(step == 0, own, ALL)
        hit = within(planes, block, fps[q], lane, radius)
        some = np.flatnonzero(hit)
        bits = np.unpackbits(hit[some].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        which, lane_at = np.nonzero(bits)
        label = _hang(label, q[some[which]], row[block[some[which]] * 64 + lane_at])
        done = upto
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return fps[moved], fps[label[moved]]


def masks(radius: int, blocks: int) -> list[int]:
    """Bit masks, as signed 64-bit numbers: two fingerprints within the radius agree under one of them."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    parts = [(1 << edges[k + 1]) - (1 << edges[k]) for k in range(blocks)]
    found = [sum(c) for c in combinations(parts, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in found]


def fingerprint_links(fps: DataFrame, radius: int, blocks: int, cell: int = 1024) -> DataFrame:
    """(a, b) links that connect all distinct fingerprints of column ``fp`` within the radius.

    A key that more than ``cell`` fingerprints share is split by a hash into parts
    of about that size, and every pair of its parts is a task of its own, so no
    task grows with the largest group of near copies.
    """
    keyed = fps.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks(radius, blocks)])).alias("choice", "bits"),
    )
    parts = F.ceil(F.col("n") / cell).cast("int")
    heavy = keyed.groupBy("choice", "bits").agg(F.count("*").alias("n")).where(F.col("n") > cell)
    keyed = keyed.join(heavy.select("choice", "bits", parts.alias("parts")), ["choice", "bits"], "left")
    part = F.expr("cast(pmod(xxhash64(fp), coalesce(parts, 1)) as int)")
    keyed = keyed.select("choice", "bits", "fp", part.alias("part"), F.coalesce("parts", F.lit(1)).alias("parts"))
    keyed = keyed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = keyed.select(
        "choice", "bits", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "fp"
    )
    # Cells of one part alone are those whose low and high part are the same.
    where = ["choice", "bits", "low", "high"]
    dealt = cells.repartition(*[F.col(c) for c in where]).sortWithinPartitions(*where, "part")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            now = [batch.column(k).to_numpy() for k in range(6)]
            held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            change = np.flatnonzero(_changes(held))
            if len(change) > 1 and change[-1] > 0:
                yield _linked([x[: change[-1]] for x in held], radius)
                held = [x[change[-1] :] for x in held]
        if held is not None and len(held[0]):
            yield _linked(held, radius)

    return dealt.mapInArrow(compare, "a long, b long")


def _changes(rows: list[np.ndarray]) -> np.ndarray:
    """Whether a row begins a cell."""
    out = np.ones(len(rows[0]), bool)
    out[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in rows[:4]])
    return out


def _linked(rows: list[np.ndarray], radius: int) -> pa.RecordBatch:
    cell = np.cumsum(_changes(rows))
    fps = np.ascontiguousarray(rows[5]).astype("<i8").view("<u8")
    a, b = link_groups(cell, fps, rows[4], rows[2] != rows[3], radius)
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])


def simhash_groups(
    docs: DataFrame, width: int = 5, radius: int = 4, blocks: int = 6, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of each row.

    Rows link if their fingerprints differ in at most ``radius`` bits;
    ``component_id`` is the smallest key that a row reaches over links.

    The text is read once; from there on fingerprints of 8 bytes move. Equal
    fingerprints, such as those of exact copies, are one node however many rows
    have them, and the final join on the fingerprint is one Spark can split.

    Null and empty texts have fingerprint zero and link like any other. Repeated
    rows keep a row each. Null keys never are the smallest; a component without
    another key has a null id. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    path = new_shared_path(spark, "simhash")
    fingerprints(docs, width, key, text).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    rows.groupBy("fp").agg(F.min("key").alias("first")).write.parquet(f"{path}/nodes")
    nodes = spark.read.parquet(f"{path}/nodes")
    roots = components(fingerprint_links(nodes, radius, blocks))
    placed = nodes.join(roots, nodes.fp == roots.node, "left")
    placed = placed.select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = placed.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(docs: DataFrame, width: int = 5, radius: int = 4, blocks: int = 6, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group: of its rows with the smallest key, the one with the least hash of its text, then of all columns.

    Rows without a key are compared with each other alone: of those in a group one
    stays, also beside a row with a key.

    Rows are stored with a number each and told apart by it. What is compared, counted
    and joined is slim rows; no row is looked up by its key, however many rows share
    one, and texts move only if the dropped numbers are too many to be broadcast. All
    columns are kept, whatever their names.
    """
    spark = docs.sparkSession
    path = new_shared_path(spark, "near-copies")
    # Maps have no hash; rows that differ in nothing else are taken for equal.
    hashed = [F.col(f"`{c}`") for c in docs.columns if "map<" not in docs.schema[c].dataType.simpleString()]
    numbered = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{key}`").alias("key"),
        F.xxhash64(F.col(f"`{text}`")).alias("tie"), F.xxhash64(*hashed).alias("rest"), F.monotonically_increasing_id().alias("row"),
    )
    numbered.write.parquet(f"{path}/docs")
    stored = spark.read.parquet(f"{path}/docs")
    placed = stored.select(F.struct("key", "tie", "rest", "row").alias("__place"), F.col("doc").getField(text).alias("__text"))
    fingerprints(placed, width, "__place", "__text").select("fp", F.col("key").alias("place")).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    keyless = F.col("place.key").isNull()
    least = [F.min(F.when(~keyless, F.col("place"))).alias("keyed"), F.min(F.when(keyless, F.col("place"))).alias("keyless")]
    rows.groupBy("fp").agg(*least).write.parquet(f"{path}/nodes")
    nodes = spark.read.parquet(f"{path}/nodes")
    roots = components(fingerprint_links(nodes, radius, blocks))
    groups = nodes.join(roots, nodes.fp == roots.node, "left").groupBy(F.coalesce("root", "fp").alias("root"))
    chosen = groups.agg(F.min("keyed").alias("keyed"), F.min("keyless").alias("keyless"))
    chosen = chosen.select(F.explode(F.array("keyed.row", "keyless.row")).alias("row")).where("row is not null")
    rows.select("place.row").join(chosen, "row", "left_anti").write.parquet(f"{path}/gone")
    gone = spark.read.parquet(f"{path}/gone")
    return stored.select("doc", "row").join(gone, "row", "left_anti").select("doc.*")
