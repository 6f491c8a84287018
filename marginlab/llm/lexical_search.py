"""Ranked lexical search by dense blocked matrix products.

The items of a block have a vocabulary. A tile of documents is a dense matrix of
impacts (terms times documents), and the weights of the items are another (items times
terms); their product has the scores of all items for all documents of the tile. Only
terms that the tile holds take a row. Weights and impacts are whole numbers, and the
terms of one product are so few that its sums stay below 2^53: float64 is exact then,
in any order of addition. Products of further terms are added as 64-bit integers.

The best of each tile are found by the score at place k of each item, with those
equal to it taken in the order of their keys; a task keeps the best of its tiles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginlab.session import new_shared_path

#: Items of a block, and (item, term) pairs of its items unless it is a single item.
BLOCK_ITEMS, BLOCK_PAIRS = 512, 262_144
#: Documents, and distinct terms of all of them together, in a tile; terms in a product.
TILE_DOCS, TILE_TERMS, PRODUCT_TERMS = 1024, 1 << 20, 4096
#: Bytes of a text that are cut into terms at once.
CUT_BYTES = 4 << 20
#: Impacts are below this.
IMPACT = 1_000_000

_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_CHARACTERS = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, A-Z in lower case, in lists of bounded size."""
    if len(text) <= CUT_BYTES:
        yield text.translate(_CHARACTERS).lower().split()
        return
    text = text.translate(_CHARACTERS)
    at = 0
    while at < len(text):
        end = text.rfind(b" ", at, at + CUT_BYTES)
        if end < 0:
            end = text.find(b" ", at + CUT_BYTES)
        end = len(text) if end < 0 or at + CUT_BYTES >= len(text) else end + 1
        yield text[at:end].lower().split()
        at = end


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k, text in enumerate(batch.column(1).to_pylist()):
            found = set()
            for some in terms(text or b""):
                found.update(some)
            at = pa.array(np.full(len(found), k))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array(sorted(found), pa.binary())], ["item", "term"])


def _blocks(pairs: DataFrame, items: int, most: int) -> Iterator[tuple[list, list[tuple[int, bytes]]]]:
    """(item ids, (place of the item, term) pairs) of the blocks.

    A block over its bounds is halved by a further bit of the hash of the item, so
    the bounds hold but for an item that is over them alone.
    """
    n, todo = 1, {0}
    while todo:
        block = F.pmod(F.xxhash64("item"), F.lit(n))
        counted = pairs.groupBy(block.alias("block"), "item").agg(F.count("*").alias("pairs"))
        sizes = counted.groupBy("block").agg(F.count("*").alias("items"), F.sum("pairs").alias("pairs")).toLocalIterator()
        over = set()
        for k, n_items, n_pairs in sizes:
            if k not in todo:
                continue
            if n_items > 1 and (n_items > items or n_pairs > most):
                over |= {k, k + n}
                continue
            ids, found, place = [], [], {}
            for item, term in pairs.where(block == k).toLocalIterator():
                if item not in place:
                    place[item] = len(ids)
                    ids.append(item)
                found.append((place[item], bytes(term)))
            yield ids, found
        n, todo = 2 * n, over


class _Tile:
    """Numbers of a block's terms in some documents."""

    def __init__(self, vocabulary: dict[bytes, int]):
        self.number = vocabulary.get
        self.size = len(vocabulary)
        self.clear()

    def clear(self) -> None:
        self.lengths, self.found = [], []
        self.pairs = 0

    def add(self, text: bytes) -> None:
        n, codes = 0, []
        for some in terms(text):
            n += len(some)
            ids = np.array([i for i in map(self.number, some) if i is not None], np.int64)
            codes.append(np.unique(ids, return_counts=True))
        if len(codes) > 1:
            ids = np.concatenate([c[0] for c in codes])
            one, back = np.unique(ids, return_inverse=True)
            codes = [(one, np.bincount(back, np.concatenate([c[1] for c in codes]), len(one)).astype(np.int64))]
        self.found.append(codes[0])
        self.lengths.append(n)
        self.pairs += len(codes[0][0])

    def sparse(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(terms of each document, document, term, occurrences)."""
        each = [len(f[0]) for f in self.found]
        doc = np.repeat(np.arange(len(each)), each)
        return np.array(self.lengths, np.int64), doc, *(np.concatenate([f[k] for f in self.found]) for k in (0, 1))


def _statistics(docs: DataFrame, vocabulary: dict[bytes, int]) -> tuple[int, int, np.ndarray]:
    """(documents with a term, terms of all documents, documents that hold each term of the vocabulary)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, total = np.zeros(len(vocabulary) + 2, np.int64), 0, 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                tile = _Tile(vocabulary)
                tile.add(text or b"")
                held[tile.found[0][0]] += 1
                n += tile.lengths[0] > 0
                total += tile.lengths[0]
        held[-2:] = n, total
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], ["place", "n"])

    counted = docs.select("text").mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    held = np.zeros(len(vocabulary) + 2, np.int64)
    for place, n in counted.toLocalIterator():
        held[place] = n
    return int(held[-2]), int(held[-1]), held[:-2]


def weight(documents: int, holding: int) -> int:
    """Weight of a term that ``holding`` of ``documents`` hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def norms(lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What a document's number of terms adds to the occurrences of each."""
    if len(lengths) and 90 * documents * int(lengths.max()) >= 1 << 63:
        return np.array([10 + 90 * int(n) * documents // total for n in lengths], np.int64)
    return 10 + 90 * documents * lengths // max(total, 1)


def _scores(tile: _Tile, weights: tuple, documents: int, total: int, n_items: int, heaviest: int) -> np.ndarray:
    """Scores of all items (rows) for the documents of a tile (columns)."""
    lengths, doc, term, times = tile.sparse()
    impact = IMPACT * 1000 * times // (1000 * times + 8 * norms(lengths, documents, total)[doc])
    present, row = np.unique(term, return_inverse=True)
    at = np.full(tile.size, -1)
    at[present] = np.arange(len(present))
    item, item_term, w = weights
    column = at[item_term]
    most = max(min(PRODUCT_TERMS, (1 << 53) // (max(heaviest, 1) * IMPACT)), 1)
    out = np.zeros((n_items, len(lengths)), np.int64)
    for start in range(0, len(present), most):
        n = min(most, len(present) - start)
        here = (row >= start) & (row < start + n)
        impacts = np.zeros((n, len(lengths)))
        impacts[row[here] - start, doc[here]] = impact[here]
        here = (column >= start) & (column < start + n)
        wanted = np.zeros((n_items, n))
        wanted[item[here], column[here] - start] = w[here]
        out += (wanted @ impacts).astype(np.int64)
    return out


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k highest scores above 0 of each row; of equal ones, the first columns."""
    if scores.shape[1] <= k:
        return np.nonzero(scores > 0)
    least = np.partition(scores, -k, axis=1)[:, -k, None]
    above, equal = scores > least, scores == least
    room = k - above.sum(axis=1, keepdims=True)
    chosen = (above | (equal & (np.cumsum(equal, axis=1) <= room))) & (scores > 0)
    return np.nonzero(chosen)


def _first(rows: pa.Table, k: int) -> pa.Table:
    """The first ``k`` rows of each item, by falling score, then by key."""
    rows = rows.take(
        pc.sort_indices(rows, [("place", "ascending"), ("score", "descending"), ("key", "ascending")], null_placement="at_start")
    )
    place = rows["place"].to_numpy()
    start = np.searchsorted(place, place)
    return rows.filter(pa.array(np.arange(len(place)) - start < k))


def _search_block(docs: DataFrame, ids: list, pairs: list[tuple[int, bytes]], item_type: pa.DataType, kinds: tuple[str, str], k: int) -> DataFrame:
    """(item, key, score): the best of each task for the items of a block."""
    vocabulary: dict[bytes, int] = {}
    for _, term in pairs:
        vocabulary.setdefault(term, len(vocabulary))
    documents, total, held = _statistics(docs, vocabulary)
    by_term = np.array([weight(documents, int(n)) if n else 0 for n in held], np.int64)
    item_term = np.array([vocabulary[t] for _, t in pairs], np.int64)
    weights = (np.array([i for i, _ in pairs], np.int64), item_term, by_term[item_term])
    heaviest = int(by_term.max(initial=0))
    names = pa.array(ids, item_type)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, keys, best = _Tile(vocabulary), [], None

        def finished() -> pa.Table:
            found = pa.concat_arrays(keys)
            order = pc.array_sort_indices(found, null_placement="at_start").to_numpy()
            scores = _scores(tile, weights, documents, total, len(ids), heaviest)[:, order]
            item, at = _best(scores, k)
            out = pa.table({"place": item, "key": found.take(pa.array(order[at])), "score": scores[item, at]})
            tile.clear()
            keys.clear()
            return out if best is None else _first(pa.concat_tables([best, out]), k)

        for batch in batches:
            start = 0
            for row, text in enumerate(batch.column(1).to_pylist(), 1):
                tile.add(text or b"")
                if len(tile.lengths) >= TILE_DOCS or tile.pairs >= TILE_TERMS:
                    keys.append(batch.column(0).slice(start, row - start))
                    start, best = row, finished()
            keys.append(batch.column(0).slice(start))
        if tile.lengths:
            best = finished()
        if best is not None:
            for part in best.combine_chunks().to_batches():
                yield pa.RecordBatch.from_arrays([names.take(part.column(0)), *part.columns[1:]], ["item", "key", "score"])

    return docs.select("key", "text").mapInArrow(search, f"item {kinds[0]}, key {kinds[1]}, score long")


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``item_key``, ``rank``, ``key`` and ``score``: the ``k`` documents with the highest scores above 0 for each item.

    Terms are runs of ASCII letters and digits and of other characters beyond
    ASCII, A-Z in lower case. With N documents that have a term, L terms in all of them, and df
    documents holding a term, its weight is floor(1000 ln((2N + 2) / (2 df + 1))). A
    document of n terms adds weight * (10^9 tf div (1000 tf + 8 (10 + 90 n N div L))) for each
    term of the item that it holds tf times. Equal scores rank by the key.

    All documents are scored for all items. Items go in blocks of a bounded number of
    terms, each read from the shared folder to the driver and sent with the tasks; a
    block takes two passes over the documents, for its statistics and its
    scores. A task returns at most ``k`` rows for an item.

    A null or empty text has no terms: such a document is found by nothing, such an
    item finds nothing. Rows of items that share an id, a null one too, are one item
    with the terms of all of them. Repeated documents rank each; a null key ranks before
    others of its score. Empty tables give an empty result. Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    path = new_shared_path(spark, "search")
    docs = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("binary").alias("text"))
    wanted = items.select(F.col(f"`{item_key}`").alias("item"), F.col(f"`{item_text}`").cast("binary").alias("text"))
    kinds = wanted.schema["item"].dataType.simpleString(), docs.schema["key"].dataType.simpleString()
    wanted.mapInArrow(_item_terms, f"item {kinds[0]}, term binary").distinct().write.parquet(f"{path}/items")
    pairs = spark.read.parquet(f"{path}/items")
    item_type = pairs.select("item").limit(0).toArrow().schema.field(0).type
    found = spark.createDataFrame([], f"item {kinds[0]}, key {kinds[1]}, score long")
    for ids, block in _blocks(pairs, BLOCK_ITEMS, BLOCK_PAIRS):
        found = found.unionByName(_search_block(docs, ids, block, item_type, kinds, k))
    order = [F.desc("score"), F.asc_nulls_first("key")]
    # The best of some tasks, then of all.
    some = Window.partitionBy("item", "some").orderBy(*order)
    found = found.withColumn("some", F.spark_partition_id() % 64).withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    return found.select(F.col("item").alias(item_key), "rank", F.col("key").alias(key), "score")
