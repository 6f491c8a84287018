"""Quality of documents by histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginlab.llm.labelled import held_out, once, training_sample

STATISTICS = (
    "log_words", "word_bytes", "distinct_words", "repeats_in_a_row", "log_lines", "line_words", "repeated_lines",
    "capitals", "digits", "stops", "commas", "symbols", "shouts", "bars", "other_bytes", "doubled_marks", "short_words",
)

_CLASSES = np.zeros((256, 8))
for _k, _bytes in enumerate((range(65, 91), range(48, 58), b".", b",", b"#*$%&<>", b"!?", b"|", range(128, 256))):
    _CLASSES[list(_bytes), _k] = 1


def statistics(text: bytes | None) -> list[float]:
    """Values of STATISTICS for the whole text; all zero for a null or an empty one."""
    words = (text or b"").split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(text)
    lines = [x for x in text.split(b"\n") if x.strip()]
    shares = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _CLASSES / size
    doubled = sum(map(text.count, (b"!!", b"%%", b"&&", b"$$", b"##", b"**")))
    lengths = list(map(len, words))
    return [
        float(np.log1p(n)), sum(lengths) / n, len(set(words)) / n, sum(map(eq, words, words[1:])) / n,
        float(np.log1p(len(lines))), n / len(lines), 1 - len(set(lines)) / len(lines), *shares.tolist(), doubled / n,
        sum(x < 4 for x in lengths) / n,
    ]


@dataclass(frozen=True)
class BoostParameters:
    """``most``: bound of the training sample, in rows. ``leaf``: least sum of second derivatives in a leaf."""

    most: int = 16_000
    trees: int = 60
    depth: int = 4
    bins: int = 64
    rate: float = 0.15
    ridge: float = 1.0
    leaf: float = 2.0


@dataclass(frozen=True)
class Trees:
    """Complete binary trees, flattened: [tree, node]; the children of node i are 2i + 1 and 2i + 2.

    A node that is not split has an infinite limit, so every row goes left.
    """

    base: float
    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 of each row."""
        n_trees, n_nodes = self.feature.shape
        depth = (n_nodes + 1).bit_length() - 1
        at = np.zeros((len(x), n_trees), np.int64)
        tree, row = np.arange(n_trees), np.arange(len(x))[:, None]
        for _ in range(depth):
            at = 2 * at + 1 + (x[row, self.feature[tree, at]] > self.limit[tree, at])
        leaf = at - n_nodes
        return 1 / (1 + np.exp(-(self.base + self.value[tree, leaf].sum(axis=1))))


def boost(x: np.ndarray, y: np.ndarray, p: BoostParameters) -> Trees:
    """Trees for logistic loss, split by histograms of first and second derivatives."""
    nodes = 2**p.depth - 1
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    feature = np.zeros((p.trees, nodes), np.int64)
    limit, value = np.full((p.trees, nodes), np.inf), np.zeros((p.trees, nodes + 1))
    if len(np.unique(y)) < 2:
        return Trees(base, feature, limit, value)
    edges = [np.unique(np.quantile(c, np.arange(1, p.bins) / p.bins)) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], axis=1)
    raw = np.full(len(y), base)
    for t in range(p.trees):
        prob = 1 / (1 + np.exp(-raw))
        first, second = prob - y, prob * (1 - prob)
        at = np.zeros(len(y), np.int64)
        for level in range(p.depth):
            start, width = 2**level - 1, 2**level
            best = np.zeros(width)
            cut = np.zeros(width, np.int64)
            pick = np.full(width, -1)
            for f in range(x.shape[1]):
                cell = (at - start) * p.bins + binned[:, f]
                g = np.bincount(cell, first, width * p.bins).reshape(width, -1)
                h = np.bincount(cell, second, width * p.bins).reshape(width, -1)
                gl, hl = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1]
                gt, ht = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                gain = gl**2 / (hl + p.ridge) + (gt - gl) ** 2 / (ht - hl + p.ridge) - gt**2 / (ht + p.ridge)
                gain[(hl < p.leaf) | (ht - hl < p.leaf)] = 0
                k = gain.argmax(1)
                most = gain[np.arange(width), k]
                better = most > best + 1e-9
                best[better], cut[better], pick[better] = most[better], k[better], f
            split = np.flatnonzero((pick >= 0) & (cut < np.array([len(edges[f]) if f >= 0 else 0 for f in pick])))
            feature[t, start + split] = pick[split]
            limit[t, start + split] = [edges[pick[s]][cut[s]] for s in split]
            right = x[np.arange(len(y)), feature[t, at]] > limit[t, at]
            at = 2 * at + 1 + right
        leaf = at - nodes
        g, h = np.bincount(leaf, first, nodes + 1), np.bincount(leaf, second, nodes + 1)
        value[t] = -p.rate * g / (h + p.ridge)
        raw += value[t, leaf]
    return Trees(base, feature, limit, value)


def _statistics_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text, label, tie) to (key, label, tie, statistics)."""
    for batch in batches:
        found = [statistics(x.as_py()) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), batch.column(3), pa.array(found, pa.list_(pa.float64()))], ["key", "label", "tie", "x"]
        )


def fit_quality(
    docs: DataFrame, labels: DataFrame, parameters: BoostParameters = BoostParameters(), label: str = "quality",
    key: str = "doc_id", text: str = "text",
) -> Trees:
    """Trees fitted to at most ``parameters.most`` labelled rows outside the held-out fold.

    Statistics are made where the texts are; only they and the labels, a few
    numbers per sampled row, reach the driver. Without labels, or with one class
    alone, the trees give the smoothed share of class 1.
    """
    sample = training_sample(docs, labels, label, parameters.most, key, text)
    kind = sample.schema["key"].dataType.simpleString()
    sample = sample.select("key", F.col("text").cast("binary").alias("text"), "label", "tie")
    found = once(sample.mapInArrow(_statistics_of, f"key {kind}, label int, tie long, x array<double>"), "x").toPandas()
    found = found.sort_values(["key", "label", "tie"], kind="stable")
    x = np.array(found["x"].tolist(), float).reshape(len(found), len(STATISTICS))
    return boost(x, found["label"].to_numpy(float), parameters)


def quality_scores(docs: DataFrame, trees: Trees, key: str = "doc_id", text: str = "text", limit: float = 0.5) -> DataFrame:
    """``key``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (score >= ``limit``) of each row.

    A narrow operation. A null or empty text is scored like any other, by
    statistics of zero. Repeated rows keep a row each; other columns are ignored.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("binary").alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t.as_py()) for t in batch.column(1)]).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(trees.score(x))], ["key", "score"])

    scored = rows.mapInArrow(score, f"key {rows.schema['key'].dataType.simpleString()}, score double")
    return scored.select(
        F.col("key").alias(key),
        held_out(F.col("key")).alias("held_out"),
        "score",
        (F.col("score") >= limit).cast("int").alias("predicted"),
    )
