"""Toxicity of documents by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginlab.llm.labelled import held_out, once, training_sample
from marginlab.sources.stored import stored

_WORD = re.compile(r"\w+")
_ODD = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]
#: Hashes of words that a worker remembers.
REMEMBERED = 300_000


@dataclass(frozen=True)
class FtrlParameters:
    """``most`` and ``most_coordinates``: bounds of the training sample, in rows and in coordinates of all its texts. ``bits``: size of the hashed space.

    ``alpha`` and ``beta`` set the rate of each coordinate, alpha / (beta + root of
    its summed squared gradients); ``l1`` makes weights zero, ``l2`` small.
    ``positive`` weighs the rows of class 1, which are few.
    """

    most: int = 16_000
    most_coordinates: int = 32_000_000
    bits: int = 20
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 10.0
    l2: float = 0.1
    epochs: int = 8
    positive: float = 3.0


@dataclass(frozen=True)
class SparseWeights:
    """Coordinates with a weight, ascending; the rest of the space weighs nothing."""

    bits: int
    bias: float
    at: np.ndarray
    weight: np.ndarray


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word.encode())
        return h


_HASHES = _WordHashes()


def coordinates(text: str | None, bits: int) -> np.ndarray:
    """Distinct hashed coordinates of the words, word pairs and pairs with one word skipped; whole text, lower case."""
    words = _WORD.findall((text or "").lower())
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    pairs = h[:-1] * _ODD[0] + h[1:] * _ODD[1]
    skips = h[:-2] * _ODD[2] + h[2:] * _ODD[3]
    mixed = np.concatenate([h, pairs, skips])
    mixed = (mixed ^ mixed >> np.uint64(32)) * _ODD[4]
    return np.unique((mixed >> np.uint64(64 - bits)).astype(np.uint32))


def ftrl(examples: list[tuple[np.ndarray, int]], p: FtrlParameters) -> SparseWeights:
    """Weights after ``epochs`` passes over (coordinates, label)."""
    size = (1 << p.bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    bias = np.array([1 << p.bits])

    def weights(at):
        pull = z[at]
        out = -(pull - np.sign(pull) * p.l1) / ((p.beta + np.sqrt(n[at])) / p.alpha + p.l2)
        out[np.abs(pull) <= p.l1] = 0
        return out

    for _ in range(p.epochs):
        for found, label in examples:
            at = np.concatenate([found, bias])
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label) * (p.positive if label else 1.0)
            old = n[at]
            n[at] = old + g * g
            z[at] += g - (np.sqrt(old + g * g) - np.sqrt(old)) / p.alpha * w
    every = np.concatenate([np.flatnonzero(z[:-1]), bias])
    w = weights(every)
    used = np.flatnonzero(w[:-1])
    return SparseWeights(p.bits, float(w[-1]), every[used].astype(np.uint32), w[used].astype(np.float32))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, parameters: FtrlParameters = FtrlParameters(), label: str = "toxic",
    key: str = "doc_id", text: str = "text",
) -> SparseWeights:
    """Weights fitted to at most ``parameters.most`` labelled rows outside the held-out fold.

    Texts are hashed where they are and stored. The coordinates of the sample are learnt from on the driver, in the
    order of a hash of their key; it holds about ``parameters.most_coordinates`` of them at most: of a sample with
    more, examples are taken by that hash. Without labels all weights are zero.
    """
    sample = training_sample(docs, labels, label, parameters.most, key, text)
    bits = parameters.bits

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [coordinates(t.as_py(), bits).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), pa.array(found, pa.binary())], ["key", "label", "tie", "at"]
            )

    kind = sample.schema["key"].dataType.simpleString()
    found = sample.select("key", "text", "label", "tie").mapInArrow(hashed, f"key {kind}, label int, tie long, at binary")
    order = F.xxhash64(F.col("key"), F.lit("order"))
    found = stored(once(found, "at").select(order.alias("order"), "label", "at"), "coordinates")
    held = (found.agg(F.sum(F.octet_length("at"))).first()[0] or 0) // 4
    if held > parameters.most_coordinates:
        rate = parameters.most_coordinates / held
        found = found.where(F.pmod(F.col("order"), F.lit(1 << 30)) < int(rate * (1 << 30)))
    rows = sorted((r.order, r.label, bytes(r.at)) for r in found.toLocalIterator())
    return ftrl([(np.frombuffer(at, np.uint32), y) for _, y, at in rows], parameters)


def toxicity_scores(docs: DataFrame, weights: SparseWeights, key: str = "doc_id", text: str = "text", limit: float = 0.7) -> DataFrame:
    """``key``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (score >= ``limit``) of each row.

    A narrow operation; the weights travel as two short arrays. A null or empty
    text has no coordinates and gets the score of the bias. Repeated rows keep a
    row each; other columns are ignored.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(1 << weights.bits, np.float32)
        dense[weights.at] = weights.weight
        for batch in batches:
            sums = [float(dense[coordinates(t.as_py(), weights.bits)].sum(dtype=np.float64)) for t in batch.column(1)]
            raw = np.clip(np.array(sums, float) + weights.bias, -35, 35)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-raw)))], ["key", "score"])

    scored = rows.mapInArrow(score, f"key {rows.schema['key'].dataType.simpleString()}, score double")
    return scored.select(
        F.col("key").alias(key),
        held_out(F.col("key")).alias("held_out"),
        "score",
        (F.col("score") >= limit).cast("int").alias("predicted"),
    )
