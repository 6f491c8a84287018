"""Labelled documents for fitting a classifier: which may be learnt from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(key: Column) -> Column:
    """True for the fold that is never learnt from: crc32 of the key as text, modulo 3, is 1. A null key is not held out."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _at_most(rows: DataFrame, there: int, most: int) -> DataFrame:
    """About ``most`` rows at most, chosen by a hash of all columns but the text; all if there are fewer."""
    if there <= most:
        return rows
    # Four standard deviations below the bound.
    rate = max(most - 4 * most**0.5, 0) / there
    told = [c for c in ("key", "label", "tie") if c in rows.columns]
    return rows.where(F.pmod(F.xxhash64(*told, F.lit("sample")), F.lit(1 << 30)) < int(rate * (1 << 30)))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, label, tie) of the labelled rows outside the held-out fold that ``most`` has room for.

    An example is a key, a label and a text (``tie``: its hash). Labels, each with
    its key counted once, are sampled to about ``most`` and broadcast, so documents
    are not shuffled. The examples that they meet are counted, equal ones once, and
    sampled to about ``most`` again, as one key may have very many texts. Equal rows
    are still repeated here; ``once`` leaves one. Rows with a null key or label are
    left out; a document with several different labels counts once for each.
    """
    usable = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("label"))
    usable = usable.where(F.col("key").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("key"))).distinct()
    usable = _at_most(usable, usable.count(), most)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    met = rows.join(F.broadcast(usable), "key").withColumn("tie", F.xxhash64("text"))
    return _at_most(met, met.select("key", "label", "tie").distinct().count(), most)


def once(examples: DataFrame, made: str) -> DataFrame:
    """One of each (key, label, tie), whose ``made`` column, made from the text, is the same; added up before they move."""
    return examples.groupBy("key", "label", "tie").agg(F.min(made).alias(made))
