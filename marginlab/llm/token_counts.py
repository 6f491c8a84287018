"""Token counts of whole texts, without keeping any token."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginlab.llm.pieces import by_size, counter

#: Bytes of text that a worker cuts and counts at once.
CHUNK = 2 << 20


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of each row.

    ``tokenizer`` is the path of a file of the ``tokenizers`` library whose words
    do not keep the space before them; each executor reads it there. No special
    tokens are added, nothing is truncated or padded; special strings inside a
    text are handled as the library does by default.

    A narrow operation: no shuffle, and only lengths leave a worker. Texts are
    cut at safe boundaries, so that a very long one is many small pieces.

    A null or empty text has 0 bytes and 0 tokens. Repeated rows and null keys
    keep a row each. Other columns are ignored, whatever their names.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = counter(tokenizer)
        for batch in batches:
            texts = batch.column(1)
            sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0)
            found = []
            for some in by_size(texts, CHUNK):
                found += words.count(some)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes.cast(pa.int64()), pa.array(found, pa.int64())],
                ["key", "n_bytes", "n_tokens"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"key {kind}, n_bytes long, n_tokens long")
    return counted.select(
        F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
