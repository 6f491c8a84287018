"""Helpers of the tests in this folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SF_DIR = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, texts, start: int = 0) -> DataFrame:
    """A documents table; entries are texts or (doc_id, text)."""
    rows = [x if isinstance(x, tuple) else (i, x) for i, x in enumerate(texts, start)]
    return spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], DOC)


def by_id(df: DataFrame, *columns: str) -> dict:
    """{doc_id: the columns}; a column alone is not wrapped."""
    found = {}
    for r in df.select("doc_id", *columns).collect():
        assert r[0] not in found
        found[r[0]] = r[1] if len(columns) == 1 else tuple(r[1:])
    return found
