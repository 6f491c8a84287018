"""The pipeline: each stage on the rows the one before kept, against plain definitions."""

from __future__ import annotations

import corpus_pipeline
from conftest_llm import SF_DIR, by_id
from marginlab.llm import queries
from pyspark.sql import functions as F
from test_rules_mix_benchmark import PROSE, plain_contamination, plain_counts
from test_simhash import plain_fingerprint, plain_groups
from test_tokens import expected


def test_stages_and_run(spark, tmp_path):
    docs = queries.table(spark, SF_DIR, "documents")
    names, kept = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == names
            kept.append({r.doc_id: r.text for r in docs.collect()})
    first, dedup, clean, mixed = kept
    assert all(not plain_counts(t)[5] for t in first.values())
    groups = plain_groups([(i, plain_fingerprint(t, 4)) for i, t in first.items()], 4)
    assert set(dedup) == {i for i, g in groups.items() if i == g} and len(dedup) < len(first)
    items = [(r.item_id, r.text) for r in queries.table(spark, SF_DIR, "benchmark").collect()]
    assert set(clean) == {i for i, t in dedup.items() if not plain_contamination(t, items)[4]}
    assert set(mixed) <= set(clean) and 0 < len(mixed) < len(clean)
    tokens = lambda texts: sum(len(t.split()) for t in texts.values())
    assert 0.5 * tokens(clean) < tokens(mixed) <= 0.8 * tokens(clean)
    want = expected(sorted(mixed.items()))
    assert by_id(docs, "start", "n_tokens", "ids_crc32") == want
    assert by_id(corpus_pipeline.run(spark, SF_DIR), "start", "n_tokens", "ids_crc32") == want


def test_no_rows(spark, tmp_path):
    docs = queries.table(spark, SF_DIR, "documents").limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF_DIR)
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert docs.collect() == []


def test_nulls_repeats_and_extra_columns(spark, tmp_path):
    rows = [(1, PROSE), (1, PROSE), (2, PROSE), (3, None), (None, PROSE), (4, "")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", "1 AS key", "2 AS fp", "'x' AS tie")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:3]):
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert sorted([r.doc_id for r in docs.collect()], key=str) == [1, None]


def test_columns_of_any_name_are_kept(spark):
    """Names that the operators use for columns of their own."""
    rows = [(1, PROSE, 1), (2, PROSE + " More words at the end.", 2), (3, "x", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").selectExpr("*", "'en' AS lang", "'s1' AS source")
    names = "__row __gone __place __text __rules __lines __words __key __tie __mix __times row key tie rest doc fp place gone_key gone_tie a.b item word".split()
    for n in names:
        docs = docs.withColumn(n, F.concat(F.lit(n), F.col("doc_id").cast("string")))
    for _, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns
        found = out.collect()
        assert found and all(r[n] == f"{n}{r.doc_id}" for r in found for n in names)
