"""One query for each operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginlab.llm.collocations import collocations
from marginlab.llm.decontaminate import contamination
from marginlab.llm.exact_dedup import exact_groups
from marginlab.llm.html_text import html_texts
from marginlab.llm.lexical_search import search
from marginlab.llm.mixing import domain_tree, mix
from marginlab.llm.oracles import ORACLES  # noqa: F401
from marginlab.llm.quality_classifier import fit_quality, quality_scores
from marginlab.llm.quality_rules import quality_verdicts
from marginlab.llm.ship import ship
from marginlab.llm.simhash import simhash_groups
from marginlab.llm.substring_dedup import remove_repeats
from marginlab.llm.token_counts import token_counts
from marginlab.llm.token_output import token_digests, write_tokens
from marginlab.llm.toxicity import fit_toxicity, toxicity_scores
from marginlab.session import new_shared_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"), with_text=False)


@query
def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "token-output")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_digests(spark, path)


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), width=4, radius=4)


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity_scores(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


@query
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chosen = mix(docs, domain_tree(), budget=0.6, max_epochs=2, seed=17)
    return chosen.select("doc_id", *[F.col(f"__mix.{c}").alias(c) for c in ("domain", "lang", "source", "n_tokens", "epoch")])


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


@query
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_texts(table(spark, sf_dir, "pages"))


@query
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
