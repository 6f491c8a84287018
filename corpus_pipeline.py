"""From raw documents to token files: quality rules, near-dedup, decontamination, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept.
``run`` writes each stage's rows as Parquet to the shared folder and reads them
again, so that no stage is computed twice and a lost executor costs tasks, not
stages. All stages but the last return the columns of ``documents``. Null texts,
repeated rows and empty tables are handled as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marginlab.llm.decontaminate import drop_contaminated
from marginlab.llm.mixing import domain_tree, mix
from marginlab.llm.quality_rules import clean_documents
from marginlab.llm.ship import ship
from marginlab.llm.simhash import drop_near_copies
from marginlab.llm.token_output import token_digests, write_tokens
from marginlab.session import new_shared_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go; documents that the rules reject go."""
    return clean_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one with the smallest id."""
    return drop_near_copies(docs, width=4, radius=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold the benchmark go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Four fifths of the tokens, by the weights of the tree; one epoch, so no document is repeated."""
    return mix(docs, domain_tree(), budget=0.8, max_epochs=1, seed=17).drop("__mix")


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; their documents, read back."""
    path = new_shared_path(spark, "pipeline-tokens")
    write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_digests(spark, path)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing", mixing),
    ("token output", token_output),
]

#: SQL has neither XXH64 nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    ship(spark)
    path = new_shared_path(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{k}")
        docs = spark.read.parquet(f"{path}/{k}")
    return docs
