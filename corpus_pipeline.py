"""A corpus from raw documents to token files, in stages.

Each stage takes (spark, docs, sf_dir) and returns the columns of ``docs``, but for the last, which returns what the
token files hold. ``run`` writes every stage's rows as Parquet to the shared folder and reads them for the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipquarry.llm import decontaminate, mixing, quality, simhash, token_output
from clipquarry.llm.common import store, table
from clipquarry.llm.queries import END_ID


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that are graded low with high probability. The classifier learns from the documents that
    ``labels`` grades; null and empty texts are graded as texts without words."""
    return quality.select_quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies, the one with the smallest id."""
    return simhash.deduplicate(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes documents of which benchmark windows cover at least a twentieth."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents to the target weights of their sources; copies are rows of their own."""
    return mixing.poisson_mix(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes token files and returns what they hold of each document."""
    path = public_tokenizers.path("word_bpe_49k.json")
    read = token_output.round_trip(docs, path, end_id=END_ID)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]
# A trained classifier, SimHash and a tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
