"""A training corpus from raw documents, in five stages.

Each stage reads what its predecessor wrote, as Parquet, in the cluster's shared
checkpoint folder; what a stage has left there goes when its successor is written.

Null and empty texts have no language and go in the first stage; null ids,
sources and languages stay, and rows equal to an earlier one go in the second.
An empty table gives an empty result. Extra columns pass all stages but the last.

1. language: documents without a recognised language go.
2. near_duplicates: of each group of near-duplicate documents one stays, that
   of the least id (five-word shingles, similarity 0.8).
3. decontaminate: documents that hold a benchmark item go.
4. mix: documents are taken as often as their source's share of the mix says,
   part of a document where a block of the mix ends in it.
5. shards: the mix is dealt into eight shards and shuffled; a digest of each
   row's text stands for it in the result.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language, mixing, ngram_join, sharding
from tidemark.llm.common import released, written
from tidemark.plans.storage import Files, shared_folder

SHARDS = 8


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language; automata are fitted on a bounded sample of labelled rows."""
    return language.accepted(docs, language.fit(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, columns unchanged."""
    return ngram_join.deduplicated(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark, columns unchanged."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of the mix: whole copies and parts of documents, columns unchanged."""
    return mixing.mixed_documents(docs)


def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix, with its text's size and checksum."""
    return sharding.shard_digests(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontaminate", decontaminate_stage),
    ("mix", mix_stage),
    ("shards", shard_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder, files = f"{shared_folder(spark)}/corpus-{uuid4().hex}", Files(spark)
    for k, (name, stage) in enumerate(STAGES):
        since = written()
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
            released(spark, since)
            if k:
                files.drop(f"{folder}/{STAGES[k - 1][0]}")
    return docs


#: Language ID by automata and hashed sketches aren't SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None
