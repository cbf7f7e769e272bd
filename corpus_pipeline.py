"""Training-corpus pipeline over ``documents``: filter, deduplicate, decontaminate, mix, shard.

Every stage takes ``(spark, docs, sf_dir)``, works on all that its predecessor
kept and returns a DataFrame that is written as Parquet and reread as the next
stage's documents.  All but the last return the columns of ``documents``.

Cases follow the operators: a null text is an empty document, repeated rows are
documents of their own until the near-duplicate stage keeps one of each group,
an empty table gives an empty result, extra columns are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from posting_analytics.llm import decontam_tiling, mixing, ngram_join, quality_cnn, sharding
from posting_analytics.llm.common import ship_code, written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte-level network does not reject."""
    ship_code(spark)
    return quality_cnn.good_documents(docs, quality_cnn.fit_quality(docs, _table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents."""
    ship_code(spark)
    return ngram_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship_code(spark)
    return decontam_tiling.clean_documents(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix; one that two epochs take stands there twice."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document of the mix."""
    return sharding.assign_shards(docs, 24)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
    ("shard", shard),
]

#: The stages train a network and follow links: not a SQL query.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
