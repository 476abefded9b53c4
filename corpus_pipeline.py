"""A corpus pipeline in stages; each takes (spark, docs, sf_dir), and its result is written and read again as the next one's docs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeline.llm import decontaminate, langid, mixing, shard, simhash
from tapeline.llm._shared import stage
from tapeline.llm.queries import TARGETS

SHARDS = 24


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, and texts whose n-grams mostly belong to no known language, go."""
    return langid.known_language(docs, langid.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts whose five-word shingles have a Jaccard similarity of 0.8 the document of the smallest id stays."""
    return simhash.keep_one(docs, size=5, similarity=0.8)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or thinned so that languages have their target shares of the tokens."""
    return mixing.draw(docs, mixing.mix(docs, docs, "lang", TARGETS))


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its shard and a place in it."""
    return shard.shard(docs, SHARDS)


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: Expectation-maximisation and fitted rates have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, f in STAGES[:-1]:
        docs = stage(f(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
