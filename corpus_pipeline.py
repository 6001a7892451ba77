"""Corpus pipeline over ``documents``: five stages, each one operator of ``subledger.llm``.

Every stage works on all rows that its predecessor kept. Its result is written as
Parquet into the session's shared folder and read again, so a later stage never
computes an earlier one anew and lost executors cost one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from subledger.functions.lineage import remove_path
from subledger.llm.common import table
from subledger.llm.language import accepted
from subledger.llm.leaks import decontaminated
from subledger.llm.mixing import mixed_documents
from subledger.llm.ring_shards import shard_digest
from subledger.llm.simhash import deduplicated
from subledger.session import work_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a recognised language."""
    return accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every group linked by SimHash."""
    return deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that every source meets its target."""
    return mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix."""
    return shard_digest(docs)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("mix_sources", mix_sources), ("shard", shard)]

#: trained models, random rounding and XXH64 have no SQL form; the tests hold ``run`` against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; a stage's folder is deleted when the next one has been written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
