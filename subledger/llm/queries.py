"""The registered query of every operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .block_search import ORACLE as NEIGHBOUR_ORACLE
from .block_search import neighbours
from .common import table
from .language import identify
from .leaks import find_leaks
from .licences import oracle as licence_oracle
from .licences import scan_digest
from .mixing import mix_digest
from .page_text import extract
from .prefix_trie import ORACLE as TRIE_ORACLE
from .prefix_trie import prefix_trie
from .private import personal_data
from .repetition import oracle as repetition_oracle
from .repetition import repetition
from .ring_shards import shard_digest
from .simhash import simhash_digest
from .spelling import ORACLE as SPELLING_ORACLE
from .spelling import variants
from .warc import ORACLE as WARC_ORACLE
from .warc import archive_digest


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_digest(table(spark, sf_dir, "documents"))


def op2_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_digest(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op6_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_digest(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_digest(table(spark, sf_dir, "pages"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_digest(table(spark, sf_dir, "documents"))


def op10_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition(table(spark, sf_dir, "documents")).drop("repeats", "longest_repeat")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"))


#: DuckDB SQL of the queries that SQL can express
ORACLES: dict[str, str] = {"op3_licences": licence_oracle(), "op8_warc": WARC_ORACLE,
                           "op10_repetition": repetition_oracle(),
                           "op11_prefix_trie": TRIE_ORACLE, "op12_spelling": SPELLING_ORACLE, "op13_neighbours": NEIGHBOUR_ORACLE}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, fn in globals().items() if name.startswith("op") and callable(fn)}
