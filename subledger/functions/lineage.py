"""Lineage cuts between stages of long jobs.

A two-level scan reads its input twice (rows and per-bucket summaries), so a
chain of them doubles the logical plan at every step. Long jobs therefore
write their stage outputs as Parquet into a fresh folder under the shared
directory named by ``spark.checkpoint.dir`` and continue from the files: the
plan restarts there, later stages read only the columns they use, and a lost
executor does not force recomputation from the sources.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import work_path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system (any store); nothing happens if it is not there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` written once as Parquet for the steps of the block, then deleted."""
    spark = df.sparkSession
    path = work_path(spark, "stage")
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_path(spark, path)


def cut(df: DataFrame, enabled: bool = True) -> DataFrame:
    if not enabled:
        return df
    spark = df.sparkSession
    path = work_path(spark, "stage")
    df.write.parquet(path)
    return spark.read.parquet(path)
