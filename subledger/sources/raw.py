"""Day-partitioned Parquet folders (``…/dt=YYYY-MM-DD/``): read, list, latest day, increments.

Everything is a DataFrame operation over the partition column, so Spark's
partition pruning does the path work and nothing is listed on the driver.
"""

from __future__ import annotations

import datetime
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.scalar import as_of_date


def read_raw(spark: SparkSession, base: str, dt=None, merge_schema: bool = False,
             schema: T.StructType | None = None) -> DataFrame:
    """Read a day-partitioned folder; ``dt`` prunes to one day (no path building).

    A declared ``schema`` (without ``dt``) reads no footers at planning time;
    ``merge_schema`` reads all of them and is for evolving tables only.
    """
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField("dt", T.DateType())]))
    df = reader.parquet(base)
    if dt is not None:
        df = df.where(F.col("dt") == as_of_date(dt))
    return df


def landed_days(spark: SparkSession, base: str) -> list[datetime.date]:
    """The days that have a folder, from a listing of the table's folder (one name per day)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [re.fullmatch(r"dt=(\d{4}-\d{2}-\d{2})", f.getPath().getName()) for f in fs.listStatus(p)]
    return sorted(datetime.date.fromisoformat(m[1]) for m in names if m)


def list_partitions(df: DataFrame) -> DataFrame:
    """(dt, rows) for every day present."""
    return df.groupBy("dt").agg(F.count(F.lit(1)).alias("rows"))


def day_of_file(path_col="_metadata.file_path"):
    """Day folder of a file path, NULL when the path has no ``dt=`` folder."""
    d = F.regexp_extract(F.col(path_col), S.DAY_FOLDER_REGEX, 1)
    return F.when(d != "", d.cast("date"))


def curated(spark: SparkSession, name: str, columns=None) -> DataFrame:
    """A catalog table with an explicit column list (pruned at the scan)."""
    df = spark.table(name)
    return df.select(*columns) if columns else df


def files_by_day(df: DataFrame) -> DataFrame:
    """(dt, files, rows) from the file paths themselves (``dt=`` folder of each file)."""
    day = day_of_file("_metadata.file_path")
    return (df.select(day.alias("dt"), F.col("_metadata.file_path").alias("_f"))
            .groupBy("dt").agg(F.countDistinct("_f").alias("files"), F.count(F.lit(1)).alias("rows")))


def latest_partition(df: DataFrame, as_of=None) -> DataFrame:
    """One row: the latest day present excluding ``as_of`` itself (today may be partial); NULL if none."""
    return df.where(F.col("dt") != as_of_date(as_of)).agg(F.max("dt").alias("latest_dt"))


def read_latest(df: DataFrame, as_of=None) -> DataFrame:
    """All rows of the latest complete day (empty when there is none).

    The latest day is a scalar subquery, so it is computed by one aggregate
    job and then used as a partition filter; nothing is collected.
    """
    latest = latest_partition(df, as_of)
    return df.where(F.col("dt") == latest.scalar())


def incremental_window(df: DataFrame, ts_col: str, latest=None, as_of=None) -> DataFrame:
    """Rows to (re)load: from one day before the latest loaded day through ``as_of``.

    ``latest`` is the latest loaded day: a date, a Column (e.g. the scalar
    subquery ``latest_partition(loaded).scalar()``), a loaded DataFrame with
    ``dt``, or ``None`` when nothing is loaded (then everything up to ``as_of``).
    Re-reading the day before the latest one catches late rows; the
    day-replacing write keeps the reload idempotent.
    """
    upper = F.col(ts_col) < F.date_add(as_of_date(as_of), 1).cast("timestamp")
    if latest is None:
        return df.where(upper)
    if isinstance(latest, DataFrame):
        latest = latest_partition(latest, as_of).scalar()
    day = as_of_date(latest)
    return df.where(upper & (day.isNull() | (F.col(ts_col) >= F.date_sub(day, 1).cast("timestamp"))))
