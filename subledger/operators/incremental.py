"""Per-shop results kept up to date: only the buckets of touched shops are read and written.

Everything a per-shop job says about a shop follows from that shop's rows. Histories and results
are therefore laid out in the same hash buckets of the shop (folders ``bucket=0`` to ``n - 1``); new
rows are added to their buckets, the job runs over the histories of these buckets, and its result
replaces the same buckets of the result. All others stay as they are, unread.

A result that depends on the day of the run for every shop can't be kept like this. Open ends of
intervals are such a case: they are stored as ``OPEN_END`` and shown as the day after ``as_of`` by
``with_open_end``, so a new day changes no stored row by itself.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lineage import remove_path, staged
from ..functions.scalar import as_of_date
from ..sources import sinks
from .timeline import timeline_intervals

#: run the timeline as of this day: open intervals end the day after it, later than any event
OPEN_AS_OF = dt.date(9999, 12, 30)
OPEN_END = dt.date(9999, 12, 31)
BUCKETS = 256


def bucket_of(shop: Column | str, buckets: int = BUCKETS) -> Column:
    """A shop's bucket; rows without a shop share one."""
    c = F.col(shop) if isinstance(shop, str) else shop
    return F.pmod(F.xxhash64(c.cast("string")), F.lit(buckets)).cast("int")


def _laid_out(df: DataFrame, shop: str, buckets: int) -> DataFrame:
    # rebalanced: a bucket with a hot shop is written by several tasks, small ones share one, and the
    # rows are computed once (bounds of ranges would take a pass of their own)
    return df.withColumn("bucket", bucket_of(shop, buckets)).hint("rebalance", "bucket")


def add_rows(df: DataFrame, base: str, shop: str = "shopid", buckets: int = BUCKETS) -> None:
    """Append rows to a bucketed history."""
    _laid_out(df, shop, buckets).write.mode("append").partitionBy("bucket").parquet(base)


def touched_buckets(frames, shop: str = "shopid", buckets: int = BUCKETS) -> list[int]:
    """The buckets of the shops of some rows (at most ``buckets`` numbers)."""
    return sorted({r[0] for df in frames for r in df.select(bucket_of(shop, buckets).alias("b")).distinct().collect()})


def read_buckets(spark: SparkSession, base: str, numbers, schema) -> DataFrame:
    """The rows of some buckets; other folders are not listed."""
    folders = [f for f in (f"{base}/bucket={b}" for b in numbers) if sinks.path_exists(spark, f)]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def refresh(job: Callable[..., DataFrame], histories: Mapping[str, str], fresh: Mapping[str, DataFrame], out: str,
            shop: str = "shopid", buckets: int = BUCKETS) -> list[int]:
    """Add the ``fresh`` rows to their histories and bring the job's result up to date; returns the touched buckets.

    ``job(**tables)`` gets one DataFrame per history, which holds the touched buckets only, and returns
    rows with the shop column. Of a run that failed the histories may hold the rows already: run it again with
    the same rows through ``rebuild``, which computes given buckets anew without adding any.
    """
    numbers = touched_buckets(fresh.values(), shop, buckets)
    for name, df in fresh.items():
        add_rows(df, histories[name], shop, buckets)
    schemas = {name: df.schema for name, df in fresh.items()}
    rebuild(job, histories, schemas, out, numbers, shop, buckets)
    return numbers


def rebuild(job: Callable[..., DataFrame], histories: Mapping[str, str], schemas: Mapping, out: str, numbers,
            shop: str = "shopid", buckets: int = BUCKETS) -> None:
    """Compute the result of some buckets from their histories and replace them."""
    if not numbers:
        return
    spark = SparkSession.getActiveSession()
    tables = {name: read_buckets(spark, path, numbers, schemas[name]) for name, path in histories.items()}
    with staged(job(**tables)) as rows:
        left = set(touched_buckets([rows], shop, buckets))
        (_laid_out(rows, shop, buckets).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket").parquet(out))
    for b in set(numbers) - left:   # all rows of the bucket went
        remove_path(spark, f"{out}/bucket={b}")


def stored_intervals(events: DataFrame, free_label: str | None = None) -> DataFrame:
    """The subscription timeline with open ends as ``OPEN_END``, as it is kept in buckets."""
    return timeline_intervals(events, OPEN_AS_OF, **({} if free_label is None else {"free_label": free_label}))


def with_open_end(intervals: DataFrame, as_of=None) -> DataFrame:
    """Stored intervals as of a day: open ones end the day after it."""
    end = F.date_add(as_of_date(as_of), 1).cast("timestamp")
    is_open = F.col("actual_end_date") == F.lit(OPEN_END).cast("timestamp")
    return intervals.withColumn("actual_end_date", F.when(is_open, end).otherwise(F.col("actual_end_date")))
