"""Active merchants over any span of days, from stored bitmaps.

A day's active shops are kept as bitmaps: one row per day and bucket of 32,768 shop
numbers, one bit per shop. The shops of a span (week, month, quarter, or any days) are the
OR of its days' rows, and their number is exact: nothing is counted twice, and no interval
is read again. A new day adds or replaces its own rows; its month's folder is all it touches.

Any whole shop number works; numbers close together (a dense numbering) make few buckets. A
bitmap has 4 KB, so a day of n shops has n / 8 bytes where the numbers are dense. They are
built from one row per shop and month (31 bits, its active days), which are shuffled instead
of bitmaps: all of a bucket's month, 32,768 rows at most, comes together, and no day is sorted.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lineage import remove_path, staged
from ..sources.sinks import path_exists
from .active import day_ranges

BITMAP_SCHEMA = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("shops", T.BinaryType()),
                              T.StructField("active_date", T.DateType())])
STORED_SCHEMA = T.StructType([*BITMAP_SCHEMA.fields, T.StructField("month", T.DateType())])
#: bitmaps that a task sorts and writes (32 MB), however well they compress
TASK_BITMAPS = 8192


def active_bitmaps(intervals: DataFrame, as_of=None, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """(bucket, shops, active_date): the shops active on each day of ``first`` to ``last`` (default: all days)."""
    r = day_ranges(intervals.where(F.col("shopid").isNotNull()), as_of)
    lo = F.col("first_day") if first is None else F.greatest("first_day", F.lit(first))
    hi = F.col("last_day") if last is None else F.least("last_day", F.lit(last))
    months = (r.select("shopid", lo.alias("lo"), hi.alias("hi")).where(F.col("lo") <= F.col("hi"))
              .repartition(int(intervals.sparkSession.conf.get("spark.sql.shuffle.partitions")))
              .select(F.col("shopid").cast("long").alias("n"), "lo", "hi", F.explode(F.sequence(
                  F.trunc("lo", "month"), F.trunc("hi", "month"), F.expr("INTERVAL 1 MONTH"))).alias("month")))
    # bits from the span's first day in the month to its last
    from_day = F.dayofmonth(F.greatest("lo", "month")) - 1
    to_day = F.dayofmonth(F.least("hi", F.last_day("month")))
    shops = (months.select("n", "month", F.expr("1L").alias("one"), from_day.alias("a"), to_day.alias("b"))
             .groupBy("n", "month").agg(F.bit_or(F.expr("shiftleft(one, b) - shiftleft(one, a)")).alias("days")))
    placed = (shops.select("month", "days", F.bitmap_bucket_number("n").alias("bucket"), F.bitmap_bit_position("n").alias("bit"))
              .repartition("month", "bucket"))
    active = [F.when(F.col("days").bitwiseAND(F.lit(1 << d)) != 0, F.col("bit")) for d in range(31)]
    built = placed.groupBy("month", "bucket").agg(*[F.bitmap_construct_agg(c).alias(f"d{d}") for d, c in enumerate(active)])
    return (built.select("month", "bucket", F.posexplode(F.array(*[f"d{d}" for d in range(31)])).alias("day", "shops"))
            .where(F.bitmap_count("shops") > 0)
            .select("bucket", "shops", F.date_add("month", F.col("day")).alias("active_date")))


def stored_bitmaps(spark: SparkSession, base: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Stored days of ``first`` to ``last`` (default: all); only their months are read."""
    days = spark.read.schema(STORED_SCHEMA).parquet(base)
    if first is not None:
        days = days.where((F.col("month") >= F.lit(first.replace(day=1))) & (F.col("active_date") >= F.lit(first)))
    if last is not None:
        days = days.where((F.col("month") <= F.lit(last)) & (F.col("active_date") <= F.lit(last)))
    return days.drop("month")


def refresh_bitmaps(intervals: DataFrame, base: str, first: dt.date, last: dt.date, as_of=None) -> None:
    """Make the stored days of ``first`` to ``last`` what the intervals say; other months are neither read nor written.

    The days of a month share a folder (a folder a day would make thousands of tiny files), so the
    other days of the first and the last month are copied along.
    """
    spark = intervals.sparkSession
    months, month = [], first.replace(day=1)
    while month <= last:
        months.append(month)
        month = (month + dt.timedelta(days=31)).replace(day=1)
    new = active_bitmaps(intervals, as_of, first, last)
    kept = [f for f in (f"{base}/month={m.isoformat()}" for m in {months[0], months[-1]}) if path_exists(spark, f)]
    if kept:
        old = spark.read.schema(BITMAP_SCHEMA).parquet(*kept)
        new = new.unionByName(old.where(~F.col("active_date").between(F.lit(first), F.lit(last))))
    with staged(new.withColumn("month", F.trunc("active_date", "month"))) as rows:
        built = {r["month"]: r["count"] for r in rows.groupBy("month").count().collect()}   # at most one row a month
        for m in months:
            if m not in built:
                remove_path(spark, f"{base}/month={m.isoformat()}")
        tasks = max(1, math.ceil(sum(built.values()) / TASK_BITMAPS))
        (rows.repartitionByRange(tasks, "month", "active_date", "bucket").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(base))


def merchants_by_span(bitmaps: DataFrame, span: Column | str = "month") -> DataFrame:
    """(span_start, merchants): distinct shops active on some day of each span.

    ``span`` is a unit of ``trunc`` (week, month, quarter, year) or a column over ``active_date``.
    """
    start = F.trunc("active_date", span) if isinstance(span, str) else span
    return (bitmaps.groupBy(start.alias("span_start"), "bucket").agg(F.bitmap_or_agg("shops").alias("shops"))
            .groupBy("span_start").agg(F.sum(F.bitmap_count("shops")).cast("bigint").alias("merchants")))


def retained(bitmaps: DataFrame, span: str = "month") -> DataFrame:
    """(span_start, merchants, kept): of each span's shops, those that were active in the span before as well.

    The bitmaps of the two spans are met bit by bit: |a and b| = |a| + |b| - |a or b|.
    """
    own = (bitmaps.groupBy(F.trunc("active_date", span).alias("span_start"), "bucket")
           .agg(F.bitmap_or_agg("shops").alias("shops")))
    step = {"week": F.date_add("span_start", 7), "month": F.add_months("span_start", 1),
            "quarter": F.add_months("span_start", 3), "year": F.add_months("span_start", 12)}[span]
    # a bucket's row counts in its span, and in the span after as the one before
    both = (own.select("span_start", "bucket", "shops", F.lit(1).alias("own"))
            .unionByName(own.select(step.alias("span_start"), "bucket", "shops", F.lit(0).alias("own"))))
    met = both.groupBy("span_start", "bucket").agg(
        F.sum(F.when(F.col("own") == 1, F.bitmap_count("shops")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("own") == 0, F.bitmap_count("shops")).otherwise(0)).alias("b"),
        F.bitmap_count(F.bitmap_or_agg("shops")).alias("any"))
    return (met.groupBy("span_start").agg(F.sum("a").cast("bigint").alias("merchants"),
                                          F.sum(F.col("a") + F.col("b") - F.col("any")).cast("bigint").alias("kept"))
            .where(F.col("merchants") > 0))
