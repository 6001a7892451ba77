"""Active merchants per day, month-end roll, and store (install) status.

Two interchangeable ways to count distinct active shops per day:

* ``explode`` - each interval becomes its days with ``sequence`` + ``explode``
  (a map-side generator, no range join), then COUNT(DISTINCT shopid) by day,
  which Spark runs as partial aggregates on (day, shop) then (day).
* ``sweep`` - overlapping intervals of a shop are merged (gaps and islands),
  each island adds +1 on its first day and -1 after its last day; a running
  sum over the change days gives the count, and each constant run is spelled
  out as its days. Shuffles O(intervals) rows instead of O(active days).

Both report the days that some interval covers, up to ``as_of``. The sweep is
the default (1.66 s against 2.77 s at sf0.1 and far smaller shuffles at scale);
``method="explode"`` is the literal expansion, kept as its check.
The windows over all days / months are unpartitioned on purpose: their input
is at most one row per calendar day, bounded by the date span, not the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.lineage import cut
from ..functions.scalar import as_of_date, relationship_status
from ..functions.scan import asc, by_heat, ordered_scan


def day_ranges(intervals: DataFrame, as_of=None, max_days: int | None = None) -> DataFrame:
    """First and last active day of each interval (end day excluded, open -> as_of + 1).

    ``max_days`` ends every interval after so many days; by default nothing does.
    """
    today = as_of_date(as_of)
    start = F.to_date("activated_date")
    last = (F.when(F.col("actual_end_date").isNull(), F.date_add(today, 1))
            .otherwise(F.date_sub(F.to_date("actual_end_date"), 1)))
    if max_days is not None:
        last = F.least(last, F.date_add(start, max_days - 1))
    return (intervals
            .withColumn("first_day", start)
            .withColumn("last_day", last)
            .where(F.col("last_day") >= F.col("first_day")))


def interval_days(intervals: DataFrame, as_of=None, max_days: int | None = None) -> DataFrame:
    """Each interval expanded to one row per active day."""
    # every interval becomes many rows: spread them first, whatever the files' splits
    parts = int(intervals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    r = day_ranges(intervals, as_of, max_days).repartition(parts)
    return r.select(
        "shopid",
        F.to_date("activated_date").alias("activated_date"),
        F.to_date("actual_end_date").alias("actual_end_date"),
        F.explode(F.sequence("first_day", "last_day")).alias("active_date"),
    )


def merchants_by_day(intervals: DataFrame, as_of=None, max_days: int | None = None,
                     method: str = "sweep", checks=()) -> DataFrame:
    """(active_date, merchants) for every day with at least one active shop.

    ``checks``: the tables that the intervals come from, with a ``shopid`` and no fewer rows of any
    shop; hot shops are then found there, without computing the intervals for it.
    """
    if method == "explode":
        days = interval_days(intervals, as_of, max_days)
        return days.groupBy("active_date").agg(F.countDistinct("shopid").alias("merchants"))
    if method == "sweep":
        return _merchants_sweep(intervals, as_of, max_days, checks)
    raise ValueError(f"unknown method: {method}")


def _islands(split: bool, r: DataFrame) -> DataFrame:
    """Overlapping day ranges of a shop, merged."""
    order = [asc("first_day"), asc("last_day")]
    r = cut(ordered_scan(r, ["shopid"], order, split, reach=("cummax_before", "last_day")), split)
    r = r.withColumn("starts_island",
                     F.when(F.col("reach").isNull() | (F.col("first_day") > F.col("reach")), 1).otherwise(0))
    r = ordered_scan(r, ["shopid"], order, split, island=("cumsum", "starts_island"))
    return r.groupBy("shopid", "island").agg(F.min("first_day").alias("s"), F.max("last_day").alias("e"))


def _merchants_sweep(intervals: DataFrame, as_of, max_days: int | None, checks=()) -> DataFrame:
    r = day_ranges(intervals, as_of, max_days).select("shopid", "first_day", "last_day")
    islands = by_heat(_islands, None, "shopid", r, checks=checks)
    # a span without a shop covers its days but is no merchant (COUNT(DISTINCT) skips NULL)
    shop = F.col("shopid").isNotNull().cast("int")
    deltas = (islands
              .select(F.explode(F.array(
                  F.struct(F.col("s").alias("day"), F.lit(1).alias("c"), shop.alias("d")),
                  F.struct(F.date_add("e", 1).alias("day"), F.lit(-1).alias("c"), (-shop).alias("d")))).alias("x"))
              .groupBy(F.col("x.day").alias("active_date"))
              .agg(F.sum("x.d").alias("delta"), F.sum("x.c").alias("cover")))
    # running count at each change day, valid until the next change day
    w = Window.orderBy("active_date")
    runs = deltas.select(
        "active_date",
        F.sum("delta").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint").alias("merchants"),
        F.sum("cover").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("covering"),
        F.lead("active_date").over(w).alias("next_change"))
    return (runs.where(F.col("covering") > 0)
            .select(F.explode(F.sequence("active_date", F.date_sub("next_change", 1))).alias("active_date"),
                    "merchants"))


def month_end(counts: DataFrame, as_of=None) -> DataFrame:
    """Per month: merchants on its last reported day, and the previous month's value."""
    d = counts.where(F.col("active_date") <= as_of_date(as_of))
    months = (d.groupBy(F.trunc("active_date", "month").alias("month"))
              .agg(F.max_by("merchants", "active_date").alias("end_of_month_merchants")))
    return months.withColumn("last_month_merchants",
                             F.lag("end_of_month_merchants").over(Window.orderBy("month")))


def daily_active(intervals: DataFrame, as_of=None, max_days: int | None = None,
                 method: str = "sweep", checks=()) -> DataFrame:
    """Daily merchants with previous day, month, month-end and previous month-end.

    All from windows over the day table (at most one row per calendar day):
    the month-end value is the month's last reported day, and the previous
    month's end value is the previous-day value seen on a month's first day.
    """
    counts = merchants_by_day(intervals, as_of, max_days, method, checks)
    d = counts.where(F.col("active_date") <= as_of_date(as_of))
    d = d.select("active_date", "merchants",
                 F.lag("merchants").over(Window.orderBy("active_date")).alias("prev_day_merchants"),
                 F.trunc("active_date", "month").alias("month"))
    whole_month = (Window.partitionBy("month").orderBy("active_date")
                   .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return d.select(
        "active_date", "merchants", "prev_day_merchants", "month",
        F.last("merchants").over(whole_month).alias("end_of_month_merchants"),
        F.first("prev_day_merchants").over(whole_month).alias("last_month_merchants"))


def store_intervals(events: DataFrame, as_of=None, tiebreak: str = "cursor") -> DataFrame:
    """Active spans from install/reactivation to the shop's next status event.

    ``first_install`` is the shop's first event of any type (a grouped min,
    joined back), and a span with no later status event stays open until
    ``as_of + 1`` day.
    """
    ev = events.where(F.col("shopid").isNotNull())
    first = ev.groupBy("shopid").agg(F.min("occurredat").alias("first_install"))
    st = (ev.withColumn("status", relationship_status("eventtype")).where(F.col("status").isNotNull())
          .select("shopid", "shopdomain", "occurredat", "status", tiebreak))

    def next_status(split: bool, x: DataFrame) -> DataFrame:
        return cut(ordered_scan(x, ["shopid"], [asc("occurredat"), asc(tiebreak)], split,
                                next_status_at=("lead", "occurredat")), split)
    st = by_heat(next_status, None, "shopid", st, checks=(ev,))
    open_end = F.date_add(as_of_date(as_of), 1).cast("timestamp")
    spans = (st.where(F.col("status") == S.STATUS_ACTIVE)
             .select("shopid", "shopdomain", F.col("occurredat").alias("activated_date"),
                     F.coalesce("next_status_at", open_end).alias("actual_end_date"), tiebreak))
    return spans.join(first, "shopid", "left")
