"""Named queries over the driver tables: one per operator or stage.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables. Timestamp outputs are returned as ``TIMESTAMP_NTZ`` wall-clock values
(the session runs in UTC) so that they compare as plain values with DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixtures as fx
from ..functions.lineage import cut
from ..functions.scalar import subscription_event
from ..functions.scan import hot_keys
from ..operators import active, attribution, incremental, mrr, spans, timeline
from ..session import work_path

Query = Callable[[SparkSession, str], DataFrame]


def plain_times(df: DataFrame) -> DataFrame:
    """Cast instant timestamps to wall-clock (NTZ) values for comparison."""
    cols = [F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)


# --- C03 ------------------------------------------------------------------
def q_mrr_shop_month(spark, sf_dir):
    return mrr.mrr_shop_month(fx.order_payments(spark, sf_dir), fx.ORDERS_AS_OF)


def q_mrr_monthly(spark, sf_dir):
    return mrr.mrr_monthly(fx.order_payments(spark, sf_dir), fx.ORDERS_AS_OF)


def q_mrr_monthly_events(spark, sf_dir):
    return mrr.mrr_monthly(fx.payments(spark, sf_dir), fx.EVENTS_AS_OF)


def q_mrr_monthly_bronze(spark, sf_dir):
    """Landed amounts are doubles with cents; the totals must not depend on the order of the sum."""
    landed = fx.bronze_transactions(spark, sf_dir)
    shop = F.regexp_extract(F.col("cursor"), "^0*([0-9]+)$", 1).cast("long").alias("event_id")
    users = fx.table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("shopid"))
    tx = (landed.select(F.col("createdAt").alias("createdat"), F.col("grossAmount").alias("netamount"), shop)
          .join(users, "event_id"))
    return mrr.mrr_monthly(tx, fx.EVENTS_AS_OF)


def q_shop_last_month(spark, sf_dir):
    shop_rev = mrr.mrr_components(mrr.revenue_by_month(fx.order_payments(spark, sf_dir)))
    return mrr.shop_last_month(shop_rev)


def q_mrr_cumulative(spark, sf_dir):
    return mrr.cumulative_revenue(fx.order_payments(spark, sf_dir))


# --- C01 ------------------------------------------------------------------
def q_timeline_events(spark, sf_dir):
    return timeline.timeline_events(fx.subscription_events(spark, sf_dir))


def q_timeline_intervals(spark, sf_dir):
    return timeline.timeline_intervals(fx.subscription_events(spark, sf_dir), fx.EVENTS_AS_OF)


# --- C04 / C05 / C06 -------------------------------------------------------
def q_interval_days(spark, sf_dir):
    return active.interval_days(fx.order_intervals(spark, sf_dir), fx.ORDERS_AS_OF)


def q_daily_active(spark, sf_dir):
    return active.daily_active(fx.order_intervals(spark, sf_dir), fx.ORDERS_AS_OF, method="explode")


def q_daily_active_sweep(spark, sf_dir):
    return active.daily_active(fx.order_intervals(spark, sf_dir), fx.ORDERS_AS_OF, method="sweep")


def q_month_end(spark, sf_dir):
    counts = active.merchants_by_day(fx.order_intervals(spark, sf_dir), fx.ORDERS_AS_OF, method="sweep")
    return active.month_end(counts, fx.ORDERS_AS_OF)


def q_daily_active_timeline(spark, sf_dir):
    ev = fx.subscription_events(spark, sf_dir)
    return active.daily_active(timeline.timeline_intervals(ev, fx.EVENTS_AS_OF), fx.EVENTS_AS_OF, checks=(ev,))


def q_active_by_span(spark, sf_dir):
    """Distinct merchants per week, month, quarter and year, from daily bitmaps stored in two runs."""
    spans_, base = fx.order_intervals(spark, sf_dir), work_path(spark, "active-bitmaps")
    for first, last in ((fx.ORDERS_FIRST, fx.ORDERS_SPLIT), (fx.ORDERS_SPLIT, fx.ORDERS_AS_OF)):   # one day is done again
        spans.refresh_bitmaps(spans_, base, first, last, fx.ORDERS_AS_OF)
    days = spans.stored_bitmaps(spark, base)
    parts = [spans.merchants_by_span(days, unit).select(F.lit(unit).alias("unit"), "span_start", "merchants")
             for unit in ("week", "month", "quarter", "year")]
    return reduce(DataFrame.unionByName, parts)


def q_active_retained(spark, sf_dir):
    """Merchants of each month, and how many of them were active in the month before."""
    return spans.retained(spans.active_bitmaps(fx.order_intervals(spark, sf_dir), fx.ORDERS_AS_OF, last=fx.ORDERS_AS_OF))


def _day_by_day(spark, job, histories, out, frames, split):
    """History up to a day, then a run for the rows of each later day."""
    times = {name: t for name, (_, t) in frames.items()}
    early = {name: df.where(F.col(t) < F.lit(split).cast("timestamp")) for name, (df, t) in frames.items()}
    incremental.refresh(job, histories, early, out, buckets=16)
    later = {name: df.where(F.col(t) >= F.lit(split).cast("timestamp")) for name, (df, t) in frames.items()}
    cut_at = F.lit(fx.BACKFILL_AS_OF).cast("timestamp")
    for part in (lambda t: F.col(t) < cut_at, lambda t: F.col(t) >= cut_at):
        fresh = {name: df.where(part(times[name])) for name, df in later.items()}
        incremental.refresh(job, histories, fresh, out, buckets=16)


def q_timeline_incremental(spark, sf_dir):
    """The timeline kept in buckets of the shop through three runs, shown as of the last day."""
    ev, out = fx.subscription_events(spark, sf_dir), work_path(spark, "silver-timeline")
    _day_by_day(spark, lambda events: incremental.stored_intervals(events), {"events": work_path(spark, "history-events")},
                out, {"events": (ev, "occurredat")}, fx.INCREMENT_FROM)
    return incremental.with_open_end(spark.read.parquet(out).drop("bucket"), fx.EVENTS_AS_OF)


def q_tx_attributed_incremental(spark, sf_dir):
    """The attribution kept in buckets of the shop through three runs."""
    pay, ev, out = fx.payments(spark, sf_dir), fx.subscription_events(spark, sf_dir), work_path(spark, "silver-tx")
    paths = {"tx": work_path(spark, "history-tx"), "events": work_path(spark, "history-events")}
    _day_by_day(spark, lambda tx, events: attribution.attribute_from_events(tx, events, fx.EVENTS_AS_OF), paths, out,
                {"tx": (pay, "createdat"), "events": (ev, "occurredat")}, fx.INCREMENT_FROM)
    return spark.read.parquet(out).drop("bucket")


def q_store_status(spark, sf_dir):
    return active.store_intervals(fx.relationship_events(spark, sf_dir), fx.EVENTS_AS_OF)


def q_store_daily_active(spark, sf_dir):
    ev = fx.relationship_events(spark, sf_dir)
    return active.daily_active(active.store_intervals(ev, fx.EVENTS_AS_OF), fx.EVENTS_AS_OF, checks=(ev,))


# --- C02 ------------------------------------------------------------------
def _attr_split(spark, sf_dir):
    """The stage queries below take one path for all shops: buckets as soon as one is hot."""
    pay = fx.payments(spark, sf_dir)
    ev = fx.subscription_events(spark, sf_dir)
    split = hot_keys("shopid", pay, ev.where(subscription_event("eventtype"))) is not None
    return pay, timeline.timeline_intervals(ev, fx.EVENTS_AS_OF, bucketed=split), split


def _attr_inputs(spark, sf_dir):
    pay, subs, split = _attr_split(spark, sf_dir)
    tx = cut(attribution.numbered_transactions(pay, bucketed=split), split)
    return tx, cut(attribution.with_previous(subs, bucketed=split), split), split


def q_tx_numeric_id(spark, sf_dir):
    return attribution.numbered_transactions(fx.payments(spark, sf_dir))


def q_tx_subs_prev(spark, sf_dir):
    return _attr_inputs(spark, sf_dir)[1]


def q_tx_matched(spark, sf_dir):
    tx, s, split = _attr_inputs(spark, sf_dir)
    return attribution.matched_payments(tx, s, bucketed=split).drop("ended_same_month", "ended_month_before")


def q_tx_choice(spark, sf_dir):
    tx, s, split = _attr_inputs(spark, sf_dir)
    return attribution.choose_attribution(cut(attribution.matched_payments(tx, s, bucketed=split), split))


def q_tx_labelled(spark, sf_dir):
    tx, s, split = _attr_inputs(spark, sf_dir)
    return attribution.label_sales(
        attribution.choose_attribution(cut(attribution.matched_payments(tx, s, bucketed=split), split)))


def q_tx_attributed(spark, sf_dir):
    return attribution.attribute_from_events(fx.payments(spark, sf_dir), fx.subscription_events(spark, sf_dir),
                                             fx.EVENTS_AS_OF)


def q_tx_attributed_backfill(spark, sf_dir):
    """A run for a past day: open intervals that start after it end before they start."""
    return attribution.attribute_from_events(fx.payments(spark, sf_dir), fx.subscription_events(spark, sf_dir),
                                             fx.BACKFILL_AS_OF)


def q_tx_one_shop(spark, sf_dir):
    """The single-shop run, for the shop with the lowest id."""
    pay, ev = fx.payments(spark, sf_dir), fx.subscription_events(spark, sf_dir)
    shop = pay.agg(F.min("shopid")).first()[0]
    return attribution.attribute_from_events(pay, ev, fx.EVENTS_AS_OF, shop)


QUERIES: dict[str, Query] = {
    "mrr_shop_month": q_mrr_shop_month,
    "mrr_monthly": q_mrr_monthly,
    "mrr_monthly_events": q_mrr_monthly_events,
    "mrr_monthly_bronze": q_mrr_monthly_bronze,
    "shop_last_month": q_shop_last_month,
    "mrr_cumulative": q_mrr_cumulative,
    "timeline_events": q_timeline_events,
    "timeline_intervals": q_timeline_intervals,
    "interval_days": q_interval_days,
    "daily_active": q_daily_active,
    "daily_active_sweep": q_daily_active_sweep,
    "month_end": q_month_end,
    "daily_active_timeline": q_daily_active_timeline,
    "active_by_span": q_active_by_span,
    "active_retained": q_active_retained,
    "timeline_incremental": q_timeline_incremental,
    "tx_attributed_incremental": q_tx_attributed_incremental,
    "store_status": q_store_status,
    "store_daily_active": q_store_daily_active,
    "tx_numeric_id": q_tx_numeric_id,
    "tx_subs_prev": q_tx_subs_prev,
    "tx_matched": q_tx_matched,
    "tx_choice": q_tx_choice,
    "tx_labelled": q_tx_labelled,
    "tx_attributed": q_tx_attributed,
    "tx_attributed_backfill": q_tx_attributed_backfill,
    "tx_one_shop": q_tx_one_shop,
}


def all_queries() -> dict[str, Query]:
    from . import ingest
    return {**QUERIES, **ingest.QUERIES}


def registered() -> dict[str, Query]:
    return {name: (lambda fn: (lambda spark, sf_dir: plain_times(fn(spark, sf_dir))))(fn)
            for name, fn in all_queries().items()}
