"""Subscription timeline: charge events -> validity intervals per (shop, charge).

An interval starts at the charge's first event and is attached to every
ACTIVATED / UNFROZEN row of the charge; it ends at the earlier of the next
event of the same charge and the shop's next activation, or one day after
``as_of`` when both are missing.

Window order keys are made total with the event's ``cursor`` (unique per
event), so tied timestamps give the same result on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.lineage import cut
from ..functions.scalar import as_of_date, interval_end, pricing_plan, subscription_event
from ..functions.scan import asc, by_heat, ordered_scan


def timeline_events(events: DataFrame, shop=None, tiebreak: str = "cursor",
                    bucketed: bool | None = None) -> DataFrame:
    """Subscription-charge events with the charge's first time and the next event's time.

    Both come from one ordered scan per (shop, charge) in event-time order. With
    a hot shop (``bucketed=None`` checks) the scan is split into buckets of rows so
    that no shop or charge is ever scanned by a single task.
    """
    ev = events.where(subscription_event("eventtype"))
    if shop is not None:
        ev = ev.where(F.col("shopid") == F.lit(shop))
    ev = ev.where(F.col("shopid").isNotNull()).select(
        "eventtype", "occurredat", "shopid", "shopdomain", "chargename", "chargeid", "chargeamount", tiebreak)
    return by_heat(lambda split, x: _timeline_events(split, x, tiebreak), bucketed, "shopid", ev)


def _timeline_events(bucketed: bool, ev: DataFrame, tiebreak: str) -> DataFrame:
    if not bucketed:
        # cluster by shop once: the (shop, charge) window and every later per-shop
        # window (next activation, attribution) then need no further shuffle
        ev = ev.repartition("shopid")
    return ordered_scan(
        ev, ["shopid", "chargeid"], [asc("occurredat"), asc(tiebreak)],
        bucketed,
        activated_date=("first_nonnull", "occurredat"),
        deactivated_date=("lead", "occurredat"))


def timeline_intervals(events: DataFrame, as_of=None, shop=None, free_label: str = S.FREE_PLAN_LABEL,
                       tiebreak: str = "cursor", bucketed: bool | None = None) -> DataFrame:
    """One interval per ACTIVATED / UNFROZEN event: [activated_date, actual_end_date]."""
    return by_heat(lambda split, ev: _timeline_intervals(split, ev, as_of, shop, free_label, tiebreak), bucketed,
                   "shopid", events, checks=(events.where(subscription_event("eventtype")),))


def _timeline_intervals(bucketed: bool, events: DataFrame, as_of, shop, free_label: str, tiebreak: str) -> DataFrame:
    ranked = cut(timeline_events(events, shop, tiebreak, bucketed), bucketed)
    starts = ranked.where(F.col("eventtype").isin(*S.INTERVAL_START_EVENTS))
    nxt = ordered_scan(
        starts, ["shopid"], [asc("activated_date"), asc("occurredat"), asc(tiebreak)],
        bucketed,
        next_activation=("lead", "activated_date"))
    open_end = F.date_add(as_of_date(as_of), 1).cast("timestamp")
    return nxt.select(
        "shopid", "shopdomain", "chargeid", "activated_date", "chargeamount",
        pricing_plan("chargename", free_label).alias("pricing_plan"),
        interval_end("next_activation", "deactivated_date", open_end).alias("actual_end_date"),
        tiebreak,
    )
