"""Payment -> plan attribution (the silver transactions job).

Stages (each a function, each a registered query):

1. ``numbered_transactions``  trailing-digit id and the previous payment's amount.
2. ``with_previous``           each subscription with the previous one's plan/amount/dates.
3. ``matched_payments``        per distinct payment, the subscription values in rank order,
                               neighbour amounts and payments per day.
4. ``choose_attribution``      current vs previous subscription (the 4-column CASE).
5. ``label_sales``             sale-type label from the id, final casts, month.
6. ``attribute_transactions``  carry-forward for repeated amounts and previous plan/amount.

Nearest interval without pairs
------------------------------
The source ranks every payment against every subscription of its shop by
``(distance, activated_date, actual_end_date)`` and keeps, *per column*, the
first non-NULL value. Materialising those pairs is quadratic per shop. The
rank key splits into three tiers that can each be answered by one sorted pass
over the union of payments and subscription breakpoints per shop:

* distance 0 - the payment lies in ``[start, E)``, ``E`` = midnight after the
  end day (inside, or ended earlier that same day). The winner is the lowest
  ``(start, end)`` covering the payment. Sorted by that key, subscription ``j``
  wins exactly on ``[max(start_j, max E of earlier ones), E_j)``, so these
  disjoint segments come from one running max, and a payment takes the last
  segment starting at or before it. An interval whose start is missing or lies
  after its end (any backfill whose ``as_of`` precedes some events makes them)
  covers only ``(end, E)``, the rest of its end day. Among those of a day the
  lowest key that has ended wins, so an interval takes over from its end on
  only if its key is lower than all that ended before it that day; the lower
  key of both winners is taken.
* distance d >= 1 - ended on an earlier day: the latest ``E <= t`` wins,
  ties by key: a fill over end marks.
* 999999 - anything else. It is only reached when no interval of the shop has
  ended or begun, for that column, so all of them are in this tier and the
  shop's lowest key wins: one mark per shop and column before all others.

All tiers come out of one window over payments + marks per shop (see
``nearest_interval``); no payment is ever paired with a subscription.
Each column keeps its own candidates (rows where it is non-NULL), so the
result equals the ordered-list form exactly, ties broken by ``tiebreak``;
missing starts and ends sort last.

The later steps (lag/lead over payments, counts per shop-day) are windows over
one row per distinct payment. The two EXISTS tests over the array of previous
end dates ("ended this month" / "the month before") are answered by month
marks in the same pass (``month_flags``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lineage import cut
from ..functions.scalar import month_start, numeric_id, sale_label, subscription_event
from ..functions.scan import Ord, asc, by_heat, desc, ordered_scan
from .timeline import timeline_intervals

ATTR_COLS = (
    "pricing_plan", "prev_pricing_plan", "chargeamount", "prev_chargeamount",
    "activated_date", "actual_end_date", "prev_activated_date", "prev_actual_end_date",
)
PAYMENT_KEYS = ("createdat", "id", "_id", "netamount", "prev_netamount", "shopid")
CHOSEN = (("pricing_plan", "prev_pricing_plan"), ("chargeamount", "prev_chargeamount"),
          ("activated_date", "prev_activated_date"), ("actual_end_date", "prev_actual_end_date"))


def _id_order() -> list[Ord]:
    """Total payment order by numeric id (NULL ids last), then time, id, amounts."""
    return [asc("_id"), asc("createdat"), asc("id"), asc("netamount"), asc("prev_netamount")]


def numbered_transactions(tx: DataFrame, shop=None, bucketed: bool | None = None) -> DataFrame:
    """Payments with ``_id`` (trailing digits) and the previous payment's net amount."""
    t = tx.select("createdat", "id", numeric_id("id").alias("_id"), "chargeid", "netamount", "shopid")
    if shop is not None:
        t = t.where(F.col("shopid") == F.lit(shop))
    return by_heat(
        lambda split, x: ordered_scan(x, ["shopid"], [asc("_id"), asc("id"), asc("createdat"), asc("netamount")],
                                      split, prev_netamount=("lag", "netamount")),
        bucketed, "shopid", t)


def with_previous(subs: DataFrame, tiebreak: str = "cursor", bucketed: bool | None = None) -> DataFrame:
    """Each interval with the previous interval (by start) of its shop.

    The source applies DISTINCT here; identical rows cannot change a first
    value or an EXISTS test downstream, so no dedup step is needed.
    """
    base = subs.select("shopid", "activated_date", "actual_end_date", "pricing_plan", "chargeamount", tiebreak)
    return by_heat(
        lambda split, x: ordered_scan(
            x, ["shopid"], [asc("activated_date"), asc(tiebreak)],
            split,
            prev_pricing_plan=("lag", "pricing_plan"), prev_chargeamount=("lag", "chargeamount"),
            prev_activated_date=("lag", "activated_date"), prev_actual_end_date=("lag", "actual_end_date")),
        bucketed, "shopid", base)


def nearest_interval(points: DataFrame, subs: DataFrame, cols=ATTR_COLS, at: str = "createdat",
                     tiebreak: str = "cursor", bucketed: bool = False,
                     month_flags: str | None = None) -> DataFrame:
    """For each point row, per column, the first non-NULL value in rank order (see module doc).

    ``points`` needs ``shopid`` and ``at``; ``subs`` needs ``shopid``,
    ``activated_date``, ``actual_end_date``, ``tiebreak`` and ``cols``.
    Returns ``points`` plus one column per entry of ``cols``.

    Plan: one window over the intervals (running max of E in key order), one over
    those of a shop and end day (lowest key so far), one generator turning each
    interval into its marks, and one window over points + marks per shop. Marks
    sort by (time, kind, key) so that every tier is a last-non-NULL fill:

    * kind -1, before all times: the shop's lowest key per column, one mark each,
      in the column of the end marks: it counts until one comes;
    * kind 0 end marks at E, key descending: ``last`` = latest E <= t, lowest key;
    * kind 2 segment marks: ``last`` = the distance-0 segment holding t, if it
      has not ended;
    * kinds 5 and 6 (only with ``month_flags``): month-start marks of the
      column's month and of the month after it. The latest kind-5 (kind-6) mark
      at or before t lies on t's month start exactly when some interval of the
      shop has that column in t's month (in the month before): the two EXISTS
      tests of the choice step, answered in the same pass (output columns
      ``ended_same_month`` and ``ended_month_before``);
    * kind 10 marks of intervals that cover the rest of their end day only,
      after the points of the same time.

    Points are kind 9.
    """
    a, e, tb = F.col("activated_date"), F.col("actual_end_date"), F.col(tiebreak)
    n = len(cols)
    first_ts = F.lit("0001-01-01 00:00:00").cast("timestamp")
    fm = month_start(month_flags).cast("timestamp") if month_flags else F.lit(None).cast("timestamp")
    s = subs.select(
        "*", F.date_add(F.to_date(e), 1).cast("timestamp").alias("_E"),
        F.struct(a.isNull().alias("an"), a.alias("a"), e.isNull().alias("en"), e.alias("e"), tb.alias("tb")).alias("_key"),
        F.when(e.isNotNull(), a.isNull() | (a > e)).alias("_rest"), fm.alias("_fm0"))
    s = s.select("*", *[F.when(F.col(c).isNotNull() & ~F.col("_rest"), F.col("_E")).alias(f"_ce{i}")
                        for i, c in enumerate(cols)],
                 *[F.when(F.col(c).isNotNull(), F.lit(1)).alias(f"_has{i}") for i, c in enumerate(cols)])

    # Running max of E over earlier intervals (key order) that have the column; whether
    # an earlier one has it; the previous interval's flag month, so repeated months
    # give no further marks.
    s = ordered_scan(s, ["shopid"], [asc("activated_date"), asc("actual_end_date"), asc(tiebreak)],
                     bucketed,
                     _pfm=("lag", "_fm0"), **{f"_mx{i}": ("cummax_before", f"_ce{i}") for i in range(n)},
                     **{f"_had{i}": ("cummax_before", f"_has{i}") for i in range(n)})
    # rest-of-day intervals: the lowest key of those that ended earlier that day
    ended = (Window.partitionBy("shopid", "_E").orderBy(F.col("actual_end_date"), F.col("_key").desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    s = s.select("*", *[F.min(F.when(F.col("_rest") & F.col(c).isNotNull(), F.col("_key"))).over(ended).alias(f"_lo{i}")
                        for i, c in enumerate(cols)])
    starts = [F.when(~F.col("_rest"), F.greatest(a, F.col(f"_mx{i}"))) for i in range(n)]
    new_month = F.col("_pfm").isNull() | (F.col("_pfm") != F.col("_fm0"))
    first_of = [F.col(f"_had{i}").isNull() & F.col(c).isNotNull() for i, c in enumerate(cols)]
    takes_over = [F.col("_rest") & F.col(c).isNotNull() & (F.col(f"_lo{i}").isNull() | (F.col("_key") < F.col(f"_lo{i}")))
                  for i, c in enumerate(cols)]
    s = s.select("shopid", "_E", "_key", *cols, F.array(*starts).alias("_starts"),
                 F.array(*first_of).alias("_first"), F.array(*takes_over).alias("_over"),
                 F.when(F.exists(F.array(*takes_over), lambda x: x), e).alias("_rest_at"),
                 F.when(new_month, F.col("_fm0")).alias("_fm"))

    # kind, time, payload builders per kind
    mark = F.explode(F.concat(
        F.array(F.struct(F.lit(0).alias("k"), F.col("_E").alias("t")),
                F.struct(F.lit(-1).alias("k"), F.when(F.exists("_first", lambda x: x), first_ts).alias("t")),
                F.struct(F.lit(10).alias("k"), F.col("_rest_at").alias("t")),
                F.struct(F.lit(5).alias("k"), F.col("_fm").alias("t")),
                F.struct(F.lit(6).alias("k"), F.add_months("_fm", 1).cast("timestamp").alias("t"))),
        F.transform(F.array_distinct("_starts"), lambda x: F.struct(F.lit(2).alias("k"), x.alias("t"))),
    )).alias("m")
    m = s.select("shopid", "_E", "_key", "_starts", "_first", "_over", *cols, mark).where(F.col("m.t").isNotNull())
    # One SQL projection: the payload of each mark kind per column (cheap to build
    # for many columns; the segment payload only where that column's segment starts).
    q = [f"`{c}`" for c in cols]
    marks = m.selectExpr(
        "shopid", "m.t AS _t", "m.k AS _kind",
        "CASE WHEN m.k IN (0, 10) THEN _key END AS _dk",
        "CASE WHEN m.k NOT IN (0, 10) THEN _key END AS _ak",
        *[f"CASE WHEN m.k = 0 OR m.k = -1 AND _first[{i}] THEN {c} END AS _end{i}" for i, c in enumerate(q)],
        *[f"CASE WHEN m.k = 2 AND {c} IS NOT NULL AND _starts[{i}] = m.t AND m.t < _E "
          f"THEN named_struct('key', _key, 'v', {c}, 'end', _E) END AS _seg{i}" for i, c in enumerate(q)],
        *[f"CASE WHEN m.k = 10 AND _over[{i}] THEN named_struct('key', _key, 'v', {c}, 'end', _E) END AS _rst{i}"
          for i, c in enumerate(q)],
        "CASE WHEN m.k = 5 THEN m.t END AS _mf1",
        "CASE WHEN m.k = 6 THEN m.t END AS _mf2",
    )
    # A payment without a time is 999999 days from every interval, so the lowest
    # key wins: it is placed right after the mark that holds it.
    pts = points.select("*", F.coalesce(F.col(at), first_ts).alias("_t"), F.lit(9).alias("_kind"))
    u = pts.unionByName(marks, allowMissingColumns=True)

    fills = {}
    for i in range(n):
        fills[f"_fs{i}"] = ("ffill", f"_seg{i}")
        fills[f"_fr{i}"] = ("ffill", f"_rst{i}")
        fills[f"_fe{i}"] = ("ffill", f"_end{i}")
    if month_flags:
        fills["_ff1"] = ("ffill", "_mf1")
        fills["_ff2"] = ("ffill", "_mf2")
    order = [asc("_t"), asc("_kind"), desc("_dk"), asc("_ak")]
    f = ordered_scan(u, ["shopid"], order, bucketed, **fills)
    out = []
    for i, c in enumerate(cols):
        seg, rest = F.col(f"_fs{i}"), F.col(f"_fr{i}")
        inside = F.least(F.when(F.col("_t") < seg["end"], seg), F.when(F.col("_t") < rest["end"], rest))["v"]
        out.append(F.coalesce(inside, F.col(f"_fe{i}")).alias(c))
    if month_flags:
        this_month = month_start(at).cast("timestamp")
        out.append(F.coalesce(F.col("_ff1") == this_month, F.lit(False)).alias("ended_same_month"))
        out.append(F.coalesce(F.col("_ff2") == this_month, F.lit(False)).alias("ended_month_before"))
    return f.where(F.col("_kind") == 9).select(*points.columns, *out)


def matched_payments(tx_numbered: DataFrame, subs_prev: DataFrame, tiebreak: str = "cursor",
                     bucketed: bool | None = None) -> DataFrame:
    """One row per distinct payment with its ranked subscription values and neighbours."""
    return by_heat(lambda split, tx, subs: _matched(tx, subs, tiebreak, split), bucketed, "shopid",
                   tx_numbered, subs_prev)


def _matched(tx_numbered: DataFrame, subs_prev: DataFrame, tiebreak: str, bucketed: bool) -> DataFrame:
    pays = tx_numbered.select(*PAYMENT_KEYS).distinct()
    # neighbours first: they need the payments' few columns only, so narrow rows are sorted
    pays = ordered_scan(pays, ["shopid"], [asc("createdat"), asc("id"), asc("netamount"), asc("prev_netamount")],
                        bucketed, prev_day_amount=("lag", "netamount"))
    pays = ordered_scan(pays, ["shopid"],
                        [asc(F.unix_timestamp("createdat")), asc("id"), asc("netamount"), asc("prev_netamount")],
                        bucketed, next_day_amount=("lead", "netamount"))
    if bucketed:
        # hot shop: a grouped count per shop-day joined back (partial counts, no per-key task);
        # one struct key, whose equality matches NULL fields, keeps the join a plain equi-join
        pays = pays.withColumn("_sd", F.struct("shopid", F.to_date("createdat").alias("d")))
        counts = pays.groupBy(F.col("_sd").alias("_sd2")).agg(F.count("id").alias("transactions_per_day"))
        pays = cut(pays.join(counts, pays["_sd"] == counts["_sd2"]).drop("_sd", "_sd2"))
    else:
        # rows are already clustered by shop, so a (shop, day) window adds no shuffle
        per_day = Window.partitionBy("shopid", F.to_date("createdat"))
        pays = pays.withColumn("transactions_per_day", F.count("id").over(per_day))
    near = nearest_interval(pays, subs_prev, ATTR_COLS, "createdat", tiebreak, bucketed, month_flags="prev_actual_end_date")
    return near.select(*PAYMENT_KEYS, *ATTR_COLS, "ended_same_month", "ended_month_before",
                       "prev_day_amount", "next_day_amount", "transactions_per_day")


def choose_attribution(matched: DataFrame) -> DataFrame:
    """Take the previous subscription's values on a same-amount repeat after a month change."""
    hit = F.coalesce(
        (F.col("transactions_per_day") > 1)
        & ((F.col("ended_same_month") & (F.col("netamount") == F.col("prev_day_amount")))
           | (F.col("ended_month_before") & (F.col("netamount") != F.col("next_day_amount")))),
        F.lit(False))
    chosen = [F.when(hit & F.col(p).isNotNull(), F.col(p)).otherwise(F.col(c)).alias(c) for c, p in CHOSEN]
    return matched.select("createdat", "id", "_id", "netamount", "prev_netamount", "next_day_amount", "shopid",
                    "transactions_per_day", *chosen)


def label_sales(chosen: DataFrame) -> DataFrame:
    """Sale-type label, month and final column types."""
    return chosen.select(
        "createdat", month_start("createdat").alias("month"), "id", "_id", "netamount", "prev_netamount",
        "next_day_amount", "shopid", "transactions_per_day",
        sale_label("id", "pricing_plan").cast("string").alias("pricing_plan"),
        F.col("chargeamount").cast("double").alias("chargeamount"),
        F.to_date("activated_date").alias("activated_date"),
        F.to_date("actual_end_date").alias("actual_end_date"),
    )


def carry_forward(labelled: DataFrame, bucketed: bool | None = None) -> DataFrame:
    """Same net amount as the previous payment -> previous row's plan, amount and dates (one step)."""
    return by_heat(_carry_forward, bucketed, "shopid", labelled)


def _carry_forward(bucketed: bool, labelled: DataFrame) -> DataFrame:
    keep = ("pricing_plan", "chargeamount", "activated_date", "actual_end_date")
    lagged = ordered_scan(labelled, ["shopid"], _id_order(), bucketed,
                          **{f"_p_{c}": ("lag", c) for c in keep})
    same = F.col("netamount") == F.col("prev_netamount")
    cf = lagged.select(
        "createdat", "month", "id", "_id", "netamount", "prev_netamount", "next_day_amount", "shopid",
        "transactions_per_day",
        *[F.when(same, F.col(f"_p_{c}")).otherwise(F.col(c)).alias(c) for c in keep])
    return ordered_scan(cf, ["shopid"], _id_order(), bucketed,
                        prev_pricing_plan=("lag", "pricing_plan"), prev_chargeamount=("lag", "chargeamount"))


def attribute_transactions(tx: DataFrame, subs: DataFrame, shop=None, tiebreak: str = "cursor",
                           bucketed: bool | None = None) -> DataFrame:
    """Full job: every payment with its plan, amount, interval and previous plan/amount.

    ``bucketed=None`` counts the rows of each shop once: shops with more payments
    or intervals than the hot-key threshold are scanned in buckets, with their
    stages written between the scans; all other shops by plain windows.
    """
    def job(split: bool, x: DataFrame, y: DataFrame) -> DataFrame:
        t = cut(numbered_transactions(x, shop, split), split)
        s = cut(with_previous(y, tiebreak, split), split)
        matched = cut(matched_payments(t, s, tiebreak, split), split)
        return carry_forward(label_sales(choose_attribution(matched)), split)
    subs = subs if shop is None else subs.where(F.col("shopid") == F.lit(shop))
    return by_heat(job, bucketed, "shopid", tx, subs)


def attribute_from_events(tx: DataFrame, events: DataFrame, as_of=None, shop=None) -> DataFrame:
    """The full job from charge events: hot shops are found in the inputs, before anything is computed."""
    def job(split: bool, x: DataFrame, ev: DataFrame) -> DataFrame:
        return attribute_transactions(x, timeline_intervals(ev, as_of, shop, bucketed=split), shop, bucketed=split)
    return by_heat(job, None, "shopid", tx, events, checks=(tx, events.where(subscription_event("eventtype"))))
