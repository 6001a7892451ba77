"""Ordered scans per key that never put one whole key into one task.

``Window.partitionBy(key).orderBy(t)`` sends every row of a key to one task;
a key holding a third of the data would make that task a third of the job.
``ordered_scan`` computes the same lag / lead / fills / running aggregates in
two levels:

1. the window runs per ``(key, bucket)``, where ``bucket`` never decreases
   along the order (equal shares of the sorted rows, or any column with that
   property), so a hot key is spread over many tasks;
2. each bucket is summarised by its first and last row (one row per bucket),
   a window over those few summary rows per key carries values across bucket
   boundaries, and the carry is joined back on ``(key, bucket)``. One struct
   column holds ``(key, bucket)`` for the window, the summary and the join, so
   the rows are shuffled once and only the carry table moves for the join.

Results equal the single-level window exactly when ``bucket`` never decreases
along the order. Summary rows per key are bounded by the bucket count, not by
the rows of the key. ``bucket=None`` runs the plain single-level window: the
jobs use it for all keys below a threshold (``by_heat`` sends only the keys
above it through buckets), and for inputs bounded per key anyway (one row per
shop and month).

Output kinds (``name=(kind, column)``):
  lag, lead            value of the previous / next row (NULLs included)
  ffill                last non-NULL value up to and including this row
  bfill                first non-NULL value from this row on (computed as a
                       backward fill over the reversed order: frames that end
                       at UNBOUNDED FOLLOWING are re-evaluated per row)
  first_nonnull        first non-NULL value from the start up to this row
  cummax, cumsum       running max / sum up to and including this row
  cummax_before        running max over the rows strictly before this row
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut

UNB = Window.unboundedPreceding


@dataclass(frozen=True)
class Ord:
    """One sort key: column, direction and NULL placement."""
    col: str | Column
    asc: bool = True
    nulls_last: bool = True

    def sort(self, reverse: bool = False) -> Column:
        c = F.col(self.col) if isinstance(self.col, str) else self.col
        asc, nl = (not self.asc, not self.nulls_last) if reverse else (self.asc, self.nulls_last)
        if asc:
            return c.asc_nulls_last() if nl else c.asc_nulls_first()
        return c.desc_nulls_last() if nl else c.desc_nulls_first()


def asc(col, nulls_last: bool = True) -> Ord:
    return Ord(col, True, nulls_last)


def desc(col, nulls_last: bool = True) -> Ord:
    return Ord(col, False, nulls_last)


# Rows per bucket of a split scan (session conf; default in brackets):
#   subledger.scan.bucketRows   [100000]
BUCKET_ROWS_CONF = "subledger.scan.bucketRows"
DEFAULT_BUCKET_ROWS = 100_000


def sorted_buckets(df: DataFrame, keys: list[str], order: list[Ord]) -> tuple[DataFrame, Column]:
    """``df`` sorted by key and order and written, and buckets of so many rows along that order.

    A row's place is its sorted partition and position there, so the number of
    buckets follows a key's rows, whatever their values: rows of one day, or
    without an order value, are cut like any others.
    """
    rows = int(df.sparkSession.conf.get(BUCKET_ROWS_CONF, str(DEFAULT_BUCKET_ROWS)))
    placed = cut(df.orderBy(*keys, *[o.sort() for o in order]).withColumn("_place", F.monotonically_increasing_id()))
    return placed, F.floor(F.col("_place") / F.lit(rows))


def _local(kind: str, c: Column, w, back, rback, before) -> Column:
    if kind == "lag":
        return F.lag(c).over(w)
    if kind == "lead":
        return F.lead(c).over(w)
    if kind == "ffill":
        return F.last(c, ignorenulls=True).over(back)
    if kind == "bfill":
        return F.last(c, ignorenulls=True).over(rback)
    if kind == "first_nonnull":
        return F.first(c, ignorenulls=True).over(back)
    if kind == "cummax":
        return F.max(c).over(back)
    if kind == "cumsum":
        return F.sum(c).over(back)
    if kind == "cummax_before":
        return F.max(c).over(before)
    raise ValueError(f"unknown scan kind: {kind}")


def ordered_scan(df: DataFrame, keys: list[str], order: list[Ord], bucket: Column | bool | None = None,
                 **outputs: tuple[str, str | Column]) -> DataFrame:
    """``df`` plus one column per output, computed over ``keys`` in ``order``.

    ``bucket`` is a column that never decreases along the order, ``True`` for
    buckets of equal size (``sorted_buckets``), or nothing for the plain window.
    """
    if bucket is True:
        placed, bucket = sorted_buckets(df, keys, order)
        return ordered_scan(placed, keys, order, bucket, **outputs).drop("_place")
    if bucket is False:
        bucket = None
    specs = {n: (k, F.col(c) if isinstance(c, str) else c) for n, (k, c) in outputs.items()}
    fwd = [o.sort() for o in order]
    rev = [o.sort(reverse=True) for o in order] if any(k == "bfill" for k, _ in outputs.values()) else []
    kinds = {k for k, _ in specs.values()}
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*fwd)
        back = w.rowsBetween(UNB, 0)
        before = w.rowsBetween(UNB, -1) if "cummax_before" in kinds else None
        rback = Window.partitionBy(*keys).orderBy(*rev).rowsBetween(UNB, 0) if "bfill" in kinds else None
        local = [_local(k, c, w, back, rback, before).alias(n) for n, (k, c) in specs.items()]
        return df.select("*", *local)

    # One struct column (keys..., bucket) partitions the window, groups the
    # summary and joins the carry back, so the rows are shuffled once: the join
    # reuses the window's partitioning and only the small carry table moves.
    # Struct equality matches NULL fields, so NULL keys keep their carry.
    kf = [f"k{i}" for i in range(len(keys))]
    src = df.withColumn("_pk", F.struct(*[F.col(k).alias(f) for k, f in zip(keys, kf)], bucket.alias("b")))
    w = Window.partitionBy("_pk").orderBy(*fwd)
    back = w.rowsBetween(UNB, 0)
    before = w.rowsBetween(UNB, -1) if "cummax_before" in kinds else None
    rback = Window.partitionBy("_pk").orderBy(*rev).rowsBetween(UNB, 0) if "bfill" in kinds else None
    local = [_local(k, c, w, back, rback, before).alias(f"_l_{n}") for n, (k, c) in specs.items()]
    x = src.select("*", F.lag(F.lit(1)).over(w).isNull().alias("_sf"),
                   F.lead(F.lit(1)).over(w).isNull().alias("_sl"), *local)

    def at(flag: str, c: Column) -> Column:
        return F.first(F.when(F.col(flag), F.struct(c.alias("v"))), ignorenulls=True)

    aggs = []
    for n, (k, c) in specs.items():
        lc = F.col(f"_l_{n}")
        if k == "lag":
            aggs.append(at("_sl", c).alias(f"_s_{n}"))
        elif k == "lead":
            aggs.append(at("_sf", c).alias(f"_s_{n}"))
        elif k == "bfill":
            aggs.append(at("_sf", lc).alias(f"_s_{n}"))
        elif k == "cumsum":
            aggs.append(F.struct(F.sum(c).alias("v")).alias(f"_s_{n}"))
        elif k == "cummax_before":
            aggs.append(F.struct(F.max(c).alias("v")).alias(f"_s_{n}"))
        else:  # ffill, first_nonnull, cummax: the local value at the bucket's last row
            aggs.append(at("_sl", lc).alias(f"_s_{n}"))
    summary = x.groupBy("_pk").agg(*aggs)

    # buckets ascend along the order; NULL buckets sit where the order puts NULLs
    nl = order[0].nulls_last
    b = F.col("_pk")["b"]
    by_key = Window.partitionBy(*[F.col("_pk")[f] for f in kf])
    ws = by_key.orderBy(b.asc_nulls_last() if nl else b.asc_nulls_first())
    wsr = by_key.orderBy(b.desc_nulls_first() if nl else b.desc_nulls_last())
    prior = ws.rowsBetween(UNB, -1)
    carry = []
    for n, (k, _) in specs.items():
        s = F.col(f"_s_{n}")
        if k == "lag":
            v = F.lag(s).over(ws)["v"]
        elif k == "lead":
            v = F.lead(s).over(ws)["v"]
        elif k == "ffill":
            v = F.last(s["v"], ignorenulls=True).over(prior)
        elif k == "bfill":
            v = F.last(s["v"], ignorenulls=True).over(wsr.rowsBetween(UNB, -1))
        elif k == "first_nonnull":
            v = F.first(s["v"], ignorenulls=True).over(prior)
        elif k in ("cummax", "cummax_before"):
            v = F.max(s["v"]).over(prior)
        else:  # cumsum
            v = F.sum(s["v"]).over(prior)
        carry.append(v.alias(f"_c_{n}"))
    carried = summary.select(F.col("_pk").alias("_ck"), *carry)
    j = x.join(carried, x["_pk"] == carried["_ck"], "left")

    final = []
    for n, (k, _) in specs.items():
        lc, cc = F.col(f"_l_{n}"), F.col(f"_c_{n}")
        if k == "lag":
            v = F.when(F.col("_sf"), cc).otherwise(lc)
        elif k == "lead":
            v = F.when(F.col("_sl"), cc).otherwise(lc)
        elif k in ("ffill", "bfill"):
            v = F.coalesce(lc, cc)
        elif k == "first_nonnull":
            v = F.coalesce(cc, lc)
        elif k in ("cummax", "cummax_before"):
            v = F.greatest(lc, cc)
        else:  # a running sum is NULL only while every value so far is NULL
            v = F.when(lc.isNull() & cc.isNull(), F.lit(None)) \
                 .otherwise(F.coalesce(lc, F.lit(0)) + F.coalesce(cc, F.lit(0)))
        final.append(v.alias(n))
    return j.select(*[F.col(c) for c in df.columns], *final)


# Keys with more rows than this are split into buckets; set the session conf
# to 0 to always split, or raise it on clusters with large executors.
HOT_KEY_CONF = "subledger.scan.hotKeyRows"
DEFAULT_HOT_KEY_ROWS = 1_000_000


def hot_key_rows(spark) -> int:
    return int(spark.conf.get(HOT_KEY_CONF, str(DEFAULT_HOT_KEY_ROWS)))


def hot_keys(key: str, *frames: DataFrame, threshold: int | None = None) -> DataFrame | None:
    """The values of ``key`` (as ``_hot``) that hold more than ``threshold`` rows of a frame; ``None`` if there are none.

    One grouped count per frame, which reads the key column and aggregates
    map-side; the hot values themselves stay in a small written table.
    """
    t = hot_key_rows(frames[0].sparkSession) if threshold is None else threshold
    found = None
    for df in frames:
        own = (df.groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
               .where(F.col("_n") > t).select("_hot"))
        found = own if found is None else found.union(own)
    found = found.distinct()
    # mostly there are none: one job, nothing written
    return None if found.isEmpty() else cut(found)


def by_heat(job, bucketed: bool | None, key: str, *frames: DataFrame, checks=()) -> DataFrame:
    """``job(bucketed, *frames)``, with only the hot keys on the bucketed path.

    Given ``bucketed``, everything takes that path. Otherwise the rows of hot
    keys are scanned in buckets and all other keys by plain windows; the two results
    are disjoint by key. ``checks`` (default the frames) are what the keys are counted
    in: pass the job's raw inputs, which hold at least as many rows of a key, when
    the frames are computed, since the count runs all that lies before it.
    """
    if bucketed is not None:
        return job(bucketed, *frames)
    hot = hot_keys(key, *(checks or frames))
    if hot is None:
        return job(False, *frames)

    def part(df: DataFrame, how: str) -> DataFrame:
        return df.join(hot, df[key].eqNullSafe(hot["_hot"]), how)
    return job(False, *[part(df, "left_anti") for df in frames]).unionByName(
        job(True, *[part(df, "left_semi") for df in frames]))
