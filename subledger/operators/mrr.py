"""Monthly recurring revenue waterfall (new / retained / expansion / contraction / churn).

Plan shape: one partial+final aggregate per (shop, month) shrinks the payments
to at most one row per shop-month before anything else shuffles; every later
step (lag over months, last month per shop, monthly sums) works on that small
table, so no step sees a whole shop's raw payments at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.scalar import as_of_date, month_start


def _zero():
    return F.lit(0).cast(S.MONEY_SUM)


def revenue_by_month(tx: DataFrame) -> DataFrame:
    """SUM(netamount) per (month, shopid); amounts become exact before the sum, whatever their type."""
    return (tx.groupBy(month_start("createdat").alias("month"), "shopid")
            .agg(F.sum(F.col("netamount").cast(S.MONEY)).cast(S.MONEY_SUM).alias("revenue")))


_COLUMNS = ("month", "shopid", "revenue", "prev_month_revenue", "new_mrr", "mrr",
            "expansion_mrr", "contraction_mrr", "churn_mrr")


def mrr_components(rev: DataFrame, keep=()) -> DataFrame:
    """Lag to the previous *present* month of the shop, then classify the movement.

    The window sees one row per (shop, month), so even the largest shop is
    bounded by its number of months.
    """
    w = Window.partitionBy("shopid").orderBy(F.col("month").asc_nulls_last())
    prev = F.lag("revenue").over(w)
    r = rev.withColumn("prev_month_revenue", prev)
    revenue, p = F.col("revenue"), F.col("prev_month_revenue")
    return r.select(
        "month", "shopid", "revenue", "prev_month_revenue", *keep,
        F.when(p.isNull(), revenue).otherwise(_zero()).alias("new_mrr"),
        F.when(revenue == p, revenue).when(revenue > p, p).when(revenue < p, revenue)
         .otherwise(_zero()).alias("mrr"),
        F.when(revenue > p, revenue - p).otherwise(_zero()).cast(S.MONEY_SUM).alias("expansion_mrr"),
        F.when(revenue < p, revenue - p).otherwise(_zero()).cast(S.MONEY_SUM).alias("contraction_mrr"),
        _zero().alias("churn_mrr"),
    )


def shop_last_month(shop_rev: DataFrame) -> DataFrame:
    """Last present month of each shop and its retained revenue (an aggregate, no window)."""
    return (shop_rev.where(F.col("month").isNotNull()).groupBy("shopid")
            .agg(F.max("month").alias("final_month"),
                 F.max_by("mrr", "month").alias("final_mrr")))


def mrr_shop_month(tx: DataFrame, as_of=None) -> DataFrame:
    """Per shop and month: revenue, previous revenue and the five components.

    The window that finds the previous month also flags each shop's last month,
    and a generator emits that month's row plus a synthetic row for the month
    after it, which churns the retained revenue; churn is zero when that month
    is the as-of month or the one after. Payments without a time form a NULL
    month, which is never a shop's last: a shop has one churn row, and none if
    all its payments lack a time.
    """
    rev = revenue_by_month(tx)
    w = Window.partitionBy("shopid").orderBy(F.col("month").asc_nulls_last())
    final = F.col("month").isNotNull() & F.lead("month").over(w).isNull()
    comp = mrr_components(rev.withColumn("_final", final), keep=("_final",))
    this_month = F.trunc(as_of_date(as_of), "month")
    nxt = F.add_months("month", 1)
    actual = F.struct(*[F.col(c) for c in _COLUMNS])
    churn = F.struct(
        nxt.alias("month"), F.col("shopid"), _zero().alias("revenue"),
        F.lit(None).cast(S.MONEY_SUM).alias("prev_month_revenue"),
        _zero().alias("new_mrr"), _zero().alias("mrr"), _zero().alias("expansion_mrr"),
        _zero().alias("contraction_mrr"),
        F.when((nxt == this_month) | (nxt == F.add_months(this_month, 1)), _zero())
         .otherwise(-F.col("mrr")).cast(S.MONEY_SUM).alias("churn_mrr"))
    rows = F.when(F.col("_final"), F.array(actual, churn)).otherwise(F.array(actual))
    return comp.select(F.explode(rows).alias("r")).select("r.*")


def mrr_monthly(tx: DataFrame, as_of=None) -> DataFrame:
    """Monthly totals of the five components, ordered by month."""
    today = as_of_date(as_of)
    by_month = (mrr_shop_month(tx, as_of).groupBy("month").agg(
        F.sum("mrr").cast(S.MONEY_SUM).alias("mrr"),
        F.sum("new_mrr").cast(S.MONEY_SUM).alias("new_mrr"),
        F.sum("expansion_mrr").cast(S.MONEY_SUM).alias("expansion_mrr"),
        F.sum("contraction_mrr").cast(S.MONEY_SUM).alias("contraction_mrr"),
        F.sum("churn_mrr").cast(S.MONEY_SUM).alias("churn_sum"),
    ))
    m = F.col("month")
    # The second test compares with the untruncated date + 1 month (true only on day 1).
    zero_churn = (m == F.trunc(today, "month")) | (m == F.add_months(today, 1))
    # one row per month (bounded by the calendar): sort it in one partition rather
    # than range-partition it, which would cost a sampling job
    return (by_month
            .withColumn("churn_mrr", F.when(zero_churn, _zero()).otherwise(F.col("churn_sum")))
            .drop("churn_sum")
            .repartition(1)
            .sortWithinPartitions("month"))


def cumulative_revenue(tx: DataFrame) -> DataFrame:
    """Running revenue per shop over its months (rows up to the current one)."""
    rev = revenue_by_month(tx)
    w = (Window.partitionBy("shopid").orderBy(F.col("month").asc_nulls_last())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rev.withColumn("total_revenue_overtime", F.sum("revenue").over(w).cast(S.MONEY_SUM))
