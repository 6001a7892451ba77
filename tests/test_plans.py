"""Plan shape and result properties that must hold at any scale."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SMALL
from subledger import fixtures as fx
from subledger.operators import active, mrr, timeline


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["tx_attributed", "daily_active", "daily_active_sweep",
                                  "store_daily_active", "timeline_intervals", "mrr_monthly"])
def test_no_pairs_no_quadratic_frames(spark, name):
    plan = _plan(E.queries()[name](spark, SMALL))
    assert "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan
    # a frame from the current row to the end is re-evaluated per row
    assert not re.search(r"currentrow\$\(\), unboundedfollowing\$\(\)", plan)


def test_attribution_exchange_budget(spark):
    plan = _plan(E.queries()["tx_attributed"](spark, SMALL))
    assert plan.count("Exchange hashpartitioning") <= 6


def _formatted(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_scan_pushdown_and_pruning(spark, tmp_path):
    path = str(tmp_path / "events")
    fx.subscription_events(spark, SMALL).write.parquet(path)
    df = timeline.timeline_intervals(spark.read.parquet(path), dt.date(2024, 2, 20))
    plan = _formatted(df)
    assert "StringContains(eventtype,SUBSCRIPTION)" in plan
    assert "IsNotNull(shopid)" in plan
    # the MRR job reads 4 of the 6 order columns
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", _formatted(E.queries()["mrr_monthly"](spark, SMALL)))
    assert schemas and all("o_orderpriority" not in s and "o_orderstatus" not in s for s in schemas)


def test_mrr_components_add_up(spark):
    tx = fx.order_payments(spark, SMALL)
    rev = mrr.revenue_by_month(tx).agg(F.sum("revenue")).first()[0]
    parts = mrr.mrr_components(mrr.revenue_by_month(tx))
    total = parts.agg(F.sum(F.col("new_mrr") + F.col("mrr") + F.col("expansion_mrr"))).first()[0]
    assert total == rev


def test_explode_equals_sweep_and_bounded_by_shops(spark):
    iv = fx.order_intervals(spark, SMALL)
    a = active.merchants_by_day(iv, fx.ORDERS_AS_OF, method="explode")
    b = active.merchants_by_day(iv, fx.ORDERS_AS_OF, method="sweep")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    shops = iv.select("shopid").distinct().count()
    assert a.agg(F.max("merchants")).first()[0] <= shops


def test_fixture_reaches_every_sale_label(spark):
    from subledger import schemas as S
    found = {r[0] for r in E.queries()["tx_labelled"](spark, SMALL).select("pricing_plan").distinct().collect()}
    assert {label for _, _, label in S.SALE_LABEL_RULES} <= found and S.FREE_PLAN_LABEL in found


def test_each_payment_once(spark):
    df = E.queries()["tx_attributed"](spark, SMALL)
    assert df.count() == df.select("id").distinct().count() == fx.payments(spark, SMALL).count()


def test_only_hot_shops_take_the_bucketed_path(spark):
    """With the threshold between the shops' sizes both paths run; the result is that of the plain one."""
    from subledger.functions.scan import hot_keys
    from subledger.operators import attribution as A
    pay, ev = fx.payments(spark, SMALL), fx.subscription_events(spark, SMALL)
    plain = A.attribute_transactions(pay, timeline.timeline_intervals(ev, fx.EVENTS_AS_OF, bucketed=False),
                                     bucketed=False)
    sizes = sorted(r["count"] for r in ev.groupBy("shopid").count().collect())
    spark.conf.set("subledger.scan.hotKeyRows", str(sizes[len(sizes) // 2]))
    try:
        hot = hot_keys("shopid", pay, ev)
        assert 0 < hot.count() < len(sizes)
        mixed = A.attribute_from_events(pay, ev, fx.EVENTS_AS_OF)
        assert sorted(map(str, mixed.collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.unset("subledger.scan.hotKeyRows")


def test_single_shop_filter_equals_full_run(spark):
    """P10: the shop parameter gives the shop's rows of the full run (filter below the windows)."""
    from subledger.operators import attribution as A
    ev, pay = fx.subscription_events(spark, SMALL), fx.payments(spark, SMALL)
    shop = pay.select("shopid").first()["shopid"]
    full = timeline.timeline_intervals(ev, fx.EVENTS_AS_OF)
    one = timeline.timeline_intervals(ev, fx.EVENTS_AS_OF, shop=shop)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, full.where(F.col("shopid") == shop).collect()))
    att_full = A.attribute_transactions(pay, full).where(F.col("shopid") == shop)
    att_one = A.attribute_transactions(pay, one, shop=shop)
    assert sorted(map(tuple, att_one.collect())) == sorted(map(tuple, att_full.collect()))
    assert "isnotnull(user_id)" in _plan(one).lower() or "user_id" in _plan(one)
