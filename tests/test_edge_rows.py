"""Hand-made rows for the cases the driver tables do not reach."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger import schemas as S
from subledger.functions.scalar import decode_key, numeric_id, sanitize, sale_label
from subledger.operators import attribution, mrr, timeline
from subledger.operators.curate import convert_datetimes, curate_all
from subledger.sources import arrivals, pages, raw, sinks

D = dt.datetime
EV_SCHEMA = T.StructType([
    T.StructField("eventtype", T.StringType()), T.StructField("occurredat", T.TimestampType()),
    T.StructField("shopdomain", T.StringType()), T.StructField("shopid", T.LongType()),
    T.StructField("chargeamount", T.DecimalType(18, 2)), T.StructField("chargeid", T.StringType()),
    T.StructField("chargename", T.StringType()), T.StructField("cursor", T.StringType()),
])
TX_SCHEMA = T.StructType([
    T.StructField("createdat", T.TimestampType()), T.StructField("id", T.StringType()),
    T.StructField("chargeid", T.StringType()), T.StructField("netamount", T.DecimalType(18, 2)),
    T.StructField("shopid", T.LongType()),
])
AS_OF = dt.date(2024, 2, 1)


def _events(spark):
    m = Decimal("9.99")
    rows = [
        ("SUBSCRIPTION_CHARGE_ACTIVATED", D(2024, 1, 1, 10), "s1", 1, m, "c1", "Pro", "01"),
        ("SUBSCRIPTION_CHARGE_FROZEN", D(2024, 1, 5), "s1", 1, m, "c1", "Pro", "02"),
        ("SUBSCRIPTION_CHARGE_UNFROZEN", D(2024, 1, 10), "s1", 1, m, "c1", "Enterprise, annual", "03"),
        ("SUBSCRIPTION_CHARGE_CANCELED", D(2024, 1, 20), "s1", 1, m, "c1", "Pro", "04"),
        ("SUBSCRIPTION_CHARGE_ACTIVATED", D(2024, 1, 25), "s1", 1, Decimal("0.00"), "c2", "Free plan", "05"),
        ("SUBSCRIPTION_CHARGE_ACTIVATED", D(2024, 1, 3), "x", None, m, "c9", "Pro", "06"),
        ("RELATIONSHIP_INSTALLED", D(2024, 1, 2), "s1", 1, m, "c1", "Pro", "07"),
    ]
    return spark.createDataFrame(rows, EV_SCHEMA)


def test_timeline_ties_freeze_and_labels(spark):
    got = sorted(timeline.timeline_intervals(_events(spark), AS_OF).collect(), key=lambda r: r["cursor"])
    assert [r["cursor"] for r in got] == ["01", "03", "05"]  # NULL shop and non-start events dropped
    first, unfrozen, free = got
    # tied start: the ACTIVATED row ends at the tied start (zero length), the UNFROZEN row spans on
    assert first["activated_date"] == D(2024, 1, 1, 10) and first["actual_end_date"] == D(2024, 1, 1, 10)
    assert unfrozen["activated_date"] == D(2024, 1, 1, 10) and unfrozen["actual_end_date"] == D(2024, 1, 20)
    assert unfrozen["pricing_plan"] == "Enterprise, annual"  # comma kept whole
    assert free["pricing_plan"] == "Unlimited Blog posts"
    assert free["actual_end_date"] == D(2024, 2, 2)  # open: as_of + 1 day


def test_numeric_id_and_labels(spark):
    df = spark.createDataFrame(
        [("gid://x/AppSubscriptionSale/12",), ("gid://x/AppSaleCredit/99999999999",), ("no-digits",)], ["id"])
    got = [r[0] for r in df.select(numeric_id("id")).collect()]
    assert got == [12, 99999999999, None]
    lab = spark.createDataFrame([
        ("a/AppOneTimeSale/1", "Pro"), ("a/AppSaleAdjustment/2", None), ("a/AppSaleAdjustment/3", "Pro"),
        ("a/AppSubscriptionSale/4", None), ("a/AppSaleCredit/5", "Pro"), ("a/AppSubscriptionSale/6", "Pro"),
    ], "id string, plan string")
    assert [r[0] for r in lab.select(sale_label("id", "plan")).collect()] == [
        "App One Time Sale", "Undefined refund", "Pro", "Undefined transactions", "App Sale Credit", "Pro"]


def test_attribution_edges(spark):
    subs = timeline.timeline_intervals(_events(spark), AS_OF)
    tx = spark.createDataFrame([
        (D(2024, 1, 12), "gid://p/AppSubscriptionSale/100", "c1", Decimal("10.00"), 1),
        (D(2024, 1, 13), "gid://p/AppSubscriptionSale/101", "c1", Decimal("10.00"), 1),   # repeat -> carry
        (D(2024, 1, 26), "gid://p/AppSubscriptionSale/102", "c2", Decimal("5.00"), 1),
        (D(2024, 1, 14), "gid://p/AppSubscriptionSale/103", "c7", Decimal("7.00"), 2),    # no subscription
        (D(2024, 1, 15), "gid://p/AppSaleAdjustment/104", "c7", Decimal("-7.00"), 2),
        (D(2024, 1, 15), "gid://p/AppSubscriptionSale/noid", "c7", Decimal("1.00"), 2),
    ], TX_SCHEMA)
    out = {r["id"].rsplit("/", 1)[1]: r for r in attribution.attribute_transactions(tx, subs).collect()}
    assert len(out) == 6  # every payment once
    assert out["100"]["pricing_plan"] == "Enterprise, annual"
    assert out["101"]["pricing_plan"] == out["100"]["pricing_plan"]
    assert out["102"]["pricing_plan"] == "Unlimited Blog posts"
    assert out["103"]["pricing_plan"] == "Undefined transactions"
    assert out["104"]["pricing_plan"] == "Undefined refund"
    assert out["noid"]["_id"] is None
    assert out["101"]["prev_pricing_plan"] == "Enterprise, annual"


def test_mrr_month_gap_and_single_month(spark):
    tx = spark.createDataFrame([
        (D(2024, 1, 5), "a/1", "c", Decimal("100.00"), 1),
        (D(2024, 3, 5), "a/2", "c", Decimal("150.00"), 1),   # gap: compared with January
        (D(2024, 1, 9), "a/3", "c", Decimal("40.00"), 2),    # single month
    ], TX_SCHEMA)
    rows = {(r["shopid"], r["month"]): r for r in mrr.mrr_shop_month(tx, dt.date(2024, 6, 15)).collect()}
    march = rows[(1, dt.date(2024, 3, 1))]
    assert march["prev_month_revenue"] == Decimal("100.00") and march["expansion_mrr"] == Decimal("50.00")
    assert rows[(1, dt.date(2024, 4, 1))]["churn_mrr"] == Decimal("-100.00")
    assert rows[(2, dt.date(2024, 2, 1))]["churn_mrr"] == Decimal("0.00")  # D7: one month churns 0


def test_arrival_keys(spark):
    keys = ["mongodb/db-coll/dt%3D2024-03-20/file+1.json", "mongodb/db-coll/file.json",
            "other/db-coll/dt=2024-03-20/f.json", "mongodb/dbcoll/dt=2024-03-20/f.json"]
    df = spark.createDataFrame([(k, 1) for k in keys], "key string, size long")
    got = arrivals.parse_arrivals(df).collect()
    a, b, c, d = got
    assert a["decoded_key"] == "mongodb/db-coll/dt=2024-03-20/file+1.json"
    assert (a["object_prefix"], a["partition_value"], a["database"], a["collection"], a["status"]) == \
           ("mongodb-db-coll", "2024-03-20", "db", "coll", "Success")
    assert b["partition_value"] is None and b["object_prefix"] == "mongodb-db-coll-file.json"
    assert c["status"] == "Error" and c["message"].startswith(S.MSG_OTHER_KEY)
    assert d["status"] == "Error" and d["message"] == S.MSG_NO_COLLECTION


def test_unreadable_notifications_give_error_rows(spark):
    docs = spark.createDataFrame([("not json",), ('{"Records": []}',), (None,),
                                  ('{"Records": [{"s3": {"object": {"key": "mongodb/a-b/100%zz"}}}]}',)], "json string")
    got = arrivals.parse_arrivals(arrivals.read_notifications(docs)).collect()
    assert sorted((r["status"], r["decoded_key"]) for r in got) == [
        ("Error", ""), ("Error", ""), ("Error", ""), ("Success", "mongodb/a-b/100%zz")]


def test_sanitize_and_decode(spark):
    df = spark.createDataFrame([("a\r\nb\nc\rd", "x%2By+z")], "t string, k string")
    r = df.select(sanitize("t").alias("s"), decode_key("k").alias("d")).first()
    assert r["s"] == "a  b c d" and r["d"] == "x+y+z"


def test_pages_missing_path_and_defaults(spark):
    docs = spark.createDataFrame([
        ('{"data":{"transactions":{"edges":[{"cursor":"c1","node":{"createdAt":"2024-01-01T00:00:00Z",'
         '"id":"gid://x/AppSubscriptionSale/1","netAmount":{"amount":"5.5"}}}]}}}',),
        ('{"data":{"somethingElse":{}}}',),
    ], ["json"])
    edges, bad = pages.read_pages(docs, "transactions")
    assert bad.count() == 1
    from subledger.operators.flatten import flatten_transactions
    r = flatten_transactions(edges).first()
    assert (r["chargeId"], r["grossAmount"], r["currencyCode"], r["netAmount"], r["shopID"], r["shopifyFee"]) == \
           ("null", 0.0, "", 5.5, "", 0.0)
    with pytest.raises(pages.PageShapeError):
        pages.read_pages(docs, "transactions", on_missing="raise")
    with pytest.raises(ValueError):
        pages.read_pages(docs, "orders")


def test_curate_guard_and_bad_day(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z", dt.date(2024, 1, 1)),
                                ("not a time", dt.date(2024, 1, 2)),
                                ("2024-01-02T05:00:00Z", dt.date(2024, 1, 2))], "occurredAt string, dt date")
    with pytest.raises(ValueError):
        sinks.require_timestamp(df)
    assert isinstance(convert_datetimes(df).schema["occurredAt"].dataType, T.TimestampType)
    good, report = curate_all(df)
    rep = {r["dt"]: (r["rows"], r["bad_rows"], r["ok"]) for r in report.collect()}
    assert rep == {dt.date(2024, 1, 1): (1, 0, True), dt.date(2024, 1, 2): (2, 1, False)}
    assert good.count() == 1


def test_landing_keeps_every_row(spark, tmp_path):
    from subledger.operators.landing import ingest_pages
    base = str(tmp_path / "tx")

    def page(*rows):
        edges = ",".join('{"cursor":"%s","node":{"id":"x/1"%s}}' % (c, f',"createdAt":"{t}"' if t else "")
                         for c, t in rows)
        return ('{"data":{"transactions":{"edges":[' + edges + "]}}}",)
    as_of = dt.date(2024, 1, 9)

    def land(*docs, **more):
        ingest_pages(spark, spark.createDataFrame(list(docs), "json string"), "transactions", base, as_of, **more)
        return sorted(r["cursor"] for r in spark.read.parquet(base).collect())
    day = "2024-01-08T01:00:00Z"
    assert land(page(("c1", day), ("c2", day))) == ["c1", "c2"]
    assert land(page(("c3", day)), page()) == ["c1", "c2", "c3"]
    with pytest.raises(pages.PageShapeError):
        land(page(("c4", day)), ("{}",))
    assert land(page(("c4", day), ("c5", None)), ("{}",), ("broken",), (None,), on_missing="quarantine") == [
        "c1", "c2", "c3", "c4"]
    held = spark.read.parquet(base + "-quarantine")
    assert sorted((r["reason"], r["json"]) for r in held.collect())[:3] == [
        ("no edges", ""), ("no edges", "broken"), ("no edges", "{}")]
    assert held.where("reason = 'no time'").count() == 1


def test_curate_rows_without_a_day_and_names(spark, tmp_path):
    from subledger.operators.curate import curate
    base, out = str(tmp_path / "raw"), str(tmp_path / "cur")
    rows = [("2024-01-01T01:00:00Z", "a", dt.date(2024, 1, 1)), ("never", "b", None), ("2024-01-02T01:00:00Z", "c", None)]
    spark.createDataFrame(rows, "occurredAt string, shopId string, dt date").write.partitionBy("dt").parquet(base)
    report = {r["dt"]: (r["rows"], r["bad_rows"], r["ok"]) for r in curate(spark, base, out).collect()}
    assert report == {dt.date(2024, 1, 1): (1, 0, True), None: (2, 1, False)}
    kept = spark.read.parquet(out)
    assert kept.columns == ["occurredat", "shopid", "dt"] and [r["shopid"] for r in kept.collect()] == ["a"]


def test_daily_write_is_idempotent_and_keeps_other_days(spark, tmp_path):
    base = str(tmp_path / "bronze")
    df = spark.createDataFrame([(D(2024, 1, 1, 5), "a"), (D(2024, 1, 2, 6), "b"), (D(2024, 1, 3, 7), "c")],
                               "createdAt timestamp, cursor string")
    sinks.write_daily(df, base, "createdAt")
    before = sorted(map(tuple, raw.read_raw(spark, base).collect()))
    sinks.write_daily(df.where(F.col("cursor") == "c"), base, "createdAt")
    assert sorted(map(tuple, raw.read_raw(spark, base).collect())) == before
    latest = raw.latest_partition(raw.read_raw(spark, base), dt.date(2024, 1, 3)).first()[0]
    assert latest == dt.date(2024, 1, 2)
    assert [r["cursor"] for r in raw.read_latest(raw.read_raw(spark, base), dt.date(2024, 1, 3)).collect()] == ["b"]


def test_curate_fails_when_no_day_is_good(spark, tmp_path):
    from subledger.operators.curate import CurateError, curate
    base = str(tmp_path / "raw")
    (spark.createDataFrame([("not a time", "c1"), ("never", "c2")], "occurredAt string, cursor string")
     .withColumn("dt", F.lit(dt.date(2024, 1, 1))).write.partitionBy("dt").parquet(base))
    with pytest.raises(CurateError):
        curate(spark, base, str(tmp_path / "curated"))


def test_mrr_null_month_sorts_last(spark):
    """A payment without a time forms a NULL month that sorts after real months (NULLS LAST)."""
    tx = spark.createDataFrame([
        (D(2024, 1, 5), "a/1", "c", Decimal("100.00"), 1),
        (D(2024, 2, 5), "a/2", "c", Decimal("80.00"), 1),
        (None, "a/3", "c", Decimal("10.00"), 1),
    ], TX_SCHEMA)
    rows = mrr.mrr_shop_month(tx, dt.date(2024, 6, 1)).collect()
    null_month = [r for r in rows if r["month"] is None and r["revenue"] == Decimal("10.00")][0]
    assert null_month["prev_month_revenue"] == Decimal("80.00")
    feb = [r for r in rows if r["month"] == dt.date(2024, 2, 1)][0]
    assert feb["prev_month_revenue"] == Decimal("100.00")
    assert [(r["month"], r["churn_mrr"]) for r in rows if r["churn_mrr"]] == [(dt.date(2024, 3, 1), Decimal("-80.00"))]
    last = mrr.shop_last_month(mrr.mrr_components(mrr.revenue_by_month(tx))).collect()
    assert [tuple(r) for r in last] == [(1, dt.date(2024, 2, 1), Decimal("80.00"))]


def test_revenue_of_doubles_does_not_depend_on_order(spark):
    import random
    values = [1e13, 0.1, 0.2, -1e13, 0.3, 5.005, 7.1, 0.7] * 3
    sums = set()
    for seed in range(4):
        random.Random(seed).shuffle(values)
        tx = spark.createDataFrame([(D(2024, 1, 5), v, 1) for v in values],
                                   "createdat timestamp, netamount double, shopid long").repartition(seed + 1)
        sums.add(mrr.revenue_by_month(tx).first()["revenue"])
    assert len(sums) == 1


def test_intervals_that_end_before_they_start_are_ranked(spark):
    subs = timeline.timeline_intervals(_events(spark), dt.date(2024, 1, 20))  # as_of before the last start
    last = [r for r in subs.collect() if r["cursor"] == "05"][0]
    assert last["activated_date"] > last["actual_end_date"]
    tx = spark.createDataFrame([(D(2024, 1, 27), "gid://p/AppSubscriptionSale/1", "c", Decimal("1.00"), 1)], TX_SCHEMA)
    row = attribution.attribute_transactions(tx, subs).first()
    assert row["pricing_plan"] == "Unlimited Blog posts"  # ended Jan 21, later than the one that ended Jan 20


@pytest.mark.parametrize("method", ["explode", "sweep"])
def test_long_intervals_and_null_shops(spark, method):
    from subledger.operators import active
    iv = spark.createDataFrame([
        (1, D(1980, 1, 1), D(2024, 1, 1)), (None, D(2024, 1, 1), D(2024, 1, 3)), (2, D(2024, 1, 2), D(2024, 1, 4)),
    ], "shopid long, activated_date timestamp, actual_end_date timestamp")
    got = {r["active_date"]: r["merchants"]
           for r in active.merchants_by_day(iv, dt.date(2024, 1, 9), method=method).collect()}
    assert len(got) == 16071 + 3 and got[dt.date(2023, 12, 31)] == 1
    assert [got[dt.date(2024, 1, d)] for d in (1, 2, 3)] == [0, 1, 1]
    cut = active.merchants_by_day(iv, dt.date(2024, 1, 9), max_days=10, method=method)
    assert cut.count() == 13


@pytest.mark.parametrize("method", ["explode", "sweep"])
def test_same_day_interval_has_no_active_days(spark, method):
    from subledger.operators import active
    iv = spark.createDataFrame([
        (1, D(2024, 1, 5, 10), D(2024, 1, 5, 18)),   # ends on its start day: no active day
        (2, D(2024, 1, 5, 9), D(2024, 1, 7, 1)),     # active Jan 5 and Jan 6
        (2, D(2024, 1, 6, 9), D(2024, 1, 9, 0)),     # overlaps the shop's other interval
        (3, D(2024, 1, 8, 0), None),                 # open: active until as_of + 1, cut at as_of
    ], "shopid long, activated_date timestamp, actual_end_date timestamp")
    got = {r["active_date"]: r["merchants"]
           for r in active.merchants_by_day(iv, dt.date(2024, 1, 9), method=method).collect()}
    want = {dt.date(2024, 1, 5): 1, dt.date(2024, 1, 6): 1, dt.date(2024, 1, 7): 1,
            dt.date(2024, 1, 8): 2, dt.date(2024, 1, 9): 1, dt.date(2024, 1, 10): 1}
    assert got == want


def test_register_external_twice_discovers_new_days(spark, tmp_path):
    from subledger.sources import catalog
    base = str(tmp_path / "bronze")
    day1 = spark.createDataFrame([(D(2024, 1, 1, 5), "a")], "createdAt timestamp, cursor string")
    sinks.write_daily(day1, base, "createdAt")
    name = "bronze_reregister_test"
    assert catalog.register_external(spark, name, base).count() == 1
    day2 = spark.createDataFrame([(D(2024, 1, 2, 5), "b"), (D(2024, 1, 2, 6), "c")],
                                 "createdAt timestamp, cursor string")
    sinks.write_daily(day2, base, "createdAt")
    assert catalog.register_external(spark, name, base).count() == 3
    spark.sql(f"DROP TABLE {name}")


def test_curate_one_day_replaces_only_that_day(spark, tmp_path):
    from subledger.operators.curate import curate
    base, out = str(tmp_path / "raw"), str(tmp_path / "curated")
    rows = [("2024-01-01T01:00:00Z", "a", dt.date(2024, 1, 1)), ("2024-01-02T01:00:00Z", "b", dt.date(2024, 1, 2))]
    spark.createDataFrame(rows, "occurredAt string, cursor string, dt date").write.partitionBy("dt").parquet(base)
    curate(spark, base, out)
    spark.createDataFrame([("2024-01-02T02:00:00Z", "c", dt.date(2024, 1, 2))],
                          "occurredAt string, cursor string, dt date").write.mode("append").partitionBy("dt").parquet(base)
    report = curate(spark, base, out, dt=dt.date(2024, 1, 2))
    assert [(r["dt"], r["rows"]) for r in report.collect()] == [(dt.date(2024, 1, 2), 2)]
    assert sorted(r["cursor"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]
