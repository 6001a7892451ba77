"""Adapters from the driver's test tables to the curated billing tables.

The jobs read curated ``transactions`` and ``events`` tables (lower-case
names, ``TimestampType`` times, ``DECIMAL(18,2)`` money). The driver ships
TPC-H-like tables instead, so these adapters derive billing-shaped tables
from them with column expressions only (no row is dropped or sampled).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas as S

# Fixed as-of dates of the fixtures, so results never drift with the clock.
EVENTS_AS_OF = dt.date(2024, 2, 20)
BACKFILL_AS_OF = dt.date(2024, 2, 5)
ORDERS_AS_OF = dt.date(2001, 8, 15)
# The first day with orders, and a day between two runs over them.
ORDERS_FIRST, ORDERS_SPLIT = dt.date(1995, 1, 1), dt.date(1999, 5, 17)
# Rows from this day on come in later runs.
INCREMENT_FROM = dt.date(2024, 1, 30)
# The day of which some rows have unreadable times.
BAD_DAY = dt.date(2024, 2, 3)

# Pages of a later fetch have higher numbers.
CORRECTED_PAGES = 10_000_000

# Fixture vocabularies (driver event_type -> billing event type).
USAGE_EVENT = "USAGE_CHARGE_APPLIED"
SUBSCRIPTION_TYPE_MAP = {
    "signup": S.EVENT_CHARGE_ACTIVATED,
    "error": S.EVENT_CHARGE_FROZEN,
    "click": S.EVENT_CHARGE_UNFROZEN,
    "view": S.EVENT_CHARGE_CANCELED,
    "purchase": USAGE_EVENT,
}
RELATIONSHIP_TYPE_MAP = {
    "signup": "RELATIONSHIP_INSTALLED",
    "click": "RELATIONSHIP_REACTIVATED",
    "error": "RELATIONSHIP_UNINSTALLED",
    "view": "RELATIONSHIP_DEACTIVATED",
    "purchase": USAGE_EVENT,
}
PLAN_NAMES = ("Free plan", "Pro", "Enterprise, annual")
SALE_SUBTYPES = ("AppOneTimeSale", "AppSaleAdjustment", "AppSaleCredit")  # id % 10 = 0, 1, 2
DEFAULT_SALE_SUBTYPE = "AppSubscriptionSale"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _map(col: Column, mapping: dict[str, str]) -> Column:
    expr = None
    for src, dst in mapping.items():
        expr = F.when(col == src, F.lit(dst)) if expr is None else expr.when(col == src, F.lit(dst))
    return expr


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def _cursor(id_col: str) -> Column:
    return F.lpad(F.col(id_col).cast("string"), 12, "0")


def _shifted_ts(col: str) -> Column:
    # Fixture times are wall-clock (timestamp_ntz): move them 15 calendar days,
    # then read them as instants of the session time zone.
    return (F.col(col) + F.expr("INTERVAL 15 DAYS")).cast("timestamp")


def billing_events(spark: SparkSession, sf_dir: str, mapping: dict[str, str] | None = None) -> DataFrame:
    """Curated events table derived from ``events`` (one row per event)."""
    mapping = mapping or SUBSCRIPTION_TYPE_MAP
    ev = table(spark, sf_dir, "events")
    k = _k()
    plan = (F.when(k % 3 == 0, F.lit(PLAN_NAMES[0]))
            .when(k % 3 == 1, F.lit(PLAN_NAMES[1]))
            .otherwise(F.lit(PLAN_NAMES[2])))
    return ev.select(
        _map(F.col("event_type"), mapping).alias("eventtype"),
        _shifted_ts("ts").alias("occurredat"),
        F.concat(F.lit("shop-"), F.col("user_id").cast("string")).alias("shopdomain"),
        F.col("user_id").alias("shopid"),
        F.col("value").cast(S.MONEY).alias("chargeamount"),
        (F.col("user_id") * 100 + k % 50).cast("string").alias("chargeid"),
        plan.alias("chargename"),
        _cursor("event_id").alias("cursor"),
    )


def subscription_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Charge events; every tenth shop only has usage charges, so its payments have no subscription."""
    ev = billing_events(spark, sf_dir, SUBSCRIPTION_TYPE_MAP)
    return ev.withColumn("eventtype", F.when(F.col("shopid") % 10 == 0, F.lit(USAGE_EVENT)).otherwise(F.col("eventtype")))


def relationship_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return billing_events(spark, sf_dir, RELATIONSHIP_TYPE_MAP)


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated transactions from ``purchase`` events."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    sub = F.col("event_id") % 10
    subtype = (F.when(sub == 0, F.lit(SALE_SUBTYPES[0]))
               .when(sub == 1, F.lit(SALE_SUBTYPES[1]))
               .when(sub == 2, F.lit(SALE_SUBTYPES[2]))
               .otherwise(F.lit(DEFAULT_SALE_SUBTYPE)))
    return ev.select(
        _shifted_ts("ts").alias("createdat"),
        F.concat(F.lit("gid://partners/"), subtype, F.lit("/"), F.col("event_id").cast("string")).alias("id"),
        (F.col("user_id") * 100 + _k() % 50).cast("string").alias("chargeid"),
        (F.floor(F.col("value") / 10) * 10).cast(S.MONEY).alias("netamount"),
        F.col("user_id").alias("shopid"),
        _cursor("event_id").alias("cursor"),
    )


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated transactions from ``orders`` (monthly revenue fixture)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderdate").cast("timestamp").alias("createdat"),
        F.concat(F.lit(f"gid://partners/{DEFAULT_SALE_SUBTYPE}/"), F.col("o_orderkey").cast("string")).alias("id"),
        F.col("o_orderkey").cast("string").alias("chargeid"),
        (F.floor(F.col("o_totalprice") / 100000) * 100000).cast(S.MONEY).alias("netamount"),
        F.col("o_custkey").alias("shopid"),
        _cursor("o_orderkey").alias("cursor"),
    )


def order_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscription intervals from ``orders`` (daily active fixture)."""
    o = table(spark, sf_dir, "orders")
    start = F.col("o_orderdate")
    end = start + F.make_dt_interval(days=(F.col("o_orderkey") % 60).cast("int"))
    return o.select(
        F.col("o_custkey").alias("shopid"),
        start.cast("timestamp").alias("activated_date"),
        end.cast("timestamp").alias("actual_end_date"),
    )


# ---------------------------------------------------------------------------
# Landing-side fixtures: bronze rows and the API pages that carry them.
# Some rows leave fields out (shop/fee every 7th id, charge id every 11th for
# transactions; reason+charge every 7th, shop every 11th for events) so the
# flatten defaults are exercised. The bronze frames are the expected result.
# ---------------------------------------------------------------------------
def _iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")


def _tx_parts() -> dict[str, Column]:
    eid, uid, v = F.col("event_id"), F.col("user_id"), F.col("value")
    sub = eid % 10
    subtype = (F.when(sub == 0, F.lit(SALE_SUBTYPES[0])).when(sub == 1, F.lit(SALE_SUBTYPES[1]))
               .when(sub == 2, F.lit(SALE_SUBTYPES[2])).otherwise(F.lit(DEFAULT_SALE_SUBTYPE)))
    return {
        "createdAt": _shifted_ts("ts"),
        "id": F.concat(F.lit("gid://partners/"), subtype, F.lit("/"), eid.cast("string")),
        "chargeId": F.when(eid % 11 != 0, (uid * 100 + _k() % 50).cast("string")),
        "gross": v,
        "net": F.floor(v / 10) * 10,
        "shopID": F.when(eid % 7 != 0, F.concat(F.lit("gid://partners/Shop/"), uid.cast("string"))),
        "shopDomain": F.when(eid % 7 != 0, F.concat(F.lit("shop-"), uid.cast("string"), F.lit(".example"))),
        "fee": F.when(eid % 7 != 0, F.floor(v) / 100),
        "cursor": _cursor("event_id"),
    }


def bronze_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _tx_parts()
    return _purchases(spark, sf_dir).select(
        p["createdAt"].alias("createdAt"), p["id"].alias("id"),
        F.coalesce(p["chargeId"], F.lit("null")).alias("chargeId"),
        p["gross"].cast("double").alias("grossAmount"), F.lit("USD").alias("currencyCode"),
        p["net"].cast("double").alias("netAmount"),
        F.coalesce(p["shopID"], F.lit("")).alias("shopID"),
        F.coalesce(p["shopDomain"], F.lit("")).alias("shopDomain"),
        F.coalesce(p["fee"], F.lit(0.0)).cast("double").alias("shopifyFee"),
        p["cursor"].alias("cursor"),
    )


def transaction_pages(spark: SparkSession, sf_dir: str, page_size: int = 100, corrected: bool = False,
                      newer: bool = False) -> DataFrame:
    """API pages (JSON text) of the purchases, ``page_size`` consecutive ids per page.

    ``corrected`` gives the pages of a later fetch: every fourth purchase, at half its amount.
    ``newer`` pages hold fields that the page schema lacks: ``taxAmount`` and ``shop.plan`` in some rows.
    """
    p = _tx_parts()
    rows = _purchases(spark, sf_dir)
    if corrected:
        rows, p["gross"] = rows.where(F.col("event_id") % 4 == 0), p["gross"] / 2
    node = F.struct(
        _iso(p["createdAt"]).alias("createdAt"), p["id"].alias("id"), p["chargeId"].alias("chargeId"),
        F.struct(p["gross"].cast("string").alias("amount"), F.lit("USD").alias("currencyCode")).alias("grossAmount"),
        F.struct(p["net"].cast("double").cast("string").alias("amount")).alias("netAmount"),
        F.when(p["shopID"].isNotNull(), F.struct(p["shopID"].alias("id"),
                                                  p["shopDomain"].alias("myshopifyDomain"))).alias("shop"),
        F.when(p["fee"].isNotNull(), F.struct(p["fee"].cast("string").alias("amount"))).alias("shopifyFee"),
    )
    if newer:
        tax = F.when(F.col("event_id") % 3 == 0, F.struct(F.col("event_id").alias("cents")))
        plan = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("plan "), (F.col("event_id") % 4).cast("string")))
        shop = F.when(p["shopID"].isNotNull(), F.struct(p["shopID"].alias("id"), p["shopDomain"].alias("myshopifyDomain"),
                                                        plan.alias("plan")))
        node = node.withField("taxAmount", tax).withField("shop", shop)
    edges = rows.select(
        (F.floor(F.col("event_id") / page_size) + (CORRECTED_PAGES if corrected else 0)).alias("page_id"),
        F.struct(p["cursor"].alias("cursor"), node.alias("node")).alias("edge"))
    pages = edges.groupBy("page_id").agg(F.collect_list("edge").alias("edges"))
    doc = F.struct(F.struct(F.struct(
        F.col("edges"), F.struct(F.lit(True).alias("hasNextPage")).alias("pageInfo")
    ).alias("transactions")).alias("data"))
    return pages.select("page_id", F.to_json(doc).alias("json"))


def keyless_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per row of ``nation`` that holds one row without a cursor twice."""
    name = F.col("n_name")
    node = F.concat(F.lit('{"node":{"createdAt":"2024-01-20T08:00:00Z","id":"'), name,
                    F.lit('","grossAmount":{"amount":"1.5"}}}'))
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("long").alias("page_id"),
        F.concat(F.lit('{"data":{"transactions":{"edges":['), node, F.lit(","), node, F.lit("]}}}")).alias("json"))


def corrected_transactions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Bronze transactions, and what lands later: every fourth at half its amount. Every fiftieth has no cursor."""
    tx = bronze_transactions(spark, sf_dir)
    number = F.col("cursor").cast("long")
    keyless = F.when(number % 50 != 1, F.col("cursor"))
    later = (tx.where((number % 4 == 0) | (number % 50 == 1))
             .withColumn("grossAmount", F.when(number % 50 == 1, F.col("grossAmount")).otherwise(F.col("grossAmount") / 2)))
    return tx.withColumn("cursor", keyless), later.withColumn("cursor", keyless)


def growing_transactions(spark: SparkSession, sf_dir: str, split: dt.date) -> tuple[DataFrame, DataFrame]:
    """Bronze transactions before and from a day on; the later ones have wider columns ``units``, ``rate`` and ``note``."""
    tx = bronze_transactions(spark, sf_dir)
    number, early = F.col("cursor").cast("long"), F.col("createdAt") < F.lit(split).cast("timestamp")
    first = tx.where(early).select("*", (number % 1000).cast("int").alias("units"), (number % 7).cast("int").alias("rate"),
                                   (number % 10).cast("int").alias("note"))
    later = tx.where(~early).select("*", (number + 5_000_000_000).alias("units"), (number % 7 + 0.5).cast("double").alias("rate"),
                                    F.concat(F.lit("no "), (number % 10).cast("string")).alias("note"))
    return first, later


def _ev_parts() -> dict[str, Column]:
    eid, uid = F.col("event_id"), F.col("user_id")
    k = _k()
    plan = (F.when(k % 3 == 0, F.lit(PLAN_NAMES[0])).when(k % 3 == 1, F.lit(PLAN_NAMES[1]))
            .otherwise(F.lit(PLAN_NAMES[2])))
    has_charge, has_shop = eid % 7 != 0, eid % 11 != 0
    return {
        "type": _map(F.col("event_type"), SUBSCRIPTION_TYPE_MAP),
        "occurredAt": _shifted_ts("ts"),
        "reason": F.when(has_charge, F.concat(F.lit("changed\r\nby "), F.col("event_type"))),
        "shop_id": F.when(has_shop, F.concat(F.lit("gid://partners/Shop/"), uid.cast("string"))),
        "shop_name": F.when(has_shop, F.concat(F.lit("Shop\n"), uid.cast("string"))),
        "shop_domain": F.when(has_shop, F.concat(F.lit("shop-"), uid.cast("string"), F.lit(".example"))),
        "app": F.lit("billing app"),
        "charge_id": F.when(has_charge, (uid * 100 + k % 50).cast("string")),
        "charge_name": F.when(has_charge, plan),
        "billing_on": F.when(has_charge, F.date_format(_shifted_ts("ts"), "yyyy-MM-dd")),
        "amount": F.when(has_charge, F.col("value")),
        "currency": F.when(has_charge, F.lit("USD")),
        "cursor": _cursor("event_id"),
    }


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _ev_parts()
    blank = F.lit("")

    def clean(c):
        return F.translate(F.coalesce(c, blank), "\n\r", "  ")
    return table(spark, sf_dir, "events").select(
        p["type"].alias("eventType"), p["occurredAt"].alias("occurredAt"),
        clean(p["shop_domain"]).alias("shopDomain"), clean(p["shop_name"]).alias("shopName"),
        F.coalesce(p["shop_id"], blank).alias("shopId"), clean(p["app"]).alias("appName"),
        clean(p["reason"]).alias("reason"),
        F.coalesce(p["amount"], F.lit(0.0)).cast("double").alias("chargeAmount"),
        F.coalesce(p["currency"], blank).alias("currencyCode"),
        F.coalesce(p["billing_on"], blank).alias("billingOn"),
        F.coalesce(p["charge_id"], blank).alias("chargeId"),
        clean(p["charge_name"]).alias("chargeName"),
        p["cursor"].alias("cursor"),
    )


def event_pages(spark: SparkSession, sf_dir: str, page_size: int = 100) -> DataFrame:
    p = _ev_parts()
    node = F.struct(
        _iso(p["occurredAt"]).alias("occurredAt"), p["type"].alias("type"), p["reason"].alias("reason"),
        F.when(p["shop_id"].isNotNull(), F.struct(p["shop_id"].alias("id"), p["shop_name"].alias("name"),
                                                   p["shop_domain"].alias("myshopifyDomain"))).alias("shop"),
        F.struct(p["app"].alias("name")).alias("app"),
        F.when(p["charge_id"].isNotNull(), F.struct(
            p["charge_id"].alias("id"), p["charge_name"].alias("name"), p["billing_on"].alias("billingOn"),
            F.struct(p["amount"].cast("string").alias("amount"), p["currency"].alias("currencyCode")).alias("amount"),
        )).alias("charge"),
    )
    edges = table(spark, sf_dir, "events").select(
        F.floor(F.col("event_id") / page_size).alias("page_id"),
        F.struct(p["cursor"].alias("cursor"), node.alias("node")).alias("edge"))
    pages = edges.groupBy("page_id").agg(F.collect_list("edge").alias("edges"))
    doc = F.struct(F.struct(F.struct(F.struct(
        F.col("edges"), F.struct(F.lit(True).alias("hasNextPage")).alias("pageInfo")
    ).alias("events")).alias("app")).alias("data"))
    return pages.select("page_id", F.to_json(doc).alias("json"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze events as a raw source lands them: event time as ISO text."""
    return bronze_events(spark, sf_dir).withColumn("occurredAt", _iso(F.col("occurredAt")))


def mixed_raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events with ``dt``: some times of one day unreadable, and rows without a day, some of them unreadable."""
    number = F.col("cursor").cast("long")
    day = F.to_date(F.substring("occurredAt", 1, 10))
    bad = (number % 5 == 0) & ((day == F.lit(BAD_DAY)) | (number % 53 == 0))
    return (raw_events(spark, sf_dir).withColumn("dt", F.when(number % 53 != 0, day))
            .withColumn("occurredAt", F.when(bad, F.lit("some time ago")).otherwise(F.col("occurredAt"))))


def broken_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page without edges per row of ``region``, and one whose row has no time per row of ``nation``."""
    other = table(spark, sf_dir, "region").select(
        F.concat(F.lit('{"data":{"note":"'), F.col("r_name"), F.lit('"}}')).alias("json"))
    untimed = table(spark, sf_dir, "nation").select(F.concat(
        F.lit('{"data":{"transactions":{"edges":[{"cursor":"n-'), F.col("n_nationkey").cast("string"),
        F.lit('","node":{"id":"'), F.col("n_name"), F.lit('"}}]}}}')).alias("json"))
    return other.unionByName(untimed)


def notifications(spark: SparkSession, sf_dir: str, per_doc: int = 4) -> DataFrame:
    """Object-arrival notification documents, one object per event, ``per_doc`` records each.

    Keys vary on purpose: ``%3D`` for ``=`` (every 3rd), ``+`` in the file name
    (every 5th), no day folder (every 11th), another source (every 13th), a
    folder without ``database-collection`` (every 17th), a bad percent sequence
    (every 19th) and no key (every 101st). One more document for each row of
    ``region`` can't be read as JSON.
    """
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    day = F.date_format(_shifted_ts("ts"), "yyyy-MM-dd")
    src = F.when(eid % 13 == 0, F.lit("postgres")).otherwise(F.lit("mongodb"))
    folder = F.when(eid % 17 == 0, F.lit("billing")).otherwise(F.concat(F.lit("billing-"), F.col("event_type")))
    eq = F.when(eid % 3 == 0, F.lit("%3D")).otherwise(F.lit("="))
    fname = F.concat(F.lit("part"), F.when(eid % 5 == 0, F.lit("+")).otherwise(F.lit("-")),
                     eid.cast("string"), F.lit(".json"))
    key = F.when(eid % 101 == 0, F.lit("")) \
           .when(eid % 19 == 0, F.concat_ws("/", src, folder, F.lit("100%zz"), fname)) \
           .when(eid % 11 == 0, F.concat_ws("/", src, folder, fname)) \
           .otherwise(F.concat_ws("/", src, folder, F.concat(F.lit("dt"), eq, day), fname))
    rec = F.struct(
        F.lit("aws:s3").alias("eventSource"), F.lit("region-1").alias("awsRegion"),
        F.lit("ObjectCreated:Put").alias("eventName"),
        F.struct(F.struct(F.lit("landing").alias("name")).alias("bucket"),
                 F.struct(key.alias("key"), (F.col("user_id") * 1000 + eid % 1000).alias("size")).alias("object"),
                 ).alias("s3"))
    docs = (ev.select(F.floor(eid / per_doc).alias("doc_id"), rec.alias("r"))
            .groupBy("doc_id").agg(F.collect_list("r").alias("Records")))
    broken = table(spark, sf_dir, "region").select((-1 - F.col("r_regionkey")).cast("long").alias("doc_id"),
                                                   F.concat(F.lit('{"Records": ['), F.col("r_name")).alias("json"))
    return docs.select("doc_id", F.to_json(F.struct("Records")).alias("json")).unionByName(broken)
