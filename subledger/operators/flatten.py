"""Edge rows -> flat bronze rows (transactions: 10 columns, events: 13 columns).

Absent or NULL nested values take the source defaults: strings ``''``,
amounts ``0.0``, a transaction's ``chargeId`` the text ``"null"``. Free-text
event fields have newlines and carriage returns replaced by spaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import money, nested, sanitize


def flatten_transactions(edges: DataFrame, keep=()) -> DataFrame:
    n = F.col("node")
    return edges.select(
        n["createdAt"].alias("createdAt"),
        n["id"].alias("id"),
        nested(n["chargeId"], "null").alias("chargeId"),
        money(n["grossAmount"]["amount"]).alias("grossAmount"),
        nested(n["grossAmount"]["currencyCode"], "").alias("currencyCode"),
        money(n["netAmount"]["amount"]).alias("netAmount"),
        nested(n["shop"]["id"], "").alias("shopID"),
        nested(n["shop"]["myshopifyDomain"], "").alias("shopDomain"),
        money(n["shopifyFee"]["amount"]).alias("shopifyFee"),
        F.col("cursor"), *keep,
    )


def flatten_events(edges: DataFrame, keep=()) -> DataFrame:
    n = F.col("node")
    return edges.select(
        sanitize(n["type"]).alias("eventType"),
        sanitize(n["occurredAt"]).alias("occurredAt"),
        sanitize(nested(n["shop"]["myshopifyDomain"], "")).alias("shopDomain"),
        sanitize(nested(n["shop"]["name"], "")).alias("shopName"),
        nested(n["shop"]["id"], "").alias("shopId"),
        sanitize(nested(n["app"]["name"], "")).alias("appName"),
        sanitize(nested(n["reason"], "")).alias("reason"),
        money(n["charge"]["amount"]["amount"]).alias("chargeAmount"),
        nested(n["charge"]["amount"]["currencyCode"], "").alias("currencyCode"),
        nested(n["charge"]["billingOn"], "").alias("billingOn"),
        nested(n["charge"]["id"], "").alias("chargeId"),
        sanitize(nested(n["charge"]["name"], "")).alias("chargeName"),
        F.col("cursor"), *keep,
    )


def flatten(edges: DataFrame, api_type: str, keep=()) -> DataFrame:
    if api_type == "transactions":
        return flatten_transactions(edges, keep)
    if api_type == "events":
        return flatten_events(edges, keep)
    raise ValueError(f"no flat layout for feed type {api_type!r}")
