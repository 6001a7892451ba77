"""Table schemas and fixed vocabularies.

Every string constant the jobs compare against lives here, once.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Money is exact: row values DECIMAL(18,2), sums DECIMAL(38,2), so results do
# not depend on summation order.
MONEY = T.DecimalType(18, 2)
MONEY_SUM = T.DecimalType(38, 2)

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's strings for right results).
# ---------------------------------------------------------------------------
EVENT_CHARGE_ACTIVATED = "SUBSCRIPTION_CHARGE_ACTIVATED"
EVENT_CHARGE_UNFROZEN = "SUBSCRIPTION_CHARGE_UNFROZEN"
EVENT_CHARGE_FROZEN = "SUBSCRIPTION_CHARGE_FROZEN"
EVENT_CHARGE_CANCELED = "SUBSCRIPTION_CHARGE_CANCELED"
SUBSCRIPTION_EVENT_PATTERN = "%SUBSCRIPTION_CHARGE%"
INTERVAL_START_EVENTS = (EVENT_CHARGE_ACTIVATED, EVENT_CHARGE_UNFROZEN)

RELATIONSHIP_ACTIVE_EVENTS = ("RELATIONSHIP_INSTALLED", "RELATIONSHIP_REACTIVATED")
RELATIONSHIP_INACTIVE_EVENTS = ("RELATIONSHIP_UNINSTALLED", "RELATIONSHIP_DEACTIVATED")
STATUS_ACTIVE = "Active"
STATUS_INACTIVE = "Inactive"

FREE_PLAN_PATTERN = "%Free%"
FREE_PLAN_LABEL = "Unlimited Blog posts"

# Sale label rules, in evaluation order: (id pattern, only when plan is NULL, label).
SALE_LABEL_RULES = (
    ("%AppOneTimeSale%", False, "App One Time Sale"),
    ("%Adjustment%", True, "Undefined refund"),
    ("%AppSubscriptionSale%", True, "Undefined transactions"),
    ("%AppSaleCredit%", False, "App Sale Credit"),
)

# Distance given to an interval that starts after the payment.
NOT_STARTED_DISTANCE = 999999

# Messages of arrival keys that name no table.
MSG_NO_KEY = "no object key in the notification"
MSG_OTHER_KEY = "object key outside the expected layout: "
MSG_NO_COLLECTION = "folder holds no database-collection pair"

# Column policy: names treated as datetimes, and the unique-key column.
DATETIME_COLUMNS = (
    "createdat", "deletedat", "publishedat", "updatedat",
    "lastaccess", "reinstalledat", "metadata_created_at",
    "uninstalledat", "metadata_updated_at", "occurredat",
)
UNIQUE_KEY_COLUMN = "shopid"

# Day folder pattern of landed files.
DAY_FOLDER_REGEX = r"dt=(\d{4}-\d{2}-\d{2})/"
# ---------------------------------------------------------------------------

# Bronze schemas (names as landed; curated tables use the lower-cased names).
TRANSACTIONS_SCHEMA = T.StructType([
    T.StructField("createdAt", T.TimestampType()),
    T.StructField("id", T.StringType()),
    T.StructField("chargeId", T.StringType()),
    T.StructField("grossAmount", T.DoubleType()),
    T.StructField("currencyCode", T.StringType()),
    T.StructField("netAmount", T.DoubleType()),
    T.StructField("shopID", T.StringType()),
    T.StructField("shopDomain", T.StringType()),
    T.StructField("shopifyFee", T.DoubleType()),
    T.StructField("cursor", T.StringType()),
])

EVENTS_SCHEMA = T.StructType([
    T.StructField("eventType", T.StringType()),
    T.StructField("occurredAt", T.TimestampType()),
    T.StructField("shopDomain", T.StringType()),
    T.StructField("shopName", T.StringType()),
    T.StructField("shopId", T.StringType()),
    T.StructField("appName", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("chargeAmount", T.DoubleType()),
    T.StructField("currencyCode", T.StringType()),
    T.StructField("billingOn", T.StringType()),
    T.StructField("chargeId", T.StringType()),
    T.StructField("chargeName", T.StringType()),
    T.StructField("cursor", T.StringType()),
])

BRONZE_SCHEMAS = {"transactions": TRANSACTIONS_SCHEMA, "events": EVENTS_SCHEMA}
BRONZE_TIME_COLUMN = {"transactions": "createdAt", "events": "occurredAt"}


def bronze_schema(api_type: str) -> T.StructType:
    try:
        return BRONZE_SCHEMAS[api_type]
    except KeyError:
        raise ValueError(f"no bronze schema for feed type {api_type!r}") from None


# Page documents as returned by the billing API. Amounts arrive as strings.
_MONEY_V2 = T.StructType([
    T.StructField("amount", T.StringType()),
    T.StructField("currencyCode", T.StringType()),
])
_SHOP = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("myshopifyDomain", T.StringType()),
])

TRANSACTION_NODE = T.StructType([
    T.StructField("createdAt", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("chargeId", T.StringType()),
    T.StructField("grossAmount", _MONEY_V2),
    T.StructField("netAmount", _MONEY_V2),
    T.StructField("shop", _SHOP),
    T.StructField("shopifyFee", _MONEY_V2),
])

EVENT_NODE = T.StructType([
    T.StructField("occurredAt", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("shop", _SHOP),
    T.StructField("app", T.StructType([T.StructField("name", T.StringType())])),
    T.StructField("charge", T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("billingOn", T.StringType()),
        T.StructField("amount", _MONEY_V2),
    ])),
])


def _edges(node: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("edges", T.ArrayType(T.StructType([
            T.StructField("cursor", T.StringType()),
            T.StructField("node", node),
        ]))),
        T.StructField("pageInfo", T.StructType([T.StructField("hasNextPage", T.BooleanType())])),
    ])


PAGE_SCHEMAS = {
    "transactions": T.StructType([T.StructField("data", T.StructType([
        T.StructField("transactions", _edges(TRANSACTION_NODE))]))]),
    "events": T.StructType([T.StructField("data", T.StructType([
        T.StructField("app", T.StructType([T.StructField("events", _edges(EVENT_NODE))]))]))]),
}
