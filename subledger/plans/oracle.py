"""DuckDB oracle SQL for every registered query.

Written independently of the Spark code, as plain brute-force SQL: the
attribution ranks every (payment, subscription) pair of a shop, the day counts
use a range join against day offsets, last values use ``arg_max``. Tables
``events``, ``orders`` … are views over the same parquet files the Spark side
reads.
"""

from __future__ import annotations

from .. import schemas as S
from ..fixtures import BACKFILL_AS_OF, EVENTS_AS_OF, ORDERS_AS_OF, USAGE_EVENT

EV_AS_OF = f"DATE '{EVENTS_AS_OF.isoformat()}'"
ORD_AS_OF = f"DATE '{ORDERS_AS_OF.isoformat()}'"

# --- adapters (same derivations as subledger.fixtures) ---------------------
_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

def _event_type_case(mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN event_type = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {whens} END"


def billing_events_cte(name: str, mapping: dict[str, str], usage_only: str = "false") -> str:
    return f"""{name} AS (
    SELECT CASE WHEN {usage_only} THEN '{USAGE_EVENT}' ELSE {_event_type_case(mapping)} END AS eventtype,
           CAST(ts AS TIMESTAMP) + INTERVAL 15 DAY AS occurredat,
           'shop-' || CAST(user_id AS VARCHAR) AS shopdomain,
           user_id AS shopid,
           CAST(value AS DECIMAL(18,2)) AS chargeamount,
           CAST(user_id * 100 + {_K} % 50 AS VARCHAR) AS chargeid,
           CASE {_K} % 3 WHEN 0 THEN 'Free plan' WHEN 1 THEN 'Pro' ELSE 'Enterprise, annual' END AS chargename,
           lpad(CAST(event_id AS VARCHAR), 12, '0') AS cursor
    FROM events)"""


PAYMENTS_CTE = f"""payments AS (
    SELECT CAST(ts AS TIMESTAMP) + INTERVAL 15 DAY AS createdat,
           'gid://partners/' || CASE event_id % 10 WHEN 0 THEN 'AppOneTimeSale'
                                   WHEN 1 THEN 'AppSaleAdjustment'
                                   WHEN 2 THEN 'AppSaleCredit'
                                   ELSE 'AppSubscriptionSale' END
             || '/' || CAST(event_id AS VARCHAR) AS id,
           CAST(user_id * 100 + {_K} % 50 AS VARCHAR) AS chargeid,
           CAST(floor(value / 10) * 10 AS DECIMAL(18,2)) AS netamount,
           user_id AS shopid,
           lpad(CAST(event_id AS VARCHAR), 12, '0') AS cursor
    FROM events WHERE event_type = 'purchase')"""

ORDER_PAYMENTS_CTE = """order_payments AS (
    SELECT CAST(o_orderdate AS TIMESTAMP) AS createdat,
           'gid://partners/AppSubscriptionSale/' || CAST(o_orderkey AS VARCHAR) AS id,
           CAST(o_orderkey AS VARCHAR) AS chargeid,
           CAST(floor(o_totalprice / 100000) * 100000 AS DECIMAL(18,2)) AS netamount,
           o_custkey AS shopid,
           lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS cursor
    FROM orders)"""

ORDER_INTERVALS_CTE = """order_intervals AS (
    SELECT o_custkey AS shopid,
           CAST(o_orderdate AS TIMESTAMP) AS activated_date,
           CAST(o_orderdate AS TIMESTAMP) + to_days(CAST(o_orderkey % 60 AS INTEGER)) AS actual_end_date
    FROM orders)"""


# --- C03 monthly recurring revenue ------------------------------------------
def _money(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(38,2))"


def _mrr_ctes(tx: str, as_of: str) -> str:
    this_month = f"CAST(date_trunc('month', {as_of}) AS DATE)"
    return f"""rev AS (
    SELECT shopid, CAST(date_trunc('month', createdat) AS DATE) AS month, {_money('sum(netamount)')} AS revenue
    FROM {tx} GROUP BY shopid, month)
, moves AS (
    SELECT month, shopid, revenue,
           lag(revenue) OVER (PARTITION BY shopid ORDER BY month) AS prev_month_revenue
    FROM rev)
, comp AS (
    SELECT month, shopid, revenue, prev_month_revenue,
        {_money('CASE WHEN prev_month_revenue IS NULL THEN revenue ELSE 0 END')} AS new_mrr,
        {_money('CASE WHEN prev_month_revenue IS NULL THEN 0 ELSE least(revenue, prev_month_revenue) END')} AS mrr,
        {_money('CASE WHEN prev_month_revenue IS NULL THEN 0 ELSE greatest(revenue - prev_month_revenue, 0) END')}
            AS expansion_mrr,
        {_money('CASE WHEN prev_month_revenue IS NULL THEN 0 ELSE least(revenue - prev_month_revenue, 0) END')}
            AS contraction_mrr,
        {_money('0')} AS churn_mrr
    FROM moves)
, last_seen AS (
    SELECT shopid, max(month) AS final_month, arg_max(mrr, month) AS final_mrr
    FROM comp WHERE month IS NOT NULL GROUP BY shopid)
, churned AS (
    SELECT CAST(final_month + INTERVAL 1 MONTH AS DATE) AS month, shopid,
        {_money('0')} AS revenue, CAST(NULL AS DECIMAL(38,2)) AS prev_month_revenue,
        {_money('0')} AS new_mrr, {_money('0')} AS mrr, {_money('0')} AS expansion_mrr,
        {_money('0')} AS contraction_mrr,
        {_money(f"""CASE WHEN CAST(final_month + INTERVAL 1 MONTH AS DATE)
                       IN ({this_month}, CAST({this_month} + INTERVAL 1 MONTH AS DATE))
                  THEN 0 ELSE -final_mrr END""")} AS churn_mrr
    FROM last_seen)
, shop_months AS (SELECT * FROM comp UNION ALL BY NAME SELECT * FROM churned)"""


def _mrr_totals(tx_cte: str, tx: str, as_of: str) -> str:
    return f"""WITH {tx_cte}, {_mrr_ctes(tx, as_of)}
SELECT month,
    {_money('sum(mrr)')} AS mrr, {_money('sum(new_mrr)')} AS new_mrr,
    {_money('sum(expansion_mrr)')} AS expansion_mrr, {_money('sum(contraction_mrr)')} AS contraction_mrr,
    {_money(f"""CASE WHEN month = CAST(date_trunc('month', {as_of}) AS DATE)
                       OR month = CAST({as_of} + INTERVAL 1 MONTH AS DATE) THEN 0
                  ELSE sum(churn_mrr) END""")} AS churn_mrr
FROM shop_months GROUP BY month ORDER BY month"""


MRR_SHOP_MONTH = f"""WITH {ORDER_PAYMENTS_CTE}, {_mrr_ctes('order_payments', ORD_AS_OF)}
SELECT month, shopid, revenue, prev_month_revenue, new_mrr, mrr, expansion_mrr, contraction_mrr, churn_mrr
FROM shop_months"""

MRR_MONTHLY = _mrr_totals(ORDER_PAYMENTS_CTE, "order_payments", ORD_AS_OF)
# amounts as doubles, as landed tables hold them
MRR_BRONZE = _mrr_totals(PAYMENTS_CTE.replace("CAST(floor(value / 10) * 10 AS DECIMAL(18,2))",
                                              "CAST(value AS DECIMAL(18,2))"), "payments", EV_AS_OF)
MRR_EVENTS_MONTHLY = _mrr_totals(PAYMENTS_CTE, "payments", EV_AS_OF)

SHOP_LAST_MONTH = f"""WITH {ORDER_PAYMENTS_CTE}, {_mrr_ctes('order_payments', ORD_AS_OF)}
SELECT shopid, final_month, final_mrr FROM last_seen"""

MRR_CUMULATIVE = f"""WITH {ORDER_PAYMENTS_CTE}, {_mrr_ctes('order_payments', ORD_AS_OF)}
SELECT month, shopid, revenue,
    {_money('sum(revenue) OVER (PARTITION BY shopid ORDER BY month ROWS UNBOUNDED PRECEDING)')}
        AS total_revenue_overtime
FROM rev"""


# --- C01 subscription timeline ----------------------------------------------
from ..fixtures import RELATIONSHIP_TYPE_MAP, SUBSCRIPTION_TYPE_MAP  # noqa: E402

SUB_EVENTS_CTE = billing_events_cte("sub_events", SUBSCRIPTION_TYPE_MAP, "user_id % 10 = 0")
REL_EVENTS_CTE = billing_events_cte("rel_events", RELATIONSHIP_TYPE_MAP)

TIMELINE_CTES = f"""{SUB_EVENTS_CTE}
, charge_rows AS (
    SELECT eventtype, occurredat, shopid, shopdomain, chargename, chargeid, chargeamount, cursor,
        min(occurredat) OVER (PARTITION BY shopid, chargeid) AS activated_date,
        lead(occurredat) OVER (PARTITION BY shopid, chargeid ORDER BY occurredat NULLS LAST, cursor)
            AS deactivated_date
    FROM sub_events
    WHERE eventtype LIKE '%SUBSCRIPTION_CHARGE%' AND shopid IS NOT NULL)
, start_rows AS (
    SELECT *, lead(activated_date) OVER (PARTITION BY shopid
            ORDER BY activated_date NULLS LAST, occurredat NULLS LAST, cursor) AS next_activation
    FROM charge_rows
    WHERE eventtype IN ('SUBSCRIPTION_CHARGE_ACTIVATED', 'SUBSCRIPTION_CHARGE_UNFROZEN'))
, intervals AS (
    SELECT shopid, shopdomain, chargeid, activated_date, chargeamount,
        CASE WHEN chargename LIKE '{S.FREE_PLAN_PATTERN}' THEN '{S.FREE_PLAN_LABEL}' ELSE chargename END AS pricing_plan,
        CASE WHEN deactivated_date IS NULL
                 THEN coalesce(next_activation, CAST({EV_AS_OF} + 1 AS TIMESTAMP))
             WHEN next_activation < deactivated_date THEN next_activation
             ELSE deactivated_date END AS actual_end_date,
        cursor
    FROM start_rows)"""

TIMELINE_EVENTS = f"""WITH {TIMELINE_CTES}
SELECT * FROM charge_rows"""

TIMELINE_INTERVALS = f"""WITH {TIMELINE_CTES}
SELECT * FROM intervals"""


# --- C04 / C05 daily active merchants ----------------------------------------
def _days(src: str, as_of: str) -> str:
    start = "CAST(s.activated_date AS DATE)"
    return f"""days AS (
    SELECT s.shopid, {start} AS activated_date, CAST(s.actual_end_date AS DATE) AS actual_end_date,
        {start} + CAST(r.range AS INTEGER) AS active_date
    FROM {src} s
    JOIN range(0, (SELECT max(date_diff('day', CAST(activated_date AS DATE),
                                        coalesce(CAST(actual_end_date AS DATE), {as_of} + 2))) + 1 FROM {src})) r
      ON {start} + CAST(r.range AS INTEGER) <= coalesce(CAST(s.actual_end_date AS DATE) - 1, {as_of} + 1))"""


def _roll(as_of: str) -> str:
    return f"""per_day AS (
    SELECT active_date, count(DISTINCT shopid) AS merchants FROM days GROUP BY active_date)
, upto AS (SELECT * FROM per_day WHERE active_date <= {as_of})
, month_last AS (
    SELECT CAST(date_trunc('month', active_date) AS DATE) AS month,
           arg_max(merchants, active_date) AS end_of_month_merchants
    FROM upto GROUP BY 1)
, month_roll AS (
    SELECT month, end_of_month_merchants,
           lag(end_of_month_merchants) OVER (ORDER BY month) AS last_month_merchants
    FROM month_last)
, daily AS (
    SELECT u.active_date, u.merchants, lag(u.merchants) OVER (ORDER BY u.active_date) AS prev_day_merchants,
           m.month, m.end_of_month_merchants, m.last_month_merchants
    FROM upto u JOIN month_roll m ON m.month = CAST(date_trunc('month', u.active_date) AS DATE))"""


INTERVAL_DAYS = f"""WITH {ORDER_INTERVALS_CTE}, {_days('order_intervals', ORD_AS_OF)}
SELECT * FROM days"""

DAILY_ACTIVE = f"""WITH {ORDER_INTERVALS_CTE}, {_days('order_intervals', ORD_AS_OF)}, {_roll(ORD_AS_OF)}
SELECT * FROM daily"""

_SPANS = "\nUNION ALL ".join(
    f"SELECT '{u}' AS unit, CAST(date_trunc('{u}', active_date) AS DATE) AS span_start, count(DISTINCT shopid) AS merchants "
    f"FROM due GROUP BY 2" for u in ("week", "month", "quarter", "year"))
ACTIVE_BY_SPAN = f"""WITH {ORDER_INTERVALS_CTE}, {_days('order_intervals', ORD_AS_OF)}
, due AS (SELECT * FROM days WHERE active_date <= {ORD_AS_OF})
{_SPANS}"""

ACTIVE_RETAINED = f"""WITH {ORDER_INTERVALS_CTE}, {_days('order_intervals', ORD_AS_OF)}
, pairs AS (SELECT DISTINCT CAST(date_trunc('month', active_date) AS DATE) AS m, shopid FROM days
            WHERE active_date <= {ORD_AS_OF} AND shopid IS NOT NULL)
SELECT a.m AS span_start, count(*) AS merchants, count(b.shopid) AS kept
FROM pairs a LEFT JOIN pairs b ON b.shopid = a.shopid AND b.m = CAST(a.m - INTERVAL 1 MONTH AS DATE) GROUP BY a.m"""

MONTH_END = f"""WITH {ORDER_INTERVALS_CTE}, {_days('order_intervals', ORD_AS_OF)}, {_roll(ORD_AS_OF)}
SELECT * FROM month_roll"""

DAILY_ACTIVE_TIMELINE = f"""WITH {TIMELINE_CTES}, {_days('intervals', EV_AS_OF)}, {_roll(EV_AS_OF)}
SELECT * FROM daily"""

STORE_CTES = f"""{REL_EVENTS_CTE}
, status_rows AS (
    SELECT shopid, shopdomain, occurredat, cursor,
        CASE WHEN eventtype IN ('RELATIONSHIP_INSTALLED', 'RELATIONSHIP_REACTIVATED') THEN 'Active'
             WHEN eventtype IN ('RELATIONSHIP_UNINSTALLED', 'RELATIONSHIP_DEACTIVATED') THEN 'Inactive'
        END AS status
    FROM rel_events WHERE shopid IS NOT NULL)
, status_spans AS (
    SELECT shopid, shopdomain, status, cursor, occurredat AS activated_date,
        coalesce(lead(occurredat) OVER (PARTITION BY shopid ORDER BY occurredat NULLS LAST, cursor),
                 CAST({EV_AS_OF} + 1 AS TIMESTAMP)) AS actual_end_date
    FROM status_rows WHERE status IS NOT NULL)
, installs AS (
    SELECT shopid, min(occurredat) AS first_install FROM rel_events WHERE shopid IS NOT NULL GROUP BY shopid)
, store_spans AS (
    SELECT p.shopid, p.shopdomain, p.activated_date, p.actual_end_date, p.cursor, i.first_install
    FROM status_spans p JOIN installs i ON i.shopid = p.shopid
    WHERE p.status = 'Active')"""

STORE_STATUS = f"""WITH {STORE_CTES}
SELECT * FROM store_spans"""

STORE_DAILY_ACTIVE = f"""WITH {STORE_CTES}, {_days('store_spans', EV_AS_OF)}, {_roll(EV_AS_OF)}
SELECT * FROM daily"""


# --- C02 payment -> plan attribution ------------------------------------------
_PAYMENT = "createdat, id, _id, netamount, prev_netamount, shopid"
_PAY_ORDER = "createdat NULLS LAST, id, netamount NULLS LAST, prev_netamount NULLS LAST"
_ID_ORDER = "_id NULLS LAST, createdat NULLS LAST, id, netamount NULLS LAST, prev_netamount NULLS LAST"
_VALUES = ("pricing_plan", "prev_pricing_plan", "chargeamount", "prev_chargeamount",
           "activated_date", "actual_end_date", "prev_activated_date", "prev_actual_end_date")
_CHOICE = (("pricing_plan", "prev_pricing_plan"), ("chargeamount", "prev_chargeamount"),
           ("activated_date", "prev_activated_date"), ("actual_end_date", "prev_actual_end_date"))
_KEEP = ("pricing_plan", "chargeamount", "activated_date", "actual_end_date")

_firsts = ",\n        ".join(f"arg_min({c}, rn) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in _VALUES)
_chosen = ",\n        ".join(f"CASE WHEN hit AND {p} IS NOT NULL THEN {p} ELSE {c} END AS {c}" for c, p in _CHOICE)
_carried = ",\n        ".join(
    f"CASE WHEN netamount = prev_netamount THEN lag({c}) OVER w ELSE {c} END AS {c}" for c in _KEEP)

_labels = "\n                  ".join(
    f"WHEN id LIKE '{pattern}'{' AND pricing_plan IS NULL' if without_plan else ''} THEN '{label}'"
    for pattern, without_plan, label in S.SALE_LABEL_RULES)

ATTRIBUTION_CTES = f"""{PAYMENTS_CTE}, {TIMELINE_CTES}
, tx AS (
    SELECT createdat, id, _id, chargeid, netamount, shopid,
        lag(netamount) OVER (PARTITION BY shopid
            ORDER BY _id NULLS LAST, id, createdat NULLS LAST, netamount NULLS LAST) AS prev_netamount
    FROM (SELECT *, TRY_CAST(NULLIF(regexp_extract(id, '([0-9]+)$', 1), '') AS BIGINT) AS _id FROM payments))
, subs_prev AS (
    SELECT shopid, activated_date, actual_end_date, pricing_plan, chargeamount, cursor,
        lag(pricing_plan) OVER ws AS prev_pricing_plan,
        lag(chargeamount) OVER ws AS prev_chargeamount,
        lag(activated_date) OVER ws AS prev_activated_date,
        lag(actual_end_date) OVER ws AS prev_actual_end_date
    FROM intervals
    WINDOW ws AS (PARTITION BY shopid ORDER BY activated_date NULLS LAST, cursor))
, pays AS (SELECT DISTINCT {_PAYMENT} FROM tx)
, pairs AS (
    SELECT p.createdat, p.id, p._id, p.netamount, p.prev_netamount, p.shopid,
        {", ".join(f"s.{c}" for c in _VALUES)},
        row_number() OVER (PARTITION BY p.createdat, p.id, p._id, p.netamount, p.prev_netamount, p.shopid
            ORDER BY CASE WHEN p.createdat BETWEEN s.activated_date AND s.actual_end_date THEN 0
                          WHEN p.createdat > s.actual_end_date
                              THEN date_diff('day', s.actual_end_date, p.createdat)
                          ELSE 999999 END,
                     s.activated_date NULLS LAST, s.actual_end_date NULLS LAST, s.cursor NULLS LAST) AS rn
    FROM pays p LEFT JOIN subs_prev s ON p.shopid = s.shopid)
, firsts AS (
    SELECT {_PAYMENT},
        {_firsts},
        coalesce(bool_or(date_trunc('month', prev_actual_end_date) = date_trunc('month', createdat)), false)
            AS ended_same_month,
        coalesce(bool_or(date_trunc('month', prev_actual_end_date) + INTERVAL 1 MONTH
                         = date_trunc('month', createdat)), false) AS ended_month_before
    FROM pairs GROUP BY {_PAYMENT})
, neighbours AS (
    SELECT *,
        lag(netamount) OVER (PARTITION BY shopid ORDER BY {_PAY_ORDER}) AS prev_day_amount,
        lead(netamount) OVER (PARTITION BY shopid
            ORDER BY CAST(floor(epoch(createdat)) AS BIGINT) NULLS LAST, id, netamount NULLS LAST,
                     prev_netamount NULLS LAST) AS next_day_amount,
        count(id) OVER (PARTITION BY shopid, CAST(createdat AS DATE)) AS transactions_per_day
    FROM firsts)
, chosen AS (
    SELECT createdat, id, _id, netamount, prev_netamount, next_day_amount, shopid, transactions_per_day,
        {_chosen}
    FROM (SELECT *, coalesce(transactions_per_day > 1
                     AND ((ended_same_month AND netamount = prev_day_amount)
                          OR (ended_month_before AND netamount <> next_day_amount)), false) AS hit
          FROM neighbours))
, labelled AS (
    SELECT createdat, CAST(date_trunc('month', createdat) AS DATE) AS month,
        id, _id, netamount, prev_netamount, next_day_amount, shopid, transactions_per_day,
        CAST(CASE {_labels}
                  ELSE pricing_plan END AS VARCHAR) AS pricing_plan,
        CAST(chargeamount AS DOUBLE) AS chargeamount,
        CAST(activated_date AS DATE) AS activated_date,
        CAST(actual_end_date AS DATE) AS actual_end_date
    FROM chosen)
, carried AS (
    SELECT createdat, month, id, _id, netamount, prev_netamount, next_day_amount, shopid, transactions_per_day,
        {_carried}
    FROM labelled
    WINDOW w AS (PARTITION BY shopid ORDER BY {_ID_ORDER}))
, attributed AS (
    SELECT *, lag(pricing_plan) OVER w AS prev_pricing_plan, lag(chargeamount) OVER w AS prev_chargeamount
    FROM carried
    WINDOW w AS (PARTITION BY shopid ORDER BY {_ID_ORDER}))"""

TX_NUMERIC_ID = f"""WITH {ATTRIBUTION_CTES}
SELECT * FROM tx"""

TX_SUBS_PREV = f"""WITH {ATTRIBUTION_CTES}
SELECT * FROM subs_prev"""

TX_MATCHED = f"""WITH {ATTRIBUTION_CTES}
SELECT * EXCLUDE (ended_same_month, ended_month_before) FROM neighbours"""

TX_CHOICE = f"""WITH {ATTRIBUTION_CTES}
SELECT * FROM chosen"""

TX_LABELLED = f"""WITH {ATTRIBUTION_CTES}
SELECT * FROM labelled"""

TX_ATTRIBUTED = f"""WITH {ATTRIBUTION_CTES}
SELECT * FROM attributed"""

TX_BACKFILL = TX_ATTRIBUTED.replace(EV_AS_OF, f"DATE '{BACKFILL_AS_OF.isoformat()}'")

TX_ONE_SHOP = TX_ATTRIBUTED + " WHERE shopid = (SELECT min(shopid) FROM payments)"


ORACLES: dict[str, str] = {
    "mrr_shop_month": MRR_SHOP_MONTH,
    "mrr_monthly": MRR_MONTHLY,
    "mrr_monthly_events": MRR_EVENTS_MONTHLY,
    "mrr_monthly_bronze": MRR_BRONZE,
    "shop_last_month": SHOP_LAST_MONTH,
    "mrr_cumulative": MRR_CUMULATIVE,
    "timeline_events": TIMELINE_EVENTS,
    "timeline_intervals": TIMELINE_INTERVALS,
    "interval_days": INTERVAL_DAYS,
    "daily_active": DAILY_ACTIVE,
    "daily_active_sweep": DAILY_ACTIVE,
    "active_by_span": ACTIVE_BY_SPAN,
    "active_retained": ACTIVE_RETAINED,
    "timeline_incremental": TIMELINE_INTERVALS,
    "tx_attributed_incremental": TX_ATTRIBUTED,
    "month_end": MONTH_END,
    "daily_active_timeline": DAILY_ACTIVE_TIMELINE,
    "store_status": STORE_STATUS,
    "store_daily_active": STORE_DAILY_ACTIVE,
    "tx_numeric_id": TX_NUMERIC_ID,
    "tx_subs_prev": TX_SUBS_PREV,
    "tx_matched": TX_MATCHED,
    "tx_choice": TX_CHOICE,
    "tx_labelled": TX_LABELLED,
    "tx_attributed": TX_ATTRIBUTED,
    "tx_attributed_backfill": TX_BACKFILL,
    "tx_one_shop": TX_ONE_SHOP,
}
