"""DuckDB oracles for the landing-side queries (expected rows computed from the driver tables)."""

from __future__ import annotations

from .. import schemas as S
from ..fixtures import BAD_DAY
from .ingest import FIRST_AS_OF, LANDING_AS_OF, SECOND_AS_OF, SPLIT_DAY

_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_T = "(CAST(ts AS TIMESTAMP) + INTERVAL 15 DAY)"
_ISO = "'%Y-%m-%dT%H:%M:%S.%fZ'"
_CURSOR = "lpad(CAST(event_id AS VARCHAR), 12, '0')"
_PLAN = f"CASE {_K} % 3 WHEN 0 THEN 'Free plan' WHEN 1 THEN 'Pro' ELSE 'Enterprise, annual' END"
_TYPE = """CASE event_type WHEN 'signup' THEN 'SUBSCRIPTION_CHARGE_ACTIVATED'
                          WHEN 'error' THEN 'SUBSCRIPTION_CHARGE_FROZEN'
                          WHEN 'click' THEN 'SUBSCRIPTION_CHARGE_UNFROZEN'
                          WHEN 'view' THEN 'SUBSCRIPTION_CHARGE_CANCELED'
                          WHEN 'purchase' THEN 'USAGE_CHARGE_APPLIED' END"""
LANDING = f"DATE '{LANDING_AS_OF.isoformat()}'"
SPLIT = f"TIMESTAMP '{SPLIT_DAY.isoformat()} 00:00:00'"


def _tx(created: str) -> str:
    return f"""SELECT {created} AS createdAt,
        'gid://partners/' || CASE event_id % 10 WHEN 0 THEN 'AppOneTimeSale' WHEN 1 THEN 'AppSaleAdjustment'
                                WHEN 2 THEN 'AppSaleCredit' ELSE 'AppSubscriptionSale' END
            || '/' || CAST(event_id AS VARCHAR) AS id,
        CASE WHEN event_id % 11 <> 0 THEN CAST(user_id * 100 + {_K} % 50 AS VARCHAR) ELSE 'null' END AS chargeId,
        value AS grossAmount, 'USD' AS currencyCode,
        CAST(floor(value / 10) * 10 AS DOUBLE) AS netAmount,
        CASE WHEN event_id % 7 <> 0 THEN 'gid://partners/Shop/' || CAST(user_id AS VARCHAR) ELSE '' END AS shopID,
        CASE WHEN event_id % 7 <> 0 THEN 'shop-' || CAST(user_id AS VARCHAR) || '.example' ELSE '' END AS shopDomain,
        CASE WHEN event_id % 7 <> 0 THEN floor(value) / 100 ELSE 0.0 END AS shopifyFee,
        {_CURSOR} AS cursor
    FROM events WHERE event_type = 'purchase'"""


def _ev(occurred: str) -> str:
    return f"""SELECT {_TYPE} AS eventType, {occurred} AS occurredAt,
        CASE WHEN event_id % 11 <> 0 THEN 'shop-' || CAST(user_id AS VARCHAR) || '.example' ELSE '' END AS shopDomain,
        CASE WHEN event_id % 11 <> 0 THEN 'Shop ' || CAST(user_id AS VARCHAR) ELSE '' END AS shopName,
        CASE WHEN event_id % 11 <> 0 THEN 'gid://partners/Shop/' || CAST(user_id AS VARCHAR) ELSE '' END AS shopId,
        'billing app' AS appName,
        CASE WHEN event_id % 7 <> 0 THEN 'changed  by ' || event_type ELSE '' END AS reason,
        CASE WHEN event_id % 7 <> 0 THEN value ELSE 0.0 END AS chargeAmount,
        CASE WHEN event_id % 7 <> 0 THEN 'USD' ELSE '' END AS currencyCode,
        CASE WHEN event_id % 7 <> 0 THEN strftime({_T}, '%Y-%m-%d') ELSE '' END AS billingOn,
        CASE WHEN event_id % 7 <> 0 THEN CAST(user_id * 100 + {_K} % 50 AS VARCHAR) ELSE '' END AS chargeId,
        CASE WHEN event_id % 7 <> 0 THEN {_PLAN} ELSE '' END AS chargeName,
        {_CURSOR} AS cursor
    FROM events"""


TX_TYPED = f"tx AS ({_tx(_T)})"
TX_DAYS = f"txd AS (SELECT *, CAST(createdAt AS DATE) AS dt FROM tx)"
EV_TYPED = f"ev AS ({_ev(_T)})"
LATEST = f"latest AS (SELECT max(dt) AS latest_dt FROM txd WHERE dt <> {LANDING})"

_AUDIT_COLS = ("eventtype", "occurredat", "shopdomain", "shopid", "chargeamount", "chargeid", "chargename", "cursor")


def _audit_row(c: str, everywhere: bool = False) -> str:
    counted = everywhere or c == S.UNIQUE_KEY_COLUMN
    distinct = f"count(DISTINCT {c})" if counted else "NULL::BIGINT"
    allow_null = "false" if (c in S.DATETIME_COLUMNS or c == S.UNIQUE_KEY_COLUMN) else "true"
    allow_dup = "false" if c == S.UNIQUE_KEY_COLUMN else "true"
    return f"""SELECT '{c}' AS "column", {allow_null} AS allow_null, {allow_dup} AS allow_duplicated,
        count(*) AS rows, count(*) - count({c}) AS null_count,
        count({c}) - {distinct} AS duplicate_count, {distinct} AS distinct_values
    FROM sub_events"""


_VIOLATED = """(NOT allow_null AND null_count > 0)
        OR (NOT allow_duplicated AND coalesce(duplicate_count > 0, false)) AS violated"""


def _audit(everywhere: bool = False) -> str:
    from .oracle import SUB_EVENTS_CTE
    body = "\n    UNION ALL\n    ".join(_audit_row(c, everywhere) for c in _AUDIT_COLS)
    return f"""WITH {SUB_EVENTS_CTE}, a AS ({body})
SELECT *, {_VIOLATED}
FROM a"""


ARRIVALS_CTE = f"""k AS (
    SELECT event_id, user_id,
        CASE WHEN event_id % 13 = 0 THEN 'postgres' ELSE 'mongodb' END AS src,
        CASE WHEN event_id % 17 = 0 THEN 'billing' ELSE 'billing-' || event_type END AS folder,
        CASE WHEN event_id % 3 = 0 THEN '%3D' ELSE '=' END AS eq,
        'part' || CASE WHEN event_id % 5 = 0 THEN '+' ELSE '-' END || CAST(event_id AS VARCHAR) || '.json' AS fname,
        strftime({_T}, '%Y-%m-%d') AS day
    FROM events)
, keyed AS (
    SELECT user_id * 1000 + event_id % 1000 AS size,
        CASE WHEN event_id % 101 = 0 THEN '' WHEN event_id % 19 = 0 THEN src || '/' || folder || '/100%zz/' || fname
             WHEN event_id % 11 = 0 THEN src || '/' || folder || '/' || fname
             ELSE src || '/' || folder || '/dt' || eq || day || '/' || fname END AS key
    FROM k)
, unreadable AS (
    SELECT NULL::BIGINT AS size, '' AS key, 'Unknown' AS event_source, 'Unknown' AS region, 'Unknown' AS event_name,
        'Unknown' AS bucket FROM region)
, decoded AS (
    SELECT *, CASE WHEN contains(key, '%zz') THEN key ELSE url_decode(key) END AS dk FROM (
        SELECT size, key, 'aws:s3' AS event_source, 'region-1' AS region, 'ObjectCreated:Put' AS event_name,
            'landing' AS bucket FROM keyed UNION ALL SELECT * FROM unreadable))
, parsed AS (
    SELECT event_source, region, event_name, bucket, key, size, dk AS decoded_key,
        CASE WHEN contains(dk, 'dt=') THEN replace(rtrim(split_part(dk, 'dt=', 1), '/'), '/', '-')
             ELSE replace(dk, '/', '-') END AS object_prefix,
        CASE WHEN contains(dk, 'dt=') THEN split_part(split_part(dk, 'dt=', 2), '/', 1) END AS partition_value,
        len(string_split(dk, '/')) >= 2 AND string_split(dk, '/')[1] = 'mongodb' AS fits,
        coalesce(string_split(dk, '/')[2], '') AS db_coll
    FROM decoded)
, arrivals AS (
    SELECT event_source, region, event_name, bucket, key, size, decoded_key, object_prefix, partition_value,
        CASE WHEN fits AND position('-' IN db_coll) > 0 THEN split_part(db_coll, '-', 1) END AS database,
        CASE WHEN fits AND position('-' IN db_coll) > 0
             THEN substr(db_coll, position('-' IN db_coll) + 1) END AS collection,
        CASE WHEN NOT fits OR position('-' IN db_coll) = 0 THEN 'Error' ELSE 'Success' END AS status,
        CASE WHEN key = '' THEN '{S.MSG_NO_KEY}' WHEN NOT fits THEN '{S.MSG_OTHER_KEY}' || decoded_key
             WHEN position('-' IN db_coll) = 0 THEN '{S.MSG_NO_COLLECTION}' END AS message
    FROM parsed)"""


_EV_NAMES = ("eventType", "occurredAt", "shopDomain", "shopName", "shopId", "appName", "reason", "chargeAmount",
             "currencyCode", "billingOn", "chargeId", "chargeName", "cursor")
_LOWER = ", ".join(f"{c} AS {c.lower()}" for c in _EV_NAMES)
CURATED = f"SELECT {_LOWER}, CAST(occurredAt AS DATE) AS dt FROM ev"
_BAD = f"(CAST(cursor AS BIGINT) % 5 = 0 AND (day = DATE '{BAD_DAY.isoformat()}' OR CAST(cursor AS BIGINT) % 53 = 0))"
MIXED = f"""days AS (SELECT *, CAST(occurredAt AS DATE) AS day FROM ev)
, mixed AS (SELECT *, {_BAD} AS bad, CASE WHEN CAST(cursor AS BIGINT) % 53 <> 0 THEN day END AS dt FROM days)"""


def _audit_curated() -> str:
    body = "\n    UNION ALL\n    ".join(_audit_row(c.lower()) for c in _EV_NAMES)
    return f"""WITH {EV_TYPED}, sub_events AS (
    SELECT * REPLACE (NULLIF(shopid, '') AS shopid) FROM (SELECT {_LOWER} FROM ev)), a AS ({body})
SELECT *, {_VIOLATED}
FROM a"""


# two landings by page: the second one re-reads from the day before the latest day of the first
PARTS = f"""parts AS (SELECT *, (CAST(cursor AS BIGINT) // 100) % 2 AS part FROM txd)
, first_latest AS (SELECT max(dt) AS latest_dt FROM parts WHERE part = 0 AND dt <> {LANDING})"""

FIRST, SECOND = (f"DATE '{d.isoformat()}'" for d in (FIRST_AS_OF, SECOND_AS_OF))
GROWN = f"""CASE WHEN createdAt < {SPLIT} THEN CAST(cursor AS BIGINT) % 1000 ELSE CAST(cursor AS BIGINT) + 5000000000 END AS units,
        CAST(CAST(cursor AS BIGINT) % 7 + CASE WHEN createdAt < {SPLIT} THEN 0 ELSE 0.5 END AS DOUBLE) AS rate,
        CASE WHEN createdAt < {SPLIT} THEN '' ELSE 'no ' END || CAST(CAST(cursor AS BIGINT) % 10 AS VARCHAR) AS note"""

ORACLES = {
    "flatten_transactions": _tx(f"strftime({_T}, {_ISO})"),
    "flatten_events": _ev(f"strftime({_T}, {_ISO})"),
    "conform_transactions": _tx(_T),
    "conform_events": _ev(_T),
    "sanitize_text": "SELECT doc_id, replace(replace(text, chr(10), ' '), chr(13), ' ') AS text FROM documents",
    "daily_overwrite": f"WITH {TX_TYPED}, {TX_DAYS} SELECT * FROM txd",
    "ingest_pages": f"WITH {TX_TYPED}, {TX_DAYS} SELECT * FROM txd",
    "ingest_partial_day": f"""WITH {TX_TYPED}, {TX_DAYS}, {PARTS}
        SELECT parts.* EXCLUDE (part) FROM parts, first_latest
        WHERE part = 0 OR dt >= latest_dt - 1""",
    "ingest_quarantine": f"""WITH {TX_TYPED}
        SELECT 'landed' AS reason, count(*) AS rows FROM tx
        UNION ALL SELECT 'no edges', count(*) FROM region UNION ALL SELECT 'no time', count(*) FROM nation""",
    "ingest_late_rows": f"""WITH {TX_TYPED}, {TX_DAYS}
        , e AS (SELECT id, cursor, grossAmount, dt, CAST(cursor AS BIGINT) % 4 = 0 AS again,
                       (CAST(cursor AS BIGINT) // 100) % 2 = 0 AS early FROM txd)
        , keyless AS (SELECT n_name AS id, NULL::VARCHAR AS cursor, 1.5::DOUBLE AS grossAmount, DATE '2024-01-20' AS dt,
                             NULL::VARCHAR AS reason FROM nation)
        SELECT id, cursor, CASE WHEN again AND dt <= {SECOND} THEN grossAmount / 2 ELSE grossAmount END AS grossAmount,
               dt, NULL::VARCHAR AS reason
        FROM e WHERE dt <= CASE WHEN again OR NOT early THEN {SECOND} ELSE {FIRST} END
        UNION ALL SELECT id, cursor, grossAmount, NULL, 'future day' FROM e
        WHERE dt > CASE WHEN early THEN {FIRST} ELSE {SECOND} END
        UNION ALL SELECT id, cursor, grossAmount / 2, NULL, 'future day' FROM e WHERE again AND dt > {SECOND}
        UNION ALL SELECT * FROM keyless UNION ALL SELECT * FROM keyless""",
    "ingest_rescued": f"""WITH p AS (SELECT event_id, {_CURSOR} AS cursor FROM events WHERE event_type = 'purchase')
        SELECT cursor, 'taxAmount' AS field, '{{"cents":' || CAST(event_id AS VARCHAR) || '}}' AS value FROM p WHERE event_id % 3 = 0
        UNION ALL SELECT cursor, 'shop.plan', '"plan ' || CAST(event_id % 4 AS VARCHAR) || '"' FROM p
        WHERE event_id % 5 = 0 AND event_id % 7 <> 0""",
    "ingest_released": f"WITH {TX_TYPED}, {TX_DAYS} SELECT * FROM txd",
    "files_by_day_counted": f"""WITH {TX_TYPED}, {TX_DAYS}
        SELECT dt, CAST(2 AS BIGINT) AS files, 2 * count(*) AS rows FROM txd GROUP BY dt""",
    "schema_widened": f"WITH {TX_TYPED}, {TX_DAYS} SELECT *, {GROWN} FROM txd",
    "register_widened": f"WITH {TX_TYPED}, {TX_DAYS} SELECT *, {GROWN} FROM txd",
    "curate_guard": f"""WITH {EV_TYPED}
        SELECT 'text' AS event_time,
               'event time ''occurredAt'' must be a timestamp before the write, it is string' AS error, CAST(0 AS BIGINT) AS rows
        UNION ALL SELECT 'timestamp', NULL, count(*) FROM ev""",
    "stream_corrections": f"""WITH {TX_TYPED}, {TX_DAYS}
        , n AS (SELECT *, CAST(cursor AS BIGINT) AS number FROM txd)
        SELECT * EXCLUDE (number) REPLACE (CASE WHEN number % 50 <> 1 THEN cursor END AS cursor,
            CASE WHEN number % 4 = 0 AND number % 50 <> 1 THEN grossAmount / 2 ELSE grossAmount END AS grossAmount) FROM n""",
    "list_partitions": f"WITH {TX_TYPED}, {TX_DAYS} SELECT dt, count(*) AS rows FROM txd GROUP BY dt",
    "files_by_day": f"""WITH {TX_TYPED}, {TX_DAYS}
        SELECT dt, count(*) AS rows FROM txd GROUP BY dt""",
    "latest_partition": f"WITH {TX_TYPED}, {TX_DAYS}, {LATEST} SELECT * FROM latest",
    "read_latest": f"WITH {TX_TYPED}, {TX_DAYS}, {LATEST} SELECT txd.* FROM txd, latest WHERE dt = latest_dt",
    "incremental_window": f"""WITH {TX_TYPED}, {TX_DAYS}, {LATEST}
        SELECT tx.* FROM tx, latest
        WHERE createdAt < CAST({LANDING} + 1 AS TIMESTAMP)
          AND (latest_dt IS NULL OR createdAt >= CAST(latest_dt - 1 AS TIMESTAMP))""",
    "schema_merge": f"""WITH {TX_TYPED}, {TX_DAYS}
        SELECT *, CASE WHEN createdAt >= {SPLIT} THEN 'late ' || cursor END AS note FROM txd""",
    "register_external": f"WITH {TX_TYPED}, {TX_DAYS} SELECT * FROM txd",
    "register_external_evolved": f"""WITH {TX_TYPED}, {TX_DAYS}
        SELECT *, CASE WHEN createdAt >= {SPLIT} THEN 'late ' || cursor END AS note FROM txd""",
    "curate_report_mixed": f"""WITH {EV_TYPED}, {MIXED}
        SELECT dt, count(*) AS rows, count(*) FILTER (WHERE bad) AS bad_rows, NOT bool_or(bad) AS ok,
            CASE WHEN bool_or(bad) THEN 0 ELSE count(*) END AS written
        FROM mixed GROUP BY dt""",
    "policy_audit_curated": _audit_curated(),
    "stream_curate_relanded": f"""WITH {EV_TYPED}, {MIXED}
        SELECT dt, cursor, CASE WHEN NOT bad THEN occurredAt END AS occurredat, shopId AS shopid, bad AS held
        FROM mixed""",
    "curate_report": f"""WITH {EV_TYPED}
        SELECT CAST(occurredAt AS DATE) AS dt, count(*) AS rows, CAST(0 AS BIGINT) AS bad_rows, true AS ok
        FROM ev GROUP BY 1""",
    "curate_datetimes": f"WITH {EV_TYPED} {CURATED}",
    "policy_audit": _audit(),
    "policy_audit_exact": _audit(everywhere=True),
    "parse_arrivals": f"WITH {ARRIVALS_CTE} SELECT * FROM arrivals",
    "arrivals_summary": f"""WITH {ARRIVALS_CTE}
        SELECT database, collection, partition_value, count(*) AS objects,
               CAST(coalesce(sum(size), 0) AS BIGINT) AS bytes
        FROM arrivals WHERE status = 'Success' GROUP BY 1, 2, 3""",
    "drop_seen_bounded": f"""WITH {TX_TYPED}
        SELECT * FROM tx WHERE createdAt >= {SPLIT} AND cursor NOT IN (
            SELECT cursor FROM tx WHERE createdAt < {SPLIT} + INTERVAL 2 DAY)""",
    "drop_seen": f"""WITH {TX_TYPED}
        SELECT * FROM tx WHERE createdAt >= {SPLIT} AND cursor NOT IN (
            SELECT cursor FROM tx WHERE createdAt < {SPLIT} + INTERVAL 2 DAY)""",
    "stream_curate": f"WITH {EV_TYPED} {CURATED}",
    "stream_late_dedup": f"WITH {TX_TYPED}, {TX_DAYS} SELECT * FROM txd",
}
# the same landed rows by other ways
ORACLES["ingest_deltas"] = ORACLES["stream_deltas"] = ORACLES["stream_corrections"]
ORACLES["policy_audit_daily"] = ORACLES["policy_audit_curated"]
