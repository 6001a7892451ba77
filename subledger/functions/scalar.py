"""Column rules of the billing jobs, as built-in Spark expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_date(as_of: dt.date | str | Column | None) -> Column:
    """The job's reference date; ``None`` means today (not repeatable)."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of)))


def sanitize(c: Column | str) -> Column:
    """Each newline and each carriage return becomes one space (no collapsing)."""
    return F.translate(_c(c), "\n\r", "  ")


def nested(c: Column, default) -> Column:
    """NULL-safe nested value with a default (struct access already yields NULL)."""
    return F.coalesce(c, F.lit(default))


def money(c: Column | str) -> Column:
    """Parse an amount (string or number) with 0.0 as the default."""
    return F.coalesce(_c(c).cast("double"), F.lit(0.0))


def numeric_id(c: Column | str) -> Column:
    """Trailing digits of a global id as BIGINT; NULL when there are none or they overflow."""
    digits = F.regexp_extract(_c(c), r"([0-9]+)$", 1)
    return F.when(digits != "", digits).try_cast("bigint")


def subscription_event(c: Column | str) -> Column:
    """``LIKE '%SUBSCRIPTION_CHARGE%'`` plus a pushable ``contains`` conjunct."""
    c = _c(c)
    return c.contains("SUBSCRIPTION") & c.like(S.SUBSCRIPTION_EVENT_PATTERN)


def pricing_plan(charge_name: Column | str, free_label: str = S.FREE_PLAN_LABEL) -> Column:
    c = _c(charge_name)
    return F.when(c.like(S.FREE_PLAN_PATTERN), F.lit(free_label)).otherwise(c)


def interval_end(next_activation: Column | str, deactivated: Column | str, open_end: Column) -> Column:
    """End of a subscription interval: the earlier of next activation and next event."""
    n, d = _c(next_activation), _c(deactivated)
    return (F.when(n < d, n)
            .when(d.isNull() & n.isNotNull(), n)
            .when(d.isNull() & n.isNull(), open_end)
            .otherwise(d))


def interval_distance(ts: Column | str, start: Column | str, end: Column | str) -> Column:
    """0 inside [start, end]; calendar days since end after it; 999999 otherwise."""
    t, s, e = _c(ts), _c(start), _c(end)
    return (F.when(t.between(s, e), F.lit(0))
            .when(t > e, F.datediff(F.to_date(t), F.to_date(e)))
            .otherwise(F.lit(S.NOT_STARTED_DISTANCE)))


def sale_label(id_col: Column | str, plan: Column | str) -> Column:
    """Sale-type label from the id pattern; rule order matters."""
    i, p = _c(id_col), _c(plan)
    expr = None
    for pattern, only_without_plan, label in S.SALE_LABEL_RULES:
        cond = i.like(pattern) & p.isNull() if only_without_plan else i.like(pattern)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(p)


def relationship_status(event_type: Column | str) -> Column:
    c = _c(event_type)
    return (F.when(c.isin(*S.RELATIONSHIP_ACTIVE_EVENTS), F.lit(S.STATUS_ACTIVE))
            .when(c.isin(*S.RELATIONSHIP_INACTIVE_EVENTS), F.lit(S.STATUS_INACTIVE)))


def month_start(c: Column | str) -> Column:
    return F.trunc(F.to_date(_c(c)), "month")


def decode_key(c: Column | str) -> Column:
    """Percent-decoding that keeps a literal ``+`` (url_decode alone makes it a space).

    A key that isn't valid percent-encoding is left as it is.
    """
    return F.coalesce(F.try_url_decode(F.replace(_c(c), F.lit("+"), F.lit("%2B"))), _c(c))
