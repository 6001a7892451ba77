"""Ordered aggregates.

The source keeps ordered string lists per group and reads element 0; only
the first non-NULL value in rank order is ever used, so the aggregate keeps
just that: ``min_by`` over the rank with NULL values masked out. Memory per
group is one value, whatever the group size.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_by_rank(value: Column | str, rank: Column) -> Column:
    """First non-NULL ``value`` in ascending ``rank`` order (NULL when there is none).

    ``rank`` may be a struct for multi-column orders; its NULL fields sort first.
    """
    v = F.col(value) if isinstance(value, str) else value
    return F.min_by(v, F.when(v.isNotNull(), rank))


def any_true(cond: Column) -> Column:
    """EXISTS as an aggregate: true when any row satisfies ``cond``, false otherwise."""
    return F.coalesce(F.max(cond.cast("boolean")), F.lit(False))
