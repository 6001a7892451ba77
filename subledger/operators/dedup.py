"""Drop rows already loaded, by cursor (an anti join on the key)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_seen(new: DataFrame, seen: DataFrame, key: str = "cursor", bounded: bool = False) -> DataFrame:
    """Rows of ``new`` whose ``key`` is not in ``seen``.

    Only the key column of ``seen`` is read (pruned at the scan); Spark picks
    broadcast or sort-merge by the measured size, with AQE re-planning.
    ``bounded`` first takes the least and greatest key of ``new`` and reads only that range of
    ``seen``: no other row can match, and Parquet skips the row groups outside of it, so against a
    long history with growing keys the work follows the batch.
    """
    known = seen.select(key)
    if bounded:
        low, high = new.agg(F.min(key), F.max(key)).first()
        known = known.where(F.col(key).between(F.lit(low), F.lit(high))) if low is not None else known.limit(0)
    return new.join(known, key, "left_anti")
