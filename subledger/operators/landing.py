"""Landing job: API page documents -> day-partitioned bronze table.

pages -> edges -> flat rows -> bronze schema -> merged by cursor with the stored
rows of their days, the row that landed last stays -> those days replaced ->
external table, of which only these days are registered. The pages are parsed
once: the flat rows are staged, and the checks, the quarantine and the write read
the stage. Re-running over the same pages changes nothing; pages that hold only a
part of a day add to that day; rows of days long past join them.

Pages without an edge path, rows without an event time and rows of days to come
go to a quarantine folder beside the table (reason, json), one file set per run.
What has been handed over is in the one or the other.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.lineage import staged
from ..functions.scalar import as_of_date
from ..sources import catalog, pages, raw, sinks
from .flatten import flatten


def placed_rows(flat: DataFrame, ts: str, latest: dt.date | None, today: dt.date, late: str = "merge") -> DataFrame:
    """``flat`` with ``reason``: why a row is held back, NULL for the rows to land.

    The window starts one day before the latest landed day and ends with ``today``. Rows before it
    are late: they are merged into their day like any other (``late="merge"``) or held
    (``late="hold"``). Rows of a later day than ``today`` are held, whatever ``late`` says.
    """
    if late not in ("merge", "hold"):
        raise ValueError(f"late rows are merged or held, not {late!r}")
    day = F.to_date(F.col(ts))
    reason = (F.when(F.col("_page").isNotNull(), F.lit("no edges"))
              .when(F.col(ts).isNull(), F.lit("no time"))
              .when(day > F.lit(today), F.lit("future day")))
    if late == "hold" and latest is not None:
        reason = reason.when(day < F.lit(latest - dt.timedelta(days=1)), F.lit("late day"))
    return flat.withColumn("reason", reason)


def ingest_pages(spark: SparkSession, docs: DataFrame, api_type: str, base: str, as_of=None,
                 table: str | None = None, json_col: str = "json", on_missing: str = "raise",
                 quarantine: str | None = None, late: str = "merge", at: Column | None = None,
                 order: Column | None = None, rescue: bool = False) -> DataFrame:
    """Land the rows carried by ``docs``; returns the days written in this run.

    Every row is afterwards in the table or in the quarantine (default ``<base>-quarantine``), which
    holds (reason, json). Of rows with one cursor the one that landed last stays; ``at`` and
    ``order`` say when a page was fetched and its place in the fetch (``explode_pages``). With
    ``rescue`` fields that the feed's schema lacks are stored in ``_rescued`` (``pages.rescued_fields``).
    """
    base = base.rstrip("/")
    ts, schema = S.BRONZE_TIME_COLUMN[api_type], S.bronze_schema(api_type)
    rows = pages.explode_pages(docs, api_type, json_col, at, order, rescue)
    keep = ("_page", sinks.SEQ, *(["_rescued"] if rescue else []))
    flat = sinks.conform(flatten(rows, api_type, keep=keep), api_type, keep=keep)
    today = as_of or dt.date.today()
    days = [d for d in raw.landed_days(spark, base) if d != today]
    with staged(placed_rows(flat, ts, days[-1] if days else None, today, late)) as stage:
        held = stage.where(F.col("reason").isNotNull())
        if on_missing == "raise" and not held.where(F.col("_page").isNotNull()).isEmpty():
            raise pages.PageShapeError(f"a page of feed type {api_type!r} has no edge list")
        held = held.select("reason", F.coalesce("_page", F.to_json(F.struct(*schema.names, *keep[1:]), sinks.JSON_TIMES)).alias("json"))
        if not held.isEmpty():
            held.write.mode("append").parquet(quarantine or f"{base}-quarantine")
        good = stage.where(F.col("reason").isNull()).drop("_page", "reason").withColumn("dt", F.to_date(F.col(ts)))
        columns = good.schema
        touched = sinks.merge_days(good, base, ts, schema=None)
    if table:
        catalog.register_days(spark, table, base, columns, touched)
    stored = sinks.stored_days(spark, base, touched)
    if stored is None:
        return spark.createDataFrame([], columns)
    return stored


def release_held(spark: SparkSession, quarantine: str, api_type: str, base: str, as_of=None) -> list[dt.date]:
    """Land the held rows whose day has come (reasons ``future day`` and ``late day``); the others stay held.

    The rows keep the order in which they first landed. Running it again changes nothing: the
    quarantine is a record and keeps its rows, and the merge knows them by cursor.
    """
    ts = S.BRONZE_TIME_COLUMN[api_type]
    seq = T.StructType().add("at", T.TimestampType()).add("page", T.LongType()).add("edge", T.IntegerType())
    schema = T.StructType([*S.bronze_schema(api_type).fields, T.StructField(sinks.SEQ, seq)])
    held = spark.read.schema("reason string, json string").parquet(quarantine)
    rows = (held.where(F.col("reason").isin("future day", "late day")).select(F.from_json("json", schema, sinks.JSON_TIMES).alias("r"))
            .select("r.*").withColumn("dt", F.to_date(F.col(ts))).where(F.col("dt") <= as_of_date(as_of)))
    with staged(rows) as due:
        return sinks.merge_days(due, base.rstrip("/"), ts)
