"""Bronze -> curated: event-time columns become timestamps, names lower case, bad days are held back.

The whole base folder is one Spark job (not a loop over days) that reads it once. Each
day gets a report row (rows, rows whose time did not parse); a day with any bad row
is held back and reported, the rest is written.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lineage import cut, remove_path
from ..sources import catalog, raw, sinks

# Original casing first; the lower-case name is the fallback.
DATETIME_PAIRS = (("occurredAt", "occurredat"), ("createdAt", "createdat"))


class CurateError(RuntimeError):
    pass


def _to_instant(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampType):
        return c
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp")
    return F.try_to_timestamp(c.cast("string"))


def datetime_columns(df: DataFrame, pairs=DATETIME_PAIRS) -> list[str]:
    """Names to convert: for each pair the original casing if present, else the lower case."""
    found = []
    for original, lower in pairs:
        if original in df.columns:
            found.append(original)
        elif lower in df.columns:
            found.append(lower)
    return found


def convert_datetimes(df: DataFrame, pairs=DATETIME_PAIRS) -> DataFrame:
    """Cast the configured event-time columns to ``timestamp`` (unparsable text -> NULL)."""
    for name in datetime_columns(df, pairs):
        df = df.withColumn(name, _to_instant(F.col(name), df.schema[name].dataType))
    return df


def lower_names(df: DataFrame) -> DataFrame:
    """Canonical lower-case names; columns that differ in case only become one (first non-NULL value)."""
    groups: dict[str, list[str]] = {}
    for c in df.columns:
        groups.setdefault(c.lower(), []).append(c)
    return df.select(*[(F.coalesce(*map(F.col, same)) if len(same) > 1 else F.col(same[0])).alias(name)
                       for name, same in groups.items()])


def flag_unreadable(bronze: DataFrame, pairs=DATETIME_PAIRS) -> DataFrame:
    """Converted rows with ``_bad``: whether a non-NULL event time failed to parse."""
    names = datetime_columns(bronze, pairs)
    kept, bad = bronze, F.lit(False)
    for n in names:
        kept = kept.withColumn(f"_raw_{n}", F.col(n))
    conv = convert_datetimes(kept, pairs)
    for n in names:
        bad = bad | (F.col(f"_raw_{n}").isNotNull() & F.col(n).isNull())
    return conv.withColumn("_bad", bad).drop(*[f"_raw_{n}" for n in names])


def curate_all(bronze: DataFrame, pairs=DATETIME_PAIRS) -> tuple[DataFrame, DataFrame]:
    """(good rows, per-day report). A day is bad when any non-NULL time fails to parse."""
    conv = flag_unreadable(bronze, pairs)
    report = (conv.groupBy("dt")
              .agg(F.count(F.lit(1)).alias("rows"), F.count_if("_bad").alias("bad_rows"))
              .withColumn("ok", F.col("bad_rows") == 0))
    return lower_names(_good_days(conv.drop("_bad"), report)), report


def _good_days(df: DataFrame, report: DataFrame) -> DataFrame:
    """Rows of the days that are fine (the day of rows without one is NULL, which equals itself here)."""
    bad = report.where(~F.col("ok")).select(F.col("dt").alias("_bad_dt"))
    return df.join(bad, F.col("dt").eqNullSafe(F.col("_bad_dt")), "left_anti")


def curate(spark: SparkSession, bronze_path: str, curated_path: str, table: str | None = None,
           database: str | None = None, dt=None, pairs=DATETIME_PAIRS) -> DataFrame:
    """Full curate job; returns the per-day report.

    Fails when there is no partition at all or no partition was good; writes
    good days (replacing those days), then registers the table when named.
    ``dt`` restricts the run to one day folder or a list of them (the arrival-triggered
    case): only these folders are read and only these days replaced. ``pairs`` names the
    event-time columns. A new database lies beside the curated folder.

    The source is read once: all rows are converted and written to a folder beside the curated
    one, by day and by whether their times could be read. Counting these rows reads footers only,
    and the folder of a good day is moved to its place; those of other days are dropped.
    """
    if dt is not None:
        wanted = [as_date(d) for d in (dt if isinstance(dt, (list, tuple, set)) else [dt])]
        bronze = sinks.stored_days(spark, bronze_path.rstrip("/"), wanted)
        if bronze is None:
            raise CurateError(f"no folder for day {', '.join(map(str, wanted))} under {bronze_path}")
    else:
        bronze = raw.read_raw(spark, bronze_path, merge_schema=True)
    curated_path = curated_path.rstrip("/")
    rows = lower_names(flag_unreadable(bronze, pairs))
    sinks.require_timestamp(rows)
    stage = f"{curated_path}-stage-{uuid.uuid4().hex[:12]}"
    try:
        rows.write.partitionBy("dt", "_bad").parquet(stage)
        counted = (spark.read.schema(rows.schema).parquet(stage).groupBy("dt", "_bad").count()
                   .groupBy("dt").agg(F.sum("count").alias("rows"),
                                      F.coalesce(F.sum(F.when(F.col("_bad"), F.col("count"))), F.lit(0)).alias("bad_rows"))
                   .withColumn("ok", F.col("bad_rows") == 0))
        report = cut(counted)
        days = [r["dt"] for r in report.where("ok").select("dt").collect()]   # at most one a day folder
        if not days and report.isEmpty():
            raise CurateError(f"nothing to curate under {bronze_path}")
        if not days:
            raise CurateError("every day holds event times that can't be read")
        for day in days:
            folder = sinks.day_folder(day)
            sinks.move_folder(spark, f"{stage}/{folder}/_bad=false", f"{curated_path}/{folder}")
    finally:
        remove_path(spark, stage)
    if database:
        parent = curated_path.rsplit("/", 1)[0]
        catalog.ensure_database(spark, database.lower(), f"{parent}/{database.lower()}.db")
    if table:
        name = f"{database}.{table}" if database else table
        if None in days:   # rows without a day are found by a repair only
            catalog.register_external(spark, name, curated_path)
        else:
            catalog.register_days(spark, name, curated_path, rows.drop("_bad").schema, days)
    return report


def as_date(value) -> datetime.date:
    return value if isinstance(value, datetime.date) else datetime.date.fromisoformat(str(value))
