"""Column profiles per day, kept as tables and merged: an audit reads a new day once and no day twice.

``refresh_profiles`` profiles the given days of a day-partitioned table in one aggregate: rows, NULLs,
least and largest value and a HyperLogLog sketch of every column, and for columns that must not repeat
the exact count of each value. All of these add up over days, so ``profile_audit`` gives what
``quality.policy_audit`` finds by reading the whole table. The sketches give the other columns' distinct values
within a few percent (``profile_summary``).

Stored as ``<base>/columns`` and ``<base>/keys`` with a folder a month (a folder a day would make thousands of
tiny files); a refresh rewrites the months of its days. Days without rows lose their profile. Rows of no
day are a day of their own (``None``). Columns that a day lacks count as NULL there.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.lineage import remove_path, staged
from ..sources import sinks
from .quality import verdicts

COLUMN_SCHEMA = ("dt date, column string, rows bigint, null_count bigint, least string, largest string, sketch binary, "
                 "month date")
KEY_SCHEMA = "dt date, column string, value string, n bigint, month date"
#: types whose values have an order and come back from their text unchanged
ORDERED = (T.StringType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def _ordered(kind: T.DataType) -> bool:
    return isinstance(kind, ORDERED)


def day_profiles(df: DataFrame) -> DataFrame:
    """(dt, column, rows, null_count, least, largest, sketch): one row per day and column, in one pass with partial sums."""
    fields = [f for f in df.schema.fields if f.name != "dt"]

    def parts(i: int, f: T.StructField) -> list[Column]:
        c = F.col(f"`{f.name}`")
        ends = [F.min(c), F.max(c)] if _ordered(f.dataType) else [F.lit(None), F.lit(None)]
        return [F.count_if(c.isNull()).alias(f"n{i}"), ends[0].cast("string").alias(f"a{i}"),
                ends[1].cast("string").alias(f"z{i}"), F.hll_sketch_agg(c.cast("string")).alias(f"s{i}")]

    days = df.groupBy("dt").agg(F.count(F.lit(1)).alias("rows"), *[x for i, f in enumerate(fields) for x in parts(i, f)])
    each = F.array(*[F.struct(F.lit(f.name.lower()).alias("column"), F.col(f"n{i}").alias("null_count"),
                              F.col(f"a{i}").alias("least"), F.col(f"z{i}").alias("largest"),
                              F.col(f"s{i}").alias("sketch")) for i, f in enumerate(fields)])
    return days.select("dt", "rows", F.explode(each).alias("c")).select(
        "dt", "c.column", "rows", "c.null_count", "c.least", "c.largest", "c.sketch")


def day_keys(df: DataFrame) -> DataFrame:
    """(dt, column, value, n): how often each value occurs in a day, for the columns that must not repeat."""
    keys = [f.name for f in df.schema.fields if f.name.lower() == S.UNIQUE_KEY_COLUMN]
    value = F.col(f"`{keys[0]}`").cast("string") if keys else F.lit(None).cast("string")
    return (df.select("dt", F.lit(S.UNIQUE_KEY_COLUMN).alias("column"), value.alias("value")).where(F.col("value").isNotNull())
            .groupBy("dt", "column", "value").agg(F.count(F.lit(1)).alias("n")))


def _of_days(days) -> Column:
    named = [d for d in days if d is not None] or [dt.date.min]
    return F.when(F.col("dt").isNull(), F.lit(None in days)).otherwise(F.col("dt").isin(named))


def _replace(spark: SparkSession, new: DataFrame | None, path: str, days, schema: str) -> None:
    """Make the stored rows of the given days those of ``new``; other months are neither read nor written."""
    months = {d and d.replace(day=1) for d in days}
    folders = {m: f"{path}/month={m.isoformat() if m else '__HIVE_DEFAULT_PARTITION__'}" for m in months}
    held = [f for f in folders.values() if sinks.path_exists(spark, f)]
    parts = [] if new is None else [new.withColumn("month", F.trunc("dt", "month"))]
    if held:
        old = spark.read.option("basePath", path).schema(schema).parquet(*held)
        parts.append(old.where(~_of_days(days)))
    if not parts:
        return
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    with staged(rows) as done:
        built = {r[0] for r in done.select("month").distinct().collect()}   # at most one row a month
        if built:
            (done.repartitionByRange("month", "dt", *[c for c in ("value",) if c in done.columns]).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path))
        for m in months - built:
            remove_path(spark, folders[m])


def refresh_profiles(spark: SparkSession, table: str, base: str, days, schema: T.StructType | None = None) -> None:
    """Profile the given days of the table at ``table`` anew; no other day of it is read."""
    days = list(days)
    rows = sinks.stored_days(spark, table, days, schema)
    _replace(spark, None if rows is None else day_profiles(rows), f"{base}/columns", days, COLUMN_SCHEMA)
    _replace(spark, None if rows is None else day_keys(rows), f"{base}/keys", days, KEY_SCHEMA)


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if sinks.path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def profile_summary(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """(column, rows, null_count, distinct_values, least, largest, about_values) over all profiled days.

    ``distinct_values`` is exact for columns that must not repeat, else NULL; ``about_values`` is the
    sketches' estimate; ``least`` and ``largest`` are texts of the table's own order.
    """
    stored, keys = _stored(spark, f"{base}/columns", COLUMN_SCHEMA), _stored(spark, f"{base}/keys", KEY_SCHEMA)
    fields = [f for f in schema.fields if f.name != "dt"]

    def end(of, name: str) -> Column:
        # a column's texts go back to its type to be compared
        found = F.lit(None).cast("string")
        for f in fields:
            if _ordered(f.dataType):
                mine = F.when(F.col("column") == f.name.lower(), F.col(name).try_cast(f.dataType))
                found = F.coalesce(found, of(mine).cast("string"))
        return found.alias(name)

    total = stored.groupBy("dt").agg(F.max("rows").alias("rows")).agg(F.coalesce(F.sum("rows"), F.lit(0))).scalar()
    per = stored.groupBy("column").agg(F.sum(F.col("rows") - F.col("null_count")).alias("filled"), end(F.min, "least"),
                                       end(F.max, "largest"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("about"))
    values = (keys.groupBy("column", "value").agg(F.sum("n").alias("n"))
              .groupBy("column").agg(F.count("value").alias("distinct_values")))
    names = spark.range(1).select(F.explode(F.array(*[F.lit(f.name) for f in fields])).alias("name"))
    low = F.lower("name")
    return (names.join(per, low == per["column"], "left").drop("column")
            .join(values, low == values["column"], "left").drop("column")
            .select(F.col("name").alias("column"), total.alias("rows"),
                    (total - F.coalesce("filled", F.lit(0))).alias("null_count"),
                    F.when(low == S.UNIQUE_KEY_COLUMN, F.coalesce("distinct_values", F.lit(0))).alias("distinct_values"),
                    "least", "largest", F.coalesce("about", F.lit(0)).cast("bigint").alias("about_values")))


def profile_audit(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """The policy audit (``quality.policy_audit``) of all profiled days, from their profiles alone."""
    return verdicts(profile_summary(spark, base, schema))
