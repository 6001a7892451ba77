"""Catalog side: database, external day-partitioned tables, merged schemas."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.lineage import staged
from . import raw, widening

#: partitions added by one ALTER TABLE
DAYS_A_STATEMENT = 500

_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?$")


def _check_name(name: str) -> str:
    if not _NAME.match(name):
        raise ValueError(f"not a table or database name: {name!r}")
    return name


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """CREATE DATABASE IF NOT EXISTS (optionally at an explicit location)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_check_name(name)}{loc}")


def register_external(spark: SparkSession, name: str, path: str, partition_cols=("dt",)) -> DataFrame:
    """Create-if-absent Parquet table over ``path`` and (re)discover its day partitions.

    A partitioned table over existing folders reads no rows until its
    partitions are recovered, hence the REPAIR after the CREATE. A table that
    exists gains the columns that later days brought. Names are lower case.
    """
    name = _check_name(name).lower()
    parts = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    schema_df = spark.read.option("mergeSchema", "true").parquet(path)
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema_df.schema.fields)
    if spark.catalog.tableExists(name):
        known = {c.lower() for c in spark.table(name).columns}
        new = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema_df.schema.fields if f.name.lower() not in known]
        if new:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(new)})")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{parts} LOCATION '{path}'")
    if partition_cols:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def _columns(fields) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def _add_days(spark: SparkSession, name: str, days, column: str) -> None:
    specs = [f"PARTITION ({column} = DATE '{d.isoformat()}')" for d in days if d is not None]
    for i in range(0, len(specs), DAYS_A_STATEMENT):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(specs[i:i + DAYS_A_STATEMENT])}")


def register_days(spark: SparkSession, name: str, path: str, schema: T.StructType, days, column: str = "dt") -> None:
    """Bring the table up to date with a write of these ``days``, whose rows had ``schema`` (with the day column).

    The table's own schema is in the catalog and that of the write is known, so no footer is read, and
    only the written days become partitions: the cost follows the write, not the days stored. Only a
    table that doesn't exist yet lists the folder once, names only. New columns are added. A column
    that became wider is widened: days whose files Parquet's reader can't read in the wider type are
    rewritten. Names are lower case.
    """
    name = _check_name(name).lower()
    written = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields if f.name != column])
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} ({_columns([*written.fields, T.StructField(column, T.DateType())])}) "
                  f"USING parquet PARTITIONED BY ({column}) LOCATION '{path}'")
        _add_days(spark, name, raw.landed_days(spark, path), column)
        return
    stored = T.StructType([f for f in spark.table(name).schema.fields if f.name != column])
    wide = widening.wider_schema(stored, written)
    types = {f.name.lower(): f.dataType for f in stored.fields}
    new = [f for f in wide.fields if f.name.lower() not in types]
    if any(types.get(f.name.lower(), f.dataType) != f.dataType for f in wide.fields):
        widen_table(spark, name, path, wide, column)
    else:
        if new:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_columns(new)})")
        if not _fits(written, wide):   # narrower than the table, in a way its reader doesn't bridge
            _rewrite(spark, path, [f"{path}/{column}={d.isoformat()}" for d in days if d is not None], wide, column)
    _add_days(spark, name, days, column)
    spark.catalog.refreshTable(name)


def _readable(have: T.DataType, want: T.DataType) -> bool:
    """Whether Parquet's vectorised reader reads files of the one type in the other."""
    if have == want:
        return True
    small = (T.ByteType, T.ShortType, T.IntegerType)
    return (isinstance(have, small) and isinstance(want, (*small, T.LongType, T.DoubleType))) \
        or (isinstance(have, T.FloatType) and isinstance(want, T.DoubleType))


def _fits(have: T.StructType, wide: T.StructType) -> bool:
    types = {f.name.lower(): f.dataType for f in wide.fields}
    return all(_readable(f.dataType, types.get(f.name.lower(), f.dataType)) for f in have.fields)


def _rewrite(spark: SparkSession, path: str, folders: list[str], wide: T.StructType, column: str) -> None:
    """Replace the days of these folders by the same rows in the wider types."""
    target = T.StructType([*wide.fields, T.StructField(column, T.DateType())])
    with staged(widening.conformed(widening.read_widened(spark, path, folders), target)) as stage:
        (stage.repartitionByRange(column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(column).parquet(path))


def widen_table(spark: SparkSession, name: str, path: str, wide: T.StructType, column: str = "dt") -> None:
    """Declare the table anew with wider columns; days that can't be read in them are rewritten."""
    paths = [f"{path}/{column}={d.isoformat()}" for d in raw.landed_days(spark, path)]
    for own, schema in widening.schema_groups(spark, path, paths):
        if not _fits(T.StructType([f for f in schema.fields if f.name != column]), wide):
            folders = sorted({p if p.rsplit("/", 1)[-1].startswith(f"{column}=") else p.rsplit("/", 1)[0] for p in own})
            _rewrite(spark, path, folders, wide, column)
    spark.sql(f"DROP TABLE {name}")    # external: the files stay
    spark.sql(f"CREATE TABLE {name} ({_columns([*wide.fields, T.StructField(column, T.DateType())])}) "
              f"USING parquet PARTITIONED BY ({column}) LOCATION '{path}'")
    _add_days(spark, name, raw.landed_days(spark, path), column)


def discover_schema(spark: SparkSession, path: str) -> DataFrame:
    """Read all partitions with combined schemas: new columns appear, missing ones are NULL, types widen."""
    return widening.read_widened(spark, path)
