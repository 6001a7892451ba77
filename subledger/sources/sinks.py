"""Writes: schema conform, day-replacing Parquet, curated output with a type guard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.lineage import remove_path, staged
from . import widening

#: stored column that says in which order rows landed (a struct; its fields depend on the source)
SEQ = "_seq"
#: rows as JSON keep their times to the microsecond
JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
#: copies of a keyless row that are written from one array
COPIES = 10_000


def conform(df: DataFrame, api_type: str, keep=()) -> DataFrame:
    """Select the bronze columns in order, cast to their types (unknown type -> ValueError)."""
    schema = S.bronze_schema(api_type)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *keep)


def write_daily(df: DataFrame, base: str, ts_col: str) -> None:
    """Write one folder per day of ``ts_col``, replacing only the days present in ``df``.

    Dynamic partition overwrite leaves untouched days in place. Rows are range
    partitioned on (dt, time): small days share a task and a heavy day is cut
    into several tasks by the sampled bounds, so no single task holds a hot day.
    """
    out = df.withColumn("dt", F.to_date(F.col(ts_col))).repartitionByRange("dt", ts_col)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dt").parquet(base))


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def day_folder(day) -> str:
    return f"dt={day.isoformat() if day else '__HIVE_DEFAULT_PARTITION__'}"


def move_folder(spark: SparkSession, src: str, dst: str) -> None:
    """Put a folder in the place of another one (a rename, of the same file system)."""
    jvm = spark.sparkContext._jvm
    a, b = jvm.org.apache.hadoop.fs.Path(src), jvm.org.apache.hadoop.fs.Path(dst)
    fs = a.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(b.getParent())
    fs.delete(b, True)
    if not fs.rename(a, b):
        raise OSError(f"could not move {src} to {dst}")


def stored_days(spark: SparkSession, base: str, days, schema: T.StructType | None = None) -> DataFrame | None:
    """Stored rows of the given days (partition pruning), or ``None`` when nothing is stored.

    Without a ``schema`` the footers of these days' files are merged, no others.
    """
    if not path_exists(spark, base):
        return None
    folders = [f for f in (f"{base}/{day_folder(d)}" for d in days) if path_exists(spark, f)]
    if not folders:
        return None
    rows = (spark.read.option("basePath", base).schema(schema).parquet(*folders) if schema
            else widening.read_widened(spark, base, folders))
    return rows.withColumn("dt", F.col("dt").cast("date"))


def newest_by_key(new: DataFrame, stored: DataFrame | None, key: str = "cursor") -> DataFrame:
    """New and stored rows, one per key: the one that landed last.

    ``_seq`` (a struct, see ``SEQ``) orders the rows; rows without one are older than all that have
    one, of those a new row replaces a stored one, and of new ones the largest in column order stays.
    Rows without a key are told apart by all their named values; of equal ones as many stay as one
    landing (a file, a fetch; without ``_seq`` one of the two sides) held at most, so what lands twice
    adds nothing, whatever came together in a batch.
    """
    def sided(df: DataFrame, fresh: bool) -> DataFrame:
        return df.withColumn("_new", F.lit(fresh))

    rows = sided(new, True)
    if stored is not None:
        schema = widening.wider_schema(new.schema, stored.schema)
        rows = sided(widening.conformed(new, schema), True).unionByName(sided(widening.conformed(stored, schema), False))
    columns = [c for c in rows.columns if c != "_new"]
    known = key in columns
    # named values only: two rows that hold the same text in different columns differ, and a column
    # that later batches add doesn't change what earlier rows are
    whole = F.sha2(F.to_json(F.struct(*sorted(c for c in columns if c not in ("dt", SEQ, "_bad"))), JSON_TIMES), 256)
    name = F.col(key).cast("string") if known else F.lit(None).cast("string")
    order = [F.col(SEQ).isNotNull(), F.col(SEQ)] if SEQ in columns else []
    last = F.max(F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], "_new", *columns)).alias("r")
    keyed = rows.where(name.isNotNull()).groupBy(name.alias("_key")).agg(last).select("r.*").select(*columns)
    # keyless rows: copies are counted within what landed together, a file or a fetch
    landed = F.col("_new").cast("string")
    if SEQ in columns:
        fields = [f.name for f in rows.schema[SEQ].dataType.fields]
        landed = F.coalesce(F.col(SEQ)["file" if "file" in fields else fields[0]].cast("string"), landed)
    picked = (rows.where(name.isNull()).groupBy(whole.alias("_row"), landed.alias("_landed"))
              .agg(last, F.count(F.lit(1)).alias("_n"))
              .groupBy("_row").agg(F.max("r").alias("r"), F.max("_n").alias("_n")))
    # a row that repeats very often is written out in slots, so no array grows with its number
    slots = picked.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / COPIES))))
    many = F.least(F.lit(COPIES), F.col("_n") - F.col("_slot") * COPIES)
    loose = slots.withColumn("_one", F.explode(F.sequence(F.lit(1), many))).select("r.*").select(*columns)
    return keyed.unionByName(loose)


def replace_days(df: DataFrame, base: str, days, ts_col: str | None = None) -> None:
    """Make the given days of ``base`` hold exactly the rows of ``df`` (which has ``dt``)."""
    spark = df.sparkSession
    present = {r["dt"] for r in df.select("dt").distinct().collect()}
    if present:
        order = ["dt"] + [c for c in [ts_col] if c in df.columns]
        (df.repartitionByRange(*order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("dt").parquet(base))
    for day in set(days) - present:
        remove_path(spark, f"{base}/{day_folder(day)}")


def merge_days(new: DataFrame, base: str, ts_col: str | None = None, key: str = "cursor",
               schema: T.StructType | None = None) -> list:
    """Merge rows (with ``dt``) into the stored rows of their days and replace those days; returns the days.

    ``new`` should be a materialised frame: it is read for its days and for the merge.
    """
    spark = new.sparkSession
    days = [r["dt"] for r in new.select("dt").distinct().collect()]
    if days:
        with staged(newest_by_key(new, stored_days(spark, base, days, schema), key)) as rows:
            replace_days(rows, base, days, ts_col)
    return days


def require_timestamp(df: DataFrame, names=("occurredat", "occurredAt")) -> str | None:
    """Raise if the event-time column exists but is not an instant timestamp."""
    for name in names:
        if name in df.columns:
            dtype = df.schema[name].dataType
            if not isinstance(dtype, T.TimestampType):
                raise ValueError(f"event time {name!r} must be a timestamp before the write, it is {dtype.typeName()}")
            return name
    return None


def write_curated(df: DataFrame, path: str, partition_col: str | None = "dt") -> None:
    """Guarded overwrite of curated rows (days present are replaced, others kept)."""
    require_timestamp(df)
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if partition_col and partition_col in df.columns:
        w = w.partitionBy(partition_col)
    w.parquet(path)
