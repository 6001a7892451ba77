"""Incremental jobs on Structured Streaming (file source -> day-replacing Parquet folders).

* ``stream_curate``   new landed files are curated as they arrive (the arrival
  trigger of the batch design). Rows whose event time does not parse go to a
  quarantine folder instead of the curated one.
* ``stream_dedup``    re-landed rows (the fetcher re-reads the day before the
  latest one) are kept once per cursor.
* ``stream_deltas``   the same by appended deltas: a late row doesn't rewrite its day.

All run with ``trigger(availableNow=True)``: they process what is there and
stop, so they can be scheduled like batch jobs. Each micro-batch of the first two is merged with
the stored rows of the days it touches and those days are replaced. Of the rows of a
cursor the one that landed last stays: ``_seq`` (modification time and path of the
row's file, and its place there) is stored with the row, so the result doesn't
depend on how files fall into batches. A day that lands again, whole or in part, is therefore replayed,
not appended; a row that lands late, however late, joins its day; and a batch
that runs again after a failure gives the same result. One source feeds both
folders of ``stream_curate``. No state is kept beside the source's checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lineage import staged
from ..operators.curate import DATETIME_PAIRS, convert_datetimes, datetime_columns, lower_names
from ..sources import deltas, sinks


def _run(spark: SparkSession, path: str, checkpoint: str, each, max_files: int | None,
         schema: T.StructType | None) -> None:
    if schema is None:
        schema = spark.read.option("mergeSchema", "true").parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    # rows of a later file landed later; in a file, later rows did
    landed = F.struct(F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("file"),
                      F.col("_metadata.row_index").alias("row"))
    rows = reader.parquet(path).select("*", landed.alias(sinks.SEQ))
    (rows.writeStream.foreachBatch(each)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())


def stream_curate(spark: SparkSession, raw_path: str, curated_path: str, quarantine_path: str,
                  checkpoint: str, max_files: int | None = None, key: str = "cursor", pairs=DATETIME_PAIRS,
                  schema: T.StructType | None = None) -> None:
    """Curate every landed file: parsed rows to ``curated_path``, the rest (with their text) to quarantine.

    ``schema`` declares the landed columns (with ``dt``); without it the footers of all files are merged.
    """
    def each(batch: DataFrame, _: int) -> None:
        names = datetime_columns(batch, pairs)
        flagged = batch
        for n in names:
            flagged = flagged.withColumn(f"_raw_{n}", F.col(n).cast("string"))
        flagged, bad = convert_datetimes(flagged, pairs), F.lit(False)
        for n in names:
            bad = bad | (F.col(f"_raw_{n}").isNotNull() & F.col(n).isNull())
        flagged = lower_names(flagged.withColumn("_bad", bad))
        texts = [f"_raw_{n.lower()}" for n in names]
        for text in texts:   # of good rows the text says nothing new
            flagged = flagged.withColumn(text, F.when(F.col("_bad"), F.col(text)))
        with staged(flagged) as new:
            days = [r["dt"] for r in new.select("dt").distinct().collect()]
            stored = None
            for path, held in ((curated_path, False), (quarantine_path, True)):
                old = sinks.stored_days(new.sparkSession, path, days)
                if old is not None:
                    old = old.withColumn("_bad", F.lit(held))
                    stored = old if stored is None else stored.unionByName(old, allowMissingColumns=True)
            with staged(sinks.newest_by_key(new, stored, key)) as rows:
                sinks.replace_days(rows.where(~F.col("_bad")).drop("_bad", *texts), curated_path, days)
                sinks.replace_days(rows.where("_bad").drop("_bad"), quarantine_path, days)

    _run(spark, raw_path, checkpoint, each, max_files, schema)


def stream_dedup(spark: SparkSession, bronze_path: str, out_path: str, checkpoint: str,
                 ts_col: str, key: str = "cursor", max_files: int | None = None,
                 schema: T.StructType | None = None) -> None:
    """Keep each cursor once per day, the row that landed last (in the latest file, and furthest down in it)."""
    def each(batch: DataFrame, _: int) -> None:
        with staged(batch if "dt" in batch.columns else batch.withColumn("dt", F.to_date(ts_col))) as new:
            sinks.merge_days(new, out_path, ts_col, key)

    _run(spark, bronze_path, checkpoint, each, max_files, schema)


def stream_deltas(spark: SparkSession, bronze_path: str, base: str, checkpoint: str, ts_col: str, key: str = "cursor",
                  max_files: int | None = None, schema: T.StructType | None = None, share: float = 0.1) -> None:
    """As ``stream_dedup``, but a batch is appended as deltas and rewrites no day (read by ``deltas.read_merged``).

    Days whose deltas outgrow ``share`` of their stored bytes are compacted at the end of the run.
    """
    def each(batch: DataFrame, number: int) -> None:
        with staged(batch if "dt" in batch.columns else batch.withColumn("dt", F.to_date(ts_col))) as new:
            deltas.append_deltas(new, base, number, ts_col, compacted="skip")

    _run(spark, bronze_path, checkpoint, each, max_files, schema)
    deltas.compact(spark, base, deltas.compaction_due(spark, base, share), ts_col, key)
