"""Late rows without rewriting their day: delta folders, merge on read, compaction.

``merge_days`` rewrites every day that a batch touches, also for a single late row. Here a batch is
only appended, to ``<base>-deltas/dt=<day>/landed_batch=<number>``, so the bytes written follow the
batch. ``read_merged`` gives what a merge would have given: days without deltas are read as they
are, the others are merged by key (``newest_by_key``, within each day). ``compact`` writes the merged
days into the table and removes their deltas; a read gives the same rows before, after and between.

Batches are numbered by the writer, growing (a stream's batch id, a run's number); a batch appended
again replaces its earlier rows. A compacted day's rows carry the largest number merged into them,
so deltas left by a compaction that died before it removed them are not merged twice.

Rows without ``_seq`` landed in the order of their batches. Rows with one are ordered by it, whatever
their batch; rows without a key are counted within what landed together (see ``newest_by_key``), and one
such landing goes in one batch. ``dt`` is derived from a column of the rows.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lineage import remove_path, staged
from . import sinks, widening

#: number of the batch: folder level of the deltas, column of a compacted day
MARK = "landed_batch"

Day = dt.date | None


def delta_path(base: str) -> str:
    return f"{base.rstrip('/')}-deltas"


def _files(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str, pattern: str) -> list[str]:
    p, fs = _files(spark, path)
    if not fs.exists(p):
        return []
    found = [re.fullmatch(pattern, f.getPath().getName()) for f in fs.listStatus(p)]
    return [m[1] for m in found if m]


def _bytes(spark: SparkSession, path: str) -> int:
    p, fs = _files(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def delta_days(spark: SparkSession, base: str) -> list[Day]:
    """Days that have delta folders, from a listing of one name a day; ``None`` is the day of rows without one."""
    names = _names(spark, delta_path(base), r"dt=(.+)")
    return [dt.date.fromisoformat(n) if re.fullmatch(r"\d{4}-\d{2}-\d{2}", n) else None for n in sorted(names)]


def _day_path(base: str, day: Day, batch: int | None = None) -> str:
    folder = f"{delta_path(base)}/{sinks.day_folder(day)}"
    return folder if batch is None else f"{folder}/{MARK}={batch}"


def _marks(spark: SparkSession, base: str, days: list[Day]) -> dict[Day, int]:
    """Largest batch merged into each of the days: one column of theirs, a row a day."""
    stored = sinks.stored_days(spark, base, days)
    if stored is None or MARK not in stored.columns:
        return {}
    return {r["dt"]: r["n"] for r in stored.groupBy("dt").agg(F.max(MARK).alias("n")).collect() if r["n"] is not None}


def _open_batches(spark: SparkSession, base: str, days: list[Day]) -> dict[Day, list[int]]:
    """Batches of each day that are not part of its stored rows yet; days without one are left out."""
    marks = _marks(spark, base, days)
    listed = {d: sorted(map(int, _names(spark, _day_path(base, d), rf"{MARK}=(\d+)"))) for d in days}
    fresh = {d: [n for n in numbers if n > marks.get(d, -1)] for d, numbers in listed.items()}
    return {d: numbers for d, numbers in fresh.items() if numbers}


def append_deltas(new: DataFrame, base: str, batch: int, ts_col: str | None = None, compacted: str = "raise") -> list[Day]:
    """Append rows (with ``dt``) as a batch; returns its days. Nothing stored is read but the days' batch numbers.

    ``new`` should be a materialised frame. A day into which this number or a larger one has been
    compacted takes no rows: an error, or with ``compacted="skip"`` (a stream's batch that is run
    again after its compaction) they are left out as already merged.
    """
    if batch < 0:
        raise ValueError("batch numbers start at 0")
    if compacted not in ("raise", "skip"):
        raise ValueError(f"batches that have been compacted raise or are skipped, not {compacted!r}")
    spark = new.sparkSession
    days = [r["dt"] for r in new.select("dt").distinct().collect()]
    closed = {d for d, n in _marks(spark, base, days).items() if n >= batch}
    if closed and compacted == "raise":
        raise ValueError(f"batch {batch} or a later one has been compacted into {len(closed)} of its days")
    if closed:
        dated = [d for d in closed if d is not None]
        keep = F.col("dt").isNull() if None not in closed else F.lit(False)
        new = new.where(keep | F.coalesce(~F.col("dt").isin(dated) if dated else F.col("dt").isNotNull(), F.lit(False)))
        days = [d for d in days if d not in closed]
    rows = new if sinks.SEQ in new.columns else new.withColumn(sinks.SEQ, F.struct(F.lit(batch).cast("long").alias("batch")))
    order = ["dt"] + [c for c in [ts_col] if c in rows.columns]
    if days:
        (rows.withColumn(MARK, F.lit(batch).cast("long")).repartitionByRange(*order)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt", MARK)
         .parquet(delta_path(base)))
    return days


def _merged(spark: SparkSession, base: str, batches: dict[Day, list[int]], key: str) -> DataFrame:
    """Stored rows and the given batches of their days, one row per day and key."""
    folders = [_day_path(base, d, n) for d, numbers in batches.items() for n in numbers]
    rows = widening.read_widened(spark, delta_path(base), folders).drop(MARK).withColumn("dt", F.col("dt").cast("date"))
    stored = sinks.stored_days(spark, base, list(batches))

    def named(df: DataFrame) -> DataFrame:
        # a key counts within its day, so the result doesn't depend on which days are merged together
        known = F.col(key).cast("string") if key in df.columns else F.lit(None).cast("string")
        return df.drop(MARK).withColumn("_in_day", F.concat(F.coalesce(F.col("dt").cast("string"), F.lit("")), F.lit("|"), known))

    return sinks.newest_by_key(named(rows), None if stored is None else named(stored), "_in_day").drop("_in_day")


def read_merged(spark: SparkSession, base: str, days=None, key: str = "cursor") -> DataFrame | None:
    """The table's rows with its deltas merged in (all days, or the given ones); ``None`` if there are none.

    Only days with deltas are shuffled; the others are a plain scan.
    """
    stored = _names(spark, base, r"dt=(.+)")
    all_days = {dt.date.fromisoformat(n) if re.fullmatch(r"\d{4}-\d{2}-\d{2}", n) else None for n in stored}
    waiting = delta_days(spark, base)
    if days is not None:
        all_days, waiting = all_days & set(days), [d for d in waiting if d in set(days)]
    batches = _open_batches(spark, base, waiting)
    still = sinks.stored_days(spark, base, sorted(all_days - set(batches), key=str))
    parts = [p for p in (None if still is None else still.drop(MARK),
                         _merged(spark, base, batches, key) if batches else None) if p is not None]
    if len(parts) < 2:
        return parts[0] if parts else None
    schema = widening.wider_schema(parts[0].schema, parts[1].schema)
    return widening.conformed(parts[0], schema).unionByName(widening.conformed(parts[1], schema))


def compaction_due(spark: SparkSession, base: str, share: float = 0.1) -> list[Day]:
    """Days whose deltas hold more than ``share`` of the bytes of their stored rows (all that have none stored)."""
    return [d for d in delta_days(spark, base)
            if _bytes(spark, _day_path(base, d)) > share * _bytes(spark, f"{base.rstrip('/')}/{sinks.day_folder(d)}")]


def compact(spark: SparkSession, base: str, days=None, ts_col: str | None = None, key: str = "cursor") -> list[Day]:
    """Merge the deltas of all days, or the given ones, into the table and remove them; returns the days rewritten.

    Batches appended meanwhile stay deltas. Run again after a failure it ends what was begun: days are
    replaced before their deltas go, and their rows say which batches they hold.
    """
    waiting = [d for d in delta_days(spark, base) if days is None or d in set(days)]
    listed = {d: sorted(map(int, _names(spark, _day_path(base, d), rf"{MARK}=(\d+)"))) for d in waiting}
    batches = _open_batches(spark, base, waiting)
    batches = {d: [n for n in numbers if n in listed[d]] for d, numbers in batches.items()}
    batches = {d: numbers for d, numbers in batches.items() if numbers}
    if batches:
        tops = [(None if d is None else d.isoformat(), numbers[-1]) for d, numbers in batches.items()]
        marks = spark.createDataFrame(tops, f"_day string, {MARK} long")
        # one row a day: a calendar's size
        rows = (_merged(spark, base, batches, key).join(marks, F.col("dt").cast("string").eqNullSafe(F.col("_day")), "left")
                .drop("_day"))
        with staged(rows) as done:
            sinks.replace_days(done, base, list(batches), ts_col)
    for d, numbers in listed.items():
        for n in numbers:
            remove_path(spark, _day_path(base, d, n))
        if not _names(spark, _day_path(base, d), rf"{MARK}=(\d+)"):
            remove_path(spark, _day_path(base, d))
    return list(batches)
