"""Named queries for the landing side: pages, bronze days, catalog, curate, audit, arrivals, streams.

Queries that write do so under a fresh folder of the session's shared
checkpoint directory and return the written data read back.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions.scalar import sanitize
from ..operators import curate, dedup, flatten, landing, profiles, quality
from ..session import work_path
from ..sources import arrivals, catalog, deltas, pages, raw, sinks
from ..streaming import jobs

# "Today" of the landing fixtures: the last landed day, whose folder may be partial.
LANDING_AS_OF = dt.date(2024, 2, 14)
SPLIT_DAY = dt.date(2024, 2, 1)
# "Today" of two landings in a row, both before the last day of the rows.
FIRST_AS_OF, SECOND_AS_OF = dt.date(2024, 2, 5), dt.date(2024, 2, 10)


def q_flatten_transactions(spark, sf_dir):
    edges, _ = pages.read_pages(fx.transaction_pages(spark, sf_dir), "transactions")
    return flatten.flatten_transactions(edges)


def q_flatten_events(spark, sf_dir):
    edges, _ = pages.read_pages(fx.event_pages(spark, sf_dir), "events")
    return flatten.flatten_events(edges)


def q_conform_transactions(spark, sf_dir):
    return sinks.conform(q_flatten_transactions(spark, sf_dir), "transactions")


def q_conform_events(spark, sf_dir):
    return sinks.conform(q_flatten_events(spark, sf_dir), "events")


def q_ingest_pages(spark, sf_dir):
    base = work_path(spark, "landed-transactions")
    name = f"landed_transactions_{uuid.uuid4().hex[:8]}"
    docs = fx.transaction_pages(spark, sf_dir)
    landing.ingest_pages(spark, docs, "transactions", base, LANDING_AS_OF)           # first run: all days
    landing.ingest_pages(spark, docs, "transactions", base, LANDING_AS_OF, table=name)  # re-fetch window only
    return spark.table(name).drop(sinks.SEQ)


def q_ingest_partial_day(spark, sf_dir):
    """Pages landed in two runs that both hold parts of the same days; late rows are held back."""
    base = work_path(spark, "landed-parts")
    docs = fx.transaction_pages(spark, sf_dir)
    for part in (0, 1):
        landing.ingest_pages(spark, docs.where(F.col("page_id") % 2 == part), "transactions", base, LANDING_AS_OF,
                             late="hold")
    return raw.read_raw(spark, base).drop(sinks.SEQ)


def q_ingest_late_rows(spark, sf_dir):
    """Two landings whose second holds late days, corrections and rows without a cursor: every row and where it is."""
    base, held = work_path(spark, "landed-late"), work_path(spark, "held-late")
    docs, keyless = fx.transaction_pages(spark, sf_dir), fx.keyless_pages(spark, sf_dir)
    first = docs.where(F.col("page_id") % 2 == 0).unionByName(keyless)
    later = (docs.where(F.col("page_id") % 2 == 1).unionByName(fx.transaction_pages(spark, sf_dir, corrected=True))
             .unionByName(keyless))
    for pages_, as_of in ((first, FIRST_AS_OF), (later, SECOND_AS_OF)):
        landing.ingest_pages(spark, pages_, "transactions", base, as_of, quarantine=held, order=F.col("page_id"))
    table = raw.read_raw(spark, base).select("id", "cursor", "grossAmount", "dt", F.lit(None).cast("string").alias("reason"))
    rest = spark.read.parquet(held).select(F.from_json("json", "id string, cursor string, grossAmount double").alias("r"), "reason")
    return table.unionByName(rest.select("r.*", F.lit(None).cast("date").alias("dt"), "reason"))


def q_ingest_rescued(spark, sf_dir):
    """Fields that the page schema lacks, from a landing that keeps them beside it."""
    base = work_path(spark, "landed-rescued")
    landing.ingest_pages(spark, fx.transaction_pages(spark, sf_dir, newer=True), "transactions", base, LANDING_AS_OF,
                         rescue=True)
    return pages.rescued_fields(raw.read_raw(spark, base))


def q_drop_seen_bounded(spark, sf_dir):
    """The anti join against a stored history of which only the batch's range of keys is read."""
    tx, base = fx.bronze_transactions(spark, sf_dir), work_path(spark, "history-cursors")
    seen = tx.where(F.col("createdAt") < F.date_add(F.lit(SPLIT_DAY), 2).cast("timestamp"))
    seen.repartitionByRange("cursor").write.parquet(base)
    new = tx.where(F.col("createdAt") >= F.lit(SPLIT_DAY).cast("timestamp"))
    return dedup.drop_seen(new, spark.read.parquet(base), "cursor", bounded=True)


def q_ingest_released(spark, sf_dir):
    """A landing as of an early day, whose held rows land when their day has come."""
    base, held = work_path(spark, "landed-early"), work_path(spark, "held-early")
    landing.ingest_pages(spark, fx.transaction_pages(spark, sf_dir), "transactions", base, FIRST_AS_OF, quarantine=held)
    for as_of in (SECOND_AS_OF, LANDING_AS_OF, LANDING_AS_OF):   # the last run finds nothing new
        landing.release_held(spark, held, "transactions", base, as_of)
    return raw.read_raw(spark, base).drop(sinks.SEQ)


def q_ingest_quarantine(spark, sf_dir):
    """What a landing with broken pages and rows without a time keeps, and where."""
    base, held = work_path(spark, "landed-some"), work_path(spark, "landed-held")
    docs = fx.transaction_pages(spark, sf_dir).select("json").unionByName(fx.broken_pages(spark, sf_dir))
    landing.ingest_pages(spark, docs, "transactions", base, LANDING_AS_OF, on_missing="quarantine", quarantine=held)
    good = raw.read_raw(spark, base).select(F.lit("landed").alias("reason"))
    return (good.unionByName(spark.read.parquet(held).select("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("rows")))


def q_sanitize_text(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    return docs.select("doc_id", sanitize("text").alias("text"))


def _landed_transactions(spark, sf_dir):
    base = work_path(spark, "bronze-transactions")
    sinks.write_daily(fx.bronze_transactions(spark, sf_dir), base, "createdAt")
    return base


def q_daily_overwrite(spark, sf_dir):
    base = _landed_transactions(spark, sf_dir)
    latest = raw.latest_partition(raw.read_raw(spark, base), LANDING_AS_OF).first()["latest_dt"]
    again = raw.incremental_window(fx.bronze_transactions(spark, sf_dir), "createdAt", latest, LANDING_AS_OF)
    sinks.write_daily(again, base, "createdAt")
    return raw.read_raw(spark, base)


def q_list_partitions(spark, sf_dir):
    return raw.list_partitions(raw.read_raw(spark, _landed_transactions(spark, sf_dir)))


def q_files_by_day(spark, sf_dir):
    # the file count depends on how the write split the days; compare the day and rows
    return raw.files_by_day(raw.read_raw(spark, _landed_transactions(spark, sf_dir))).select("dt", "rows")


def q_latest_partition(spark, sf_dir):
    return raw.latest_partition(raw.read_raw(spark, _landed_transactions(spark, sf_dir)), LANDING_AS_OF)


def q_read_latest(spark, sf_dir):
    return raw.read_latest(raw.read_raw(spark, _landed_transactions(spark, sf_dir)), LANDING_AS_OF)


def q_incremental_window(spark, sf_dir):
    loaded = raw.read_raw(spark, _landed_transactions(spark, sf_dir))
    return raw.incremental_window(fx.bronze_transactions(spark, sf_dir), "createdAt", loaded, LANDING_AS_OF)


def q_schema_merge(spark, sf_dir):
    base = work_path(spark, "bronze-evolving")
    tx = fx.bronze_transactions(spark, sf_dir)
    early = F.col("createdAt") < F.lit(SPLIT_DAY).cast("timestamp")
    sinks.write_daily(tx.where(early), base, "createdAt")
    sinks.write_daily(tx.where(~early).withColumn("note", F.concat(F.lit("late "), F.col("cursor"))),
                      base, "createdAt")
    return catalog.discover_schema(spark, base)


def q_schema_widened(spark, sf_dir):
    """Days whose files differ in type, read as one table of the wider types."""
    base = work_path(spark, "bronze-widened")
    for part in fx.growing_transactions(spark, sf_dir, SPLIT_DAY):
        sinks.write_daily(part, base, "createdAt")
    return catalog.discover_schema(spark, base)


def q_register_widened(spark, sf_dir):
    """A catalog table whose columns widen when later days bring wider types; each write registers its own days."""
    base, name = work_path(spark, "bronze-registered"), f"bronze_registered_{uuid.uuid4().hex[:8]}"
    for part in fx.growing_transactions(spark, sf_dir, SPLIT_DAY):
        sinks.write_daily(part, base, "createdAt")
        days = [r["dt"] for r in part.select(F.to_date("createdAt").alias("dt")).distinct().collect()]
        catalog.register_days(spark, name, base, part.schema, days)
    return spark.table(name)


def q_files_by_day_counted(spark, sf_dir):
    """Two files a day, as two appends of one task a day leave them."""
    base = work_path(spark, "bronze-files")
    tx = fx.bronze_transactions(spark, sf_dir).withColumn("dt", F.to_date("createdAt"))
    for _ in range(2):
        tx.repartition("dt").write.mode("append").partitionBy("dt").parquet(base)
    return raw.files_by_day(raw.read_raw(spark, base))


def q_curate_guard(spark, sf_dir):
    """The timestamp guard of the curated write: what it says, and what gets written, with text and with times."""
    out = []
    for kind, rows in (("text", fx.raw_events(spark, sf_dir)), ("timestamp", fx.bronze_events(spark, sf_dir))):
        path, error = work_path(spark, f"guarded-{kind}"), None
        rows = rows.withColumn("dt", F.to_date("occurredAt"))
        try:
            sinks.write_curated(rows, path)
        except ValueError as ex:
            error = str(ex)
        written = raw.read_raw(spark, path).agg(F.count(F.lit(1)).alias("rows")) if error is None \
            else rows.limit(0).agg(F.count(F.lit(1)).alias("rows"))
        out.append(written.select(F.lit(kind).alias("event_time"), F.lit(error).cast("string").alias("error"), "rows"))
    return out[0].unionByName(out[1])


def q_register_external(spark, sf_dir):
    base = _landed_transactions(spark, sf_dir)
    name = f"bronze_transactions_{uuid.uuid4().hex[:8]}"
    return catalog.register_external(spark, name, base)


def q_register_external_evolved(spark, sf_dir):
    """A table registered before a later day brings a new column."""
    base = work_path(spark, "bronze-grown")
    tx = fx.bronze_transactions(spark, sf_dir)
    early = F.col("createdAt") < F.lit(SPLIT_DAY).cast("timestamp")
    name = f"bronze_grown_{uuid.uuid4().hex[:8]}"
    sinks.write_daily(tx.where(early), base, "createdAt")
    catalog.register_external(spark, name, base)
    sinks.write_daily(tx.where(~early).withColumn("note", F.concat(F.lit("late "), F.col("cursor"))),
                      base, "createdAt")
    return catalog.register_external(spark, name, base)


def _landed_raw_events(spark, sf_dir):
    base = work_path(spark, "raw-events")
    sinks.write_daily(fx.raw_events(spark, sf_dir), base, "occurredAt")
    return base


def q_curate_report(spark, sf_dir):
    base = _landed_raw_events(spark, sf_dir)
    return curate.curate(spark, base, work_path(spark, "curated-events"))


def _landed_mixed_events(spark, sf_dir):
    """Raw events of which one day, and the rows without a day, hold unreadable times."""
    base = work_path(spark, "raw-mixed")
    fx.mixed_raw_events(spark, sf_dir).write.partitionBy("dt").parquet(base)
    return base


def q_curate_report_mixed(spark, sf_dir):
    base, out = _landed_mixed_events(spark, sf_dir), work_path(spark, "curated-mixed")
    report = curate.curate(spark, base, out)
    written = raw.read_raw(spark, out).groupBy("dt").agg(F.count(F.lit(1)).alias("written"))
    return (report.join(written.withColumnRenamed("dt", "_dt"), F.col("dt").eqNullSafe(F.col("_dt")), "left")
            .select("dt", "rows", "bad_rows", "ok", F.coalesce("written", F.lit(0)).cast("bigint").alias("written")))


def q_policy_audit_curated(spark, sf_dir):
    """The audit of a curated table whose shops repeat and are missing."""
    base, out = work_path(spark, "raw-audited"), work_path(spark, "curated-audited")
    shops = fx.raw_events(spark, sf_dir).withColumn("shopId", F.when(F.col("shopId") != "", F.col("shopId")))
    sinks.write_daily(shops, base, "occurredAt")
    curate.curate(spark, base, out)
    return quality.policy_audit(raw.read_raw(spark, out))


def q_policy_audit_daily(spark, sf_dir):
    """The audit of ``policy_audit_curated`` from stored day profiles; the days from ``SPLIT_DAY`` on are profiled later."""
    base, out, stored = (work_path(spark, n) for n in ("raw-profiled", "curated-profiled", "profiles"))
    shops = fx.raw_events(spark, sf_dir).withColumn("shopId", F.when(F.col("shopId") != "", F.col("shopId")))
    sinks.write_daily(shops, base, "occurredAt")
    curate.curate(spark, base, out)
    days = raw.landed_days(spark, out)
    # a day that lands again is profiled anew
    for some in ([d for d in days if d <= SPLIT_DAY], [d for d in days if d >= SPLIT_DAY]):
        profiles.refresh_profiles(spark, out, stored, some)
    return profiles.profile_audit(spark, stored, raw.read_raw(spark, out).schema)


def q_curate_datetimes(spark, sf_dir):
    base = _landed_raw_events(spark, sf_dir)
    out = work_path(spark, "curated-events")
    db = f"curated_{uuid.uuid4().hex[:8]}"
    curate.curate(spark, base, out, table="events_curated", database=db)
    return raw.curated(spark, f"{db}.events_curated")


def q_policy_audit(spark, sf_dir):
    return quality.policy_audit(fx.subscription_events(spark, sf_dir))


def q_policy_audit_exact(spark, sf_dir):
    return quality.policy_audit(fx.subscription_events(spark, sf_dir), distinct="exact")


def q_parse_arrivals(spark, sf_dir):
    return arrivals.parse_arrivals(arrivals.read_notifications(fx.notifications(spark, sf_dir)))


def q_arrivals_summary(spark, sf_dir):
    return arrivals.arrivals_summary(q_parse_arrivals(spark, sf_dir))


def q_drop_seen(spark, sf_dir):
    tx = fx.bronze_transactions(spark, sf_dir)
    new = tx.where(F.col("createdAt") >= F.lit(SPLIT_DAY).cast("timestamp"))
    seen = tx.where(F.col("createdAt") < F.date_add(F.lit(SPLIT_DAY), 2).cast("timestamp"))
    return dedup.drop_seen(new, seen, "cursor")


def q_stream_curate(spark, sf_dir):
    base = _landed_raw_events(spark, sf_dir)
    out, held, ck = work_path(spark, "stream-curated"), work_path(spark, "stream-held"), work_path(spark, "ck")
    jobs.stream_curate(spark, base, out, held, ck)
    return spark.read.parquet(out).drop(sinks.SEQ)


def q_stream_curate_relanded(spark, sf_dir):
    """Days that land twice, read file by file in several batches; both folders."""
    base = _landed_mixed_events(spark, sf_dir)
    out, held, ck = work_path(spark, "stream-curated"), work_path(spark, "stream-held"), work_path(spark, "ck")
    jobs.stream_curate(spark, base, out, held, ck, max_files=40)
    fx.mixed_raw_events(spark, sf_dir).write.mode("append").partitionBy("dt").parquet(base)
    jobs.stream_curate(spark, base, out, held, ck)
    columns = ["dt", "cursor", "occurredat", "shopid"]
    return (raw.read_raw(spark, out).select(*columns, F.lit(False).alias("held"))
            .unionByName(raw.read_raw(spark, held).select(*columns, F.lit(True).alias("held"))))


def q_stream_late_dedup(spark, sf_dir):
    base = work_path(spark, "bronze-relanded")
    tx = fx.bronze_transactions(spark, sf_dir).withColumn("dt", F.to_date("createdAt"))
    for _ in range(2):  # the same rows landed twice, as a re-fetch of overlapping days does
        tx.write.mode("append").partitionBy("dt").parquet(base)
    out, ck = work_path(spark, "stream-dedup"), work_path(spark, "ck")
    # one file a batch: days arrive in any order, and every day twice
    jobs.stream_dedup(spark, base, out, ck, ts_col="createdAt", key="cursor", max_files=30)
    return spark.read.parquet(out).drop(sinks.SEQ)


def q_stream_corrections(spark, sf_dir):
    """Rows that land again with a smaller amount, and rows without a cursor that land twice, in several batches."""
    base, out, ck = work_path(spark, "bronze-corrected"), work_path(spark, "stream-corrected"), work_path(spark, "ck")
    for part in fx.corrected_transactions(spark, sf_dir):
        part.withColumn("dt", F.to_date("createdAt")).write.mode("append").partitionBy("dt").parquet(base)
    jobs.stream_dedup(spark, base, out, ck, ts_col="createdAt", max_files=30)
    return spark.read.parquet(out).drop(sinks.SEQ)


def q_ingest_deltas(spark, sf_dir):
    """Corrections appended as deltas, of which some days are compacted in between: the merged read."""
    base = work_path(spark, "bronze-deltas")
    first, later = (part.withColumn("dt", F.to_date("createdAt")) for part in fx.corrected_transactions(spark, sf_dir))
    number = F.crc32(F.col("id"))
    batches = [first.where(number % 2 == 0), first.where(number % 2 == 1), later]
    for n, batch in enumerate(batches):
        deltas.append_deltas(batch, base, n, "createdAt")
        if n == 1:
            deltas.compact(spark, base, deltas.delta_days(spark, base)[::2], "createdAt")
    return deltas.read_merged(spark, base).drop(sinks.SEQ)


def q_stream_deltas(spark, sf_dir):
    """The corrections of ``stream_corrections`` by a stream that appends deltas; a second run brings the later part."""
    base, out, ck = work_path(spark, "bronze-late"), work_path(spark, "stream-deltas"), work_path(spark, "ck")
    for part in fx.corrected_transactions(spark, sf_dir):
        part.withColumn("dt", F.to_date("createdAt")).write.mode("append").partitionBy("dt").parquet(base)
        jobs.stream_deltas(spark, base, out, ck, ts_col="createdAt", max_files=60, share=0.6)
    return deltas.read_merged(spark, out).drop(sinks.SEQ)


QUERIES = {
    "flatten_transactions": q_flatten_transactions,
    "flatten_events": q_flatten_events,
    "conform_transactions": q_conform_transactions,
    "conform_events": q_conform_events,
    "ingest_pages": q_ingest_pages,
    "ingest_partial_day": q_ingest_partial_day,
    "ingest_quarantine": q_ingest_quarantine,
    "ingest_late_rows": q_ingest_late_rows,
    "ingest_released": q_ingest_released,
    "ingest_rescued": q_ingest_rescued,
    "drop_seen_bounded": q_drop_seen_bounded,
    "sanitize_text": q_sanitize_text,
    "daily_overwrite": q_daily_overwrite,
    "list_partitions": q_list_partitions,
    "files_by_day": q_files_by_day,
    "files_by_day_counted": q_files_by_day_counted,
    "latest_partition": q_latest_partition,
    "read_latest": q_read_latest,
    "incremental_window": q_incremental_window,
    "schema_merge": q_schema_merge,
    "schema_widened": q_schema_widened,
    "register_widened": q_register_widened,
    "register_external": q_register_external,
    "register_external_evolved": q_register_external_evolved,
    "curate_guard": q_curate_guard,
    "curate_report": q_curate_report,
    "curate_report_mixed": q_curate_report_mixed,
    "curate_datetimes": q_curate_datetimes,
    "policy_audit": q_policy_audit,
    "policy_audit_exact": q_policy_audit_exact,
    "policy_audit_curated": q_policy_audit_curated,
    "policy_audit_daily": q_policy_audit_daily,
    "parse_arrivals": q_parse_arrivals,
    "arrivals_summary": q_arrivals_summary,
    "drop_seen": q_drop_seen,
    "stream_curate": q_stream_curate,
    "stream_curate_relanded": q_stream_curate_relanded,
    "stream_late_dedup": q_stream_late_dedup,
    "stream_corrections": q_stream_corrections,
    "ingest_deltas": q_ingest_deltas,
    "stream_deltas": q_stream_deltas,
}
