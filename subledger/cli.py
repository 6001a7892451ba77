"""Command line for scheduled runs: ``spark-submit -m subledger.cli <job> [options]``.

Inputs are catalog tables or Parquet paths (a value containing ``/`` or ``:``
is read as a path); outputs are Parquet paths written with overwrite. Every
job takes ``--as-of`` (default: today) so reruns are repeatable.

  land        --pages P --api-type T --base B [--table N --quarantine Q]
  curate      --raw B --curated C [--table N --database D --dt YYYY-MM-DD --datetime-columns a,b]
  stream-curate --raw B --curated C --quarantine Q --checkpoint K
  stream-dedup  --base B --out O --checkpoint K --time-column T
  drop-seen   --new N --seen S --out O [--key cursor]
  timeline    --events E --out O
  attribute   --transactions X --events E --out O
  mrr         --transactions X --out O [--per-shop]
  daily       --events E --out O [--store] [--method sweep|explode]
  audit       --table T --out O
  arrivals    --notifications N --out O [--summary]
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from .operators import active, attribution, dedup, mrr, quality, timeline
from .operators.curate import DATETIME_PAIRS, curate
from .operators.landing import ingest_pages
from .session import build_session
from .sources import arrivals
from .streaming import jobs


def _read(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.parquet(name) if ("/" in name or ":" in name) else spark.table(name)


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="subledger")
    p.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    sub = p.add_subparsers(dest="job", required=True)
    s = sub.add_parser("land")
    s.add_argument("--pages", required=True)
    s.add_argument("--api-type", required=True, choices=("transactions", "events"))
    s.add_argument("--base", required=True)
    s.add_argument("--table")
    s.add_argument("--quarantine", help="folder of bad pages and rows; without it a bad page ends the job")
    s = sub.add_parser("curate")
    s.add_argument("--raw", required=True)
    s.add_argument("--curated", required=True)
    s.add_argument("--table")
    s.add_argument("--database")
    s.add_argument("--dt", type=dt.date.fromisoformat, default=None, help="curate one day folder only")
    s.add_argument("--datetime-columns", help="event-time columns, comma-separated")
    s = sub.add_parser("stream-curate")
    for name in ("--raw", "--curated", "--quarantine", "--checkpoint"):
        s.add_argument(name, required=True)
    s = sub.add_parser("stream-dedup")
    for name in ("--base", "--out", "--checkpoint", "--time-column"):
        s.add_argument(name, required=True)
    s = sub.add_parser("drop-seen")
    for name in ("--new", "--seen", "--out"):
        s.add_argument(name, required=True)
    s.add_argument("--key", default="cursor")
    for job in ("timeline", "daily"):
        s = sub.add_parser(job)
        s.add_argument("--events", required=True)
        s.add_argument("--out", required=True)
        if job == "daily":
            s.add_argument("--store", action="store_true")
            s.add_argument("--method", default="sweep", choices=("sweep", "explode"))
    s = sub.add_parser("attribute")
    s.add_argument("--transactions", required=True)
    s.add_argument("--events", required=True)
    s.add_argument("--out", required=True)
    s = sub.add_parser("mrr")
    s.add_argument("--transactions", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--per-shop", action="store_true")
    s = sub.add_parser("audit")
    s.add_argument("--table", required=True)
    s.add_argument("--out", required=True)
    s = sub.add_parser("arrivals")
    s.add_argument("--notifications", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--summary", action="store_true")
    return p


def main(argv=None, spark: SparkSession | None = None) -> None:
    a = _parser().parse_args(argv)
    spark = spark or build_session()
    as_of = a.as_of or dt.date.today()
    if a.job == "land":
        docs = spark.read.text(a.pages).withColumnRenamed("value", "json")
        ingest_pages(spark, docs, a.api_type, a.base, as_of, table=a.table, quarantine=a.quarantine,
                     on_missing="quarantine" if a.quarantine else "raise")
    elif a.job == "curate":
        pairs = [(n, n.lower()) for n in a.datetime_columns.split(",")] if a.datetime_columns else DATETIME_PAIRS
        curate(spark, a.raw, a.curated, table=a.table, database=a.database, dt=a.dt, pairs=pairs)
    elif a.job == "stream-curate":
        jobs.stream_curate(spark, a.raw, a.curated, a.quarantine, a.checkpoint)
    elif a.job == "stream-dedup":
        jobs.stream_dedup(spark, a.base, a.out, a.checkpoint, a.time_column)
    elif a.job == "drop-seen":
        _write(dedup.drop_seen(_read(spark, a.new), _read(spark, a.seen), a.key), a.out)
    elif a.job == "timeline":
        _write(timeline.timeline_intervals(_read(spark, a.events), as_of), a.out)
    elif a.job == "attribute":
        _write(attribution.attribute_from_events(_read(spark, a.transactions), _read(spark, a.events), as_of), a.out)
    elif a.job == "mrr":
        tx = _read(spark, a.transactions)
        _write(mrr.mrr_shop_month(tx, as_of) if a.per_shop else mrr.mrr_monthly(tx, as_of), a.out)
    elif a.job == "daily":
        ev = _read(spark, a.events)
        spans = active.store_intervals(ev, as_of) if a.store else timeline.timeline_intervals(ev, as_of)
        _write(active.daily_active(spans, as_of, method=a.method, checks=(ev,)), a.out)
    elif a.job == "audit":
        _write(quality.policy_audit(_read(spark, a.table)), a.out)
    elif a.job == "arrivals":
        docs = spark.read.text(a.notifications).withColumnRenamed("value", "json")
        parsed = arrivals.parse_arrivals(arrivals.read_notifications(docs))
        _write(arrivals.arrivals_summary(parsed) if a.summary else parsed, a.out)


if __name__ == "__main__":
    main()
