"""The command line runs jobs over paths and writes Parquet."""

from pyspark.sql import functions as F

from conftest import SMALL
from subledger import cli
from subledger import fixtures as fx


def test_cli_jobs_over_paths(spark, tmp_path):
    ev, tx = str(tmp_path / "events"), str(tmp_path / "tx")
    fx.subscription_events(spark, SMALL).write.parquet(ev)
    fx.payments(spark, SMALL).write.parquet(tx)
    as_of = ["--as-of", fx.EVENTS_AS_OF.isoformat()]
    cli.main(as_of + ["timeline", "--events", ev, "--out", str(tmp_path / "subs")], spark)
    cli.main(as_of + ["attribute", "--transactions", tx, "--events", ev, "--out", str(tmp_path / "attr")], spark)
    cli.main(as_of + ["mrr", "--transactions", tx, "--out", str(tmp_path / "mrr")], spark)
    cli.main(as_of + ["daily", "--events", ev, "--out", str(tmp_path / "daily")], spark)
    cli.main(as_of + ["audit", "--table", ev, "--out", str(tmp_path / "audit")], spark)
    read = spark.read.parquet
    assert read(str(tmp_path / "attr")).count() == fx.payments(spark, SMALL).count()
    assert read(str(tmp_path / "subs")).count() > 0
    assert read(str(tmp_path / "mrr")).count() > 0
    assert read(str(tmp_path / "daily")).count() > 0
    assert read(str(tmp_path / "audit")).count() == 8


def test_cli_land_pages_from_text(spark, tmp_path):
    pages = str(tmp_path / "pages")
    fx.transaction_pages(spark, SMALL).select("json").write.text(pages)
    base = str(tmp_path / "bronze")
    cli.main(["--as-of", "2024-02-14", "land", "--pages", pages, "--api-type", "transactions", "--base", base],
             spark)
    assert spark.read.parquet(base).count() == fx.payments(spark, SMALL).count()


def test_cli_remaining_jobs(spark, tmp_path):
    ev, tx = str(tmp_path / "events"), str(tmp_path / "tx")
    fx.relationship_events(spark, SMALL).write.parquet(ev)
    fx.payments(spark, SMALL).write.parquet(tx)
    notes = str(tmp_path / "notes")
    fx.notifications(spark, SMALL).select("json").write.text(notes)
    raw = str(tmp_path / "raw")
    fx.raw_events(spark, SMALL).withColumn("dt", F.to_date(F.substring("occurredAt", 1, 10))) \
        .write.partitionBy("dt").parquet(raw)
    as_of = ["--as-of", fx.EVENTS_AS_OF.isoformat()]
    cli.main(as_of + ["daily", "--events", ev, "--out", str(tmp_path / "stores"), "--store"], spark)
    cli.main(as_of + ["mrr", "--transactions", tx, "--out", str(tmp_path / "mrr_shop"), "--per-shop"], spark)
    cli.main(["arrivals", "--notifications", notes, "--out", str(tmp_path / "arr"), "--summary"], spark)
    cli.main(["curate", "--raw", raw, "--curated", str(tmp_path / "curated")], spark)
    read = spark.read.parquet
    assert read(str(tmp_path / "stores")).count() > 0
    assert "churn_mrr" in read(str(tmp_path / "mrr_shop")).columns
    assert read(str(tmp_path / "arr")).count() > 0
    assert read(str(tmp_path / "curated")).count() == fx.raw_events(spark, SMALL).count()
