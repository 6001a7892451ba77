"""Small pieces that several operators share."""

from __future__ import annotations

import json
import os
import re
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: a word: a run without space, tab, newline, vertical tab, form feed, carriage return
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (clusters may ship it with --py-files)."""
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if home not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the session's shared folder (survives lost executors, cuts lineage)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def word_count(text: Column) -> Column:
    """Words of the text; NULL counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def small_frame(spark: SparkSession, rows: list[tuple], names: list[str], schema: str) -> DataFrame:
    """A DataFrame of driver-side plan rows; ``schema`` gives their types, in the order of ``names``."""
    text = json.dumps([dict(zip(names, r)) for r in rows])
    return (spark.range(1)
            .select(F.explode(F.from_json(F.lit(text), f"array<struct<{schema}>>")).alias("r"))
            .select("r.*"))


def sort_key(url: str | None) -> str:
    """Reversed host, then path and query: com,example,www)/a?b (no spaces or control characters)."""
    url = (url or "").strip()
    try:
        parts = urlsplit(url if "://" in url else "//" + url)
        host, port = (parts.hostname or "").lower(), parts.port
        rest = (parts.path or "/") + ("?" + parts.query if parts.query else "")
    except ValueError:  # not a URL: sorted by its text
        host, port, rest = "", None, "/" + url
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + rest
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", key)
