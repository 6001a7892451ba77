"""Object-arrival notifications -> (database, collection, day) rows.

Notifications are JSON documents with ``Records[]``; every record is kept
(not just the first). A key is percent-decoded (a literal ``+`` stays ``+``),
its prefix before ``dt=`` names the feed, and ``source/database-collection/``
names the table. Keys that do not fit give an ``Error`` row, not a failure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.scalar import decode_key

NOTIFICATION_SCHEMA = T.StructType([T.StructField("Records", T.ArrayType(T.StructType([
    T.StructField("eventSource", T.StringType()),
    T.StructField("awsRegion", T.StringType()),
    T.StructField("eventName", T.StringType()),
    T.StructField("s3", T.StructType([
        T.StructField("bucket", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("object", T.StructType([
            T.StructField("key", T.StringType()),
            T.StructField("size", T.LongType()),
        ])),
    ])),
])))])


def read_notifications(docs: DataFrame, json_col: str = "json") -> DataFrame:
    """One row per record: event source, region, event name, bucket, key, size.

    A document that can't be read, or holds no records, gives one row with an
    empty key, which ``parse_arrivals`` reports as an ``Error``.
    """
    recs = docs.select(F.explode_outer(F.from_json(F.col(json_col), NOTIFICATION_SCHEMA)["Records"]).alias("r"))
    unknown = F.lit("Unknown")
    return recs.select(
        F.coalesce("r.eventSource", unknown).alias("event_source"),
        F.coalesce("r.awsRegion", unknown).alias("region"),
        F.coalesce("r.eventName", unknown).alias("event_name"),
        F.coalesce("r.s3.bucket.name", unknown).alias("bucket"),
        F.when(F.col("r").isNull(), F.lit("")).otherwise(F.coalesce("r.s3.object.key", unknown)).alias("key"),
        F.col("r.s3.object.size").alias("size"),
    )


def parse_arrivals(records: DataFrame, source: str = "mongodb", key_col: str = "key") -> DataFrame:
    """Decode each key and split it into prefix, day, database and collection, with a status."""
    k = decode_key(key_col)
    has_dt = k.contains("dt=")
    before_dt = F.get(F.split(k, "dt="), 0)
    prefix = F.when(has_dt, F.replace(F.regexp_replace(before_dt, "/+$", ""), F.lit("/"), F.lit("-"))) \
              .otherwise(F.replace(k, F.lit("/"), F.lit("-")))
    day = F.when(has_dt, F.get(F.split(F.get(F.split(k, "dt="), 1), "/"), 0))
    parts = F.split(k, "/")
    fits = (F.size(parts) >= 2) & (F.get(parts, 0) == F.lit(source))
    db_coll = F.split(F.get(parts, 1), "-", 2)
    splits = F.size(db_coll) == 2
    status = (F.when((prefix == "") | (k == ""), F.lit("Error"))
              .when(~fits, F.lit("Error"))
              .when(~splits, F.lit("Error"))
              .otherwise(F.lit("Success")))
    message = (F.when((prefix == "") | (k == ""), F.lit(S.MSG_NO_KEY))
               .when(~fits, F.concat(F.lit(S.MSG_OTHER_KEY), k))
               .when(~splits, F.lit(S.MSG_NO_COLLECTION)))
    return records.select(
        "*",
        k.alias("decoded_key"),
        prefix.alias("object_prefix"),
        day.alias("partition_value"),
        F.when(fits & splits, F.get(db_coll, 0)).alias("database"),
        F.when(fits & splits, F.get(db_coll, 1)).alias("collection"),
        status.alias("status"),
        message.alias("message"),
    )


def arrivals_summary(parsed: DataFrame) -> DataFrame:
    """Arrivals per (database, collection, day) for the keys that parsed."""
    return (parsed.where(F.col("status") == "Success")
            .groupBy("database", "collection", "partition_value")
            .agg(F.count(F.lit(1)).alias("objects"),
                 F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("bytes")))
