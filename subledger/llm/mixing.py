"""Operator 1: mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words; each of its documents is to be copied
``target / source words`` times. The whole part is taken as it is. The fractional
parts are rounded by the pivotal method: two documents with fractions p, q and a, b
words exchange d words of probability mass (p + d/a, q - d/b, or the other way), the
direction drawn so that both expectations stay, until one of them is 0 or 1. The
other one goes on to meet the next. The exchange keeps a*p + b*q, so a source misses
its target by less than one document.

The pairing is a reduction tree: documents are hashed into buckets of about
``BUCKET_ROWS`` rows per source (a source with a third of all rows is many buckets),
each bucket leaves at most one fractional document, and those meet in the next
level, ``FAN_IN`` buckets at a time, until one per source is left; that one is drawn.
Random numbers come from the seed, source, level and bucket, and the order inside a
bucket from a hash, so reruns agree whatever the partitioning.

Equal rows (same id, source, size and text) are one item with a count, so repeated
rows cannot fill a bucket. Sources are a driver-side table of targets: at most
``MAX_SOURCES``, checked.

Defined results: NULL text has no words and is taken 0 words; NULL source is a
source of its own, last in the order; NULL and repeated ids are rows like others; a
table without rows gives none; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, small_frame, word_count

BUCKET_ROWS = 1024
FAN_IN = 512
MAX_SOURCES = 100_000
BROADCAST_SOURCES = 2_000
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_COPIES = 2.0
SEED = 42
SLOT = 64             # copies of a row that one task writes at a time
EDGE = 1e-9


def water_fill(sizes: list[int], weights: list[float], share: float, cap: float) -> list[float]:
    """Targets: ``share`` of all words by weight, none above ``cap`` times its own words."""
    pool, target = share * sum(sizes), [0.0] * len(sizes)
    active = list(range(len(sizes)))
    while active:
        total = sum(weights[i] for i in active)
        full = [i for i in active if pool * weights[i] / total >= cap * sizes[i]]
        if not full:
            for i in active:
                target[i] = pool * weights[i] / total
            break
        for i in full:
            target[i] = cap * sizes[i]
        pool = max(0.0, pool - sum(target[i] for i in full))
        done = set(full)
        active = [i for i in active if i not in done]
    return target


def pivot_all(p: list[float], w: list[float], rng: np.random.Generator) -> tuple[list[float], int]:
    """Round fractions one after the other, keeping sum(w * p); returns them and the index still open (or -1)."""
    p, draws, held = list(p), rng.random(len(p)), -1
    for j in range(len(p)):
        if p[j] <= EDGE or p[j] >= 1 - EDGE:
            p[j] = float(round(p[j]))
            continue
        if held < 0:
            held = j
            continue
        i = held
        up, down = min((1 - p[i]) * w[i], p[j] * w[j]), min(p[i] * w[i], (1 - p[j]) * w[j])
        move = up if draws[j] * (up + down) < down else -down
        p[i] += move / w[i]
        p[j] -= move / w[j]
        held = -1
        for x in (i, j):
            if EDGE < p[x] < 1 - EDGE:
                held = x
            else:
                p[x] = float(round(p[x]))
    return p, held


def _reduce(level: int, seed: int, last: bool):
    def reduce(group: pa.Table) -> pa.Table:
        # long documents settle first, so the one that stays open tends to be short
        group = group.sort_by([("size", "descending"), ("order", "ascending"), ("doc_id", "ascending"),
                               ("digest", "ascending")])
        name = f"{seed}|{level}|{group['source_key'][0].as_py()}|{group['bucket'][0].as_py()}"
        rng = np.random.default_rng(int.from_bytes(hashlib.sha256(name.encode()).digest()[:8], "big"))
        p, rest = pivot_all(group["p"].to_pylist(), group["size"].to_pylist(), rng)
        if last and rest >= 0:
            p[rest] = float(rng.random() < p[rest])
            rest = -1
        open_ = [i == rest for i in range(len(p))]
        group = group.set_column(group.schema.get_field_index("p"), "p", pa.array(p))
        return group.append_column("open", pa.array(open_))
    return reduce


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_copies: float = MAX_COPIES,
        key: str = "doc_id", source: str = "source", text: str = "text", seed: int = SEED) -> DataFrame:
    """Copies of every distinct row: (key, digest, source_key, size, m, copies, source_size, target).

    ``m`` rows are equal; ``copies`` is what the mix takes of them together.
    ``weights`` repeat over the sources in code-point order, NULL last.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.when(F.col(source).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source))).alias("source_key"),
        word_count(F.col(text)).alias("size"),
        F.xxhash64(F.col(text)).alias("digest"))
    items = saved(rows.groupBy("doc_id", "source_key", "size", "digest").agg(F.count("*").alias("m")))

    totals = (items.groupBy("source_key").agg(F.sum(F.col("size") * F.col("m")).alias("words"),
                                              F.count("*").alias("n"))
              .limit(MAX_SOURCES + 1).collect())
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources to weigh")
    totals = sorted(totals, key=lambda r: r["source_key"])
    sizes = [r["words"] for r in totals]
    target = water_fill(sizes, [float(weights[i % len(weights)]) for i in range(len(totals))], share, max_copies)
    plan = [(r["source_key"], r["words"], t, t / r["words"] if r["words"] else 0.0,
             max(1, math.ceil(r["n"] / BUCKET_ROWS))) for r, t in zip(totals, target)]
    rates = small_frame(spark, plan, ["source_key", "source_size", "target", "rate", "buckets"],
                        "source_key string, source_size long, target double, rate double, buckets long")
    rates_joined = F.broadcast(rates) if len(plan) <= BROADCAST_SOURCES else rates

    want = F.col("m") * F.col("rate")
    exact = F.when(F.abs(want - F.round(want)) < EDGE * 10, F.round(want)).otherwise(want)
    rated = (items.join(rates_joined, "source_key").withColumn("want", exact)
             .withColumn("base", F.floor("want").cast("long"))
             .withColumn("p", F.when(F.col("size") > 0, F.col("want") - F.col("base")).otherwise(0.0))
             .withColumn("order", F.xxhash64(F.lit(seed), "doc_id", "digest"))
             .withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "digest"), "buckets"))
             .drop("want", "rate", "buckets", "source_size", "target"))
    done = [rated.filter("p = 0")]
    todo, most, level = rated.filter("p > 0"), max([x[4] for x in plan], default=1), 0
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rated.schema) + ", open boolean"
    while True:
        out = saved(todo.groupBy("source_key", "bucket").applyInArrow(_reduce(level, seed, most == 1), schema))
        done.append(out.filter("NOT open").drop("open"))
        if most == 1:
            break
        most, level = math.ceil(most / FAN_IN), level + 1
        todo = out.filter("open").drop("open").withColumn("bucket", F.floor(F.col("bucket") / FAN_IN))
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return (result.join(rates_joined.drop("rate", "buckets"), "source_key")
            .select(F.col("doc_id").alias(key), "digest", "source_key", "size", "m",
                    (F.col("base") + F.round("p")).cast("long").alias("copies"), "source_size", "target"))


def mix_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, one row per document; of equal rows the first take the odd copies."""
    each = mix(docs).withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))))
    copies = (F.floor(F.col("copies") / F.col("m"))
              + (F.col("i") <= F.col("copies") % F.col("m")).cast("long")).cast("long")
    return each.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"),
                       copies.alias("copies"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mixed corpus: every row as often as the mix takes it, columns of ``docs``."""
    taken = mix(docs).filter("copies > 0").select(
        F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), F.col("source_key").alias("_source"),
        F.col("m").alias("_m"), F.col("copies").alias("_copies"))
    names = docs.columns
    source = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source")))

    def with_copies(part: DataFrame) -> DataFrame:
        return docs.join(part, F.col("doc_id").eqNullSafe(F.col("_id"))
                         & (F.xxhash64(F.col("text")) == F.col("_digest")) & (source == F.col("_source")))

    # equal rows: one of them, copied as often as all together
    single = with_copies(taken.filter("_m = 1"))
    repeated = with_copies(taken.filter("_m > 1")).dropDuplicates(["_id", "_digest", "_source"])
    # copies of equal rows may be any share of the mix: they are cut into slots, and these dealt out
    slots = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / SLOT))
    dealt = repeated.withColumn("_slot", F.explode(slots)).withColumn(
        "_copies", F.least(F.lit(SLOT).cast("long"), F.col("_copies") - F.col("_slot") * SLOT)).drop("_slot")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = single.unionByName(dealt.repartition(parts))
    return both.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(*names)
