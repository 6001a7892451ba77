"""Operator 2: personal data, by patterns and by information-theoretic sanitisation.

Base spans (e-mail, IP, card, phone) are the protected entities. A term near an entity
can give it away: how much is measured on the corpus. With N documents, n(e) of them
holding the entity, n(t) the term and n(e,t) the term within ``NEAR`` words of the
entity, the term discloses PMI(t;e) = ln(N n(e,t) / (n(t) n(e))) of the entity's
information IC(e) = ln(N / n(e)). Terms seen with the entity in ``SUPPORT`` documents
or more whose share PMI/IC reaches ``DISCLOSED`` are sanitised where they occur near
it: a term with digits is generalised (digits become 0) if its general form stays
below the threshold, any other is removed.

All counts are over all documents. Only terms seen near an entity matter, so they are
marked in a bitmap of ``BITS`` bits (built by Spark, 2 MB whatever the corpus), and the
document frequencies are counted in the tasks for marked terms only; a false mark costs
a row, the counts are joined on the terms themselves. Entities, pairs and frequencies
stay distributed; a frequent entity or term is pre-aggregated before each shuffle.

Patterns run in linear time on any text: e-mails are found from their @, numbers from
the start of their digits.

Defined results: NULL text counts as empty; a document without finds has the digest of
the empty string and no spans; equal rows get equal spans; NULL ids are rows like
others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

KINDS = ("email", "ip", "card", "phone")
NEAR = 8
SUPPORT = 2
DISCLOSED = 0.8
BITS = 1 << 24
BUCKET_BITS = 32_768     # of Spark's bitmap functions
FLUSH = 200_000          # terms that a task counts before it hands them on

# fixed values: the contract's patterns; possessive forms and the look-behind only keep them linear
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
TERM = re.compile(r"\w+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        # what lies left of an @ can't hold a later match's start
        done = found.end() if found else at + 1
        if found:
            yield start, done
        at = text.find("@", done)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = [("email", a, b) for a, b in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            if all(len(p) < 4 and int(p or 0) <= 255 for p in parts):
                out.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        for m in PHONE.finditer(text) if "+" in text else ():
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


def entity(kind: str, value: str) -> str:
    """One name for all spellings of the same entity."""
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else ''.join(c for c in value if c.isdigit())}"


def general(term: str) -> str | None:
    """The general form of a term with digits, marked so that no plain term equals it."""
    return "0:" + DIGIT.sub("0", term) if DIGIT.search(term) else None


def near_terms(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, str, int, int]]:
    """(entity, term, start, end) of the terms within ``NEAR`` terms of a span, outside all spans."""
    if not spans:
        return []
    inside = sorted((a, b) for _, a, b in spans)
    merged: list[list[int]] = []
    for a, b in inside:
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    starts = [m[0] for m in merged]
    free = []
    for m in TERM.finditer(text):
        k = bisect_right(starts, m.start()) - 1
        if not (k >= 0 and merged[k][1] > m.start() or k + 1 < len(merged) and starts[k + 1] < m.end()):
            free.append((m.start(), m.end()))
    firsts = [f[0] for f in free]
    out = []
    for kind, a, b in spans:
        k, name = bisect_left(firsts, a), entity(kind, text[a:b])
        for s, e in free[max(0, k - NEAR):k + NEAR]:
            out.append((name, text[s:e].lower(), s, e))
    return out


FOUND = ("doc_id long, digest long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
         "base string, entities array<string>, near array<struct<entity: string, term: string, general: string, "
         "start: int, end: int, is_first: boolean>>")
NEAR_TYPE = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string()), ("general", pa.string()),
                                ("start", pa.int32()), ("end", pa.int32()), ("is_first", pa.bool_())]))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for value in batch["text"]:
            text = value.as_py() or ""
            spans = base_spans(text)
            line = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
            n, seen, near = Counter(k for k, _, _ in spans), set(), []
            for name, term, a, b in near_terms(text, spans):
                near.append({"entity": name, "term": term, "general": general(term), "start": a, "end": b,
                             "is_first": (name, term) not in seen})
                seen.add((name, term))
            rows.append((*(n[k] for k in KINDS), hashlib.sha256(line.encode()).hexdigest(), line,
                         sorted({entity(k, text[a:b]) for k, a, b in spans}), near))
        types = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.list_(pa.string()), NEAR_TYPE]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["digest"], *columns],
            ["doc_id", "digest", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "entities", "near"])


def _bitmap(terms: DataFrame) -> bytes:
    """``BITS`` bits, one of them set for each term."""
    at = (F.crc32(F.col("term").cast("binary")) % BITS).alias("at")
    rows = (terms.select(at).groupBy(F.expr("bitmap_bucket_number(at)").alias("bucket"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(at))").alias("bits")).collect())
    out = bytearray(BITS // 8 + BUCKET_BITS // 8)
    for r in rows:  # bucket 0 holds position 0, bucket 1 positions 1 to 32768
        out[r["bucket"] * BUCKET_BITS // 8:(r["bucket"] + 1) * BUCKET_BITS // 8] = r["bits"]
    return bytes(out)


def marked(bitmap: bytes, term: str) -> bool:
    at = crc32(term.encode()) % BITS
    bucket = (at - 1) // BUCKET_BITS + 1 if at else 0
    position = (at - 1) % BUCKET_BITS if at else 0
    return bool(bitmap[bucket * (BUCKET_BITS // 8) + position // 8] >> position % 8 & 1)


def _frequencies(bitmap):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, counts = bitmap.value, Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()),
                                               pa.array(counts.values(), pa.int64())], ["term", "df"])
        for batch in batches:
            for value in batch.column(0):
                own = {t.lower() for t in set(TERM.findall(value.as_py() or ""))}
                own |= {general(t) for t in own if DIGIT.search(t)}
                counts.update(t for t in own if marked(bits, t))
                if len(counts) > FLUSH:
                    yield out()
                    counts.clear()
        if counts:
            yield out()
    return run


def _with_terms(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Found base rows, and (doc_id, digest, start, end, term, action) of the sanitised terms, by equal rows."""
    found = saved(docs.select(F.col(key).alias("doc_id"), F.xxhash64(F.col(text)).alias("digest"),
                              F.col(text).alias("text")).mapInArrow(_find, FOUND))
    total = found.count()
    near = found.filter("size(near) > 0").select(
        "doc_id", "digest", F.monotonically_increasing_id().alias("row"), F.explode("near").alias("x")).select(
        "doc_id", "digest", "row", "x.*")
    pairs = saved(near.filter("is_first").groupBy("entity", "term", "general").agg(F.count("*").alias("both"))
                  .filter(F.col("both") >= SUPPORT))
    shapes = (near.filter("general IS NOT NULL").groupBy("entity", "general")
              .agg(F.count_distinct("row").alias("general_both")))   # rows, as everywhere else
    wanted = pairs.select("term").union(pairs.filter("general IS NOT NULL").select("general"))
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(wanted))
    df = saved(docs.select(text).mapInArrow(_frequencies(bitmap), "term string, df long")
               .groupBy("term").agg(F.sum("df").alias("df")))
    of = found.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("of"))

    def share(both, df):
        return F.log(F.lit(float(total)) * both / (df * F.col("of"))) / F.log(F.lit(float(total)) / F.col("of"))
    told = (pairs.join(of, "entity").filter(F.col("of") < total)
            .join(df, "term").filter(share(F.col("both"), F.col("df")) >= DISCLOSED)
            .join(shapes, ["entity", "general"], "left")
            .join(df.select(F.col("term").alias("general"), F.col("df").alias("general_df")), "general", "left")
            .withColumn("action", F.when(share(F.col("general_both"), F.col("general_df")) < DISCLOSED,
                                         F.lit("generalise")).otherwise(F.lit("remove")))
            .select("entity", "term", "action"))
    terms = near.join(told, ["entity", "term"]).groupBy("doc_id", "digest", "start", "end", "term").agg(
        F.max("action").alias("action"))  # remove beats generalise
    return found, terms


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The contract's columns per document; ``spans`` holds base spans, then sanitised terms (kind ``term``)."""
    found, terms = _with_terms(docs, key, text)
    listed = terms.groupBy(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("start", "end"))),
                                 lambda s: F.concat(F.lit("term:"), s["start"], F.lit(":"), s["end"])), ",")
        .alias("_terms"), F.count_distinct("start", "end").alias("_n"))
    joined = found.join(listed, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
    spans = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), "_terms")
    return joined.select(F.col("doc_id").alias(key), "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
                         spans.alias("spans"), F.coalesce("_n", F.lit(0)).cast("long").alias("n_term"))


def _replace(at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = []
            for value, actions in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                cuts = [(a, b, f"[{k.upper()}]") for k, a, b in base_spans(value or "")]
                for x in actions or ():
                    cuts.append((x["start"], x["end"],
                                 general(x["term"])[2:] if x["action"] == "generalise" else "[TERM]"))
                out, done = [], 0
                for a, b, label in sorted(cuts):
                    if a >= done:
                        out += [value[done:a], label]
                    done = max(done, b)
                new.append(value if not cuts else "".join(out) + value[done:])
            columns = batch.columns[:-1]
            columns[at] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])
    return run


def sanitised(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with entities replaced by their kind and disclosing terms generalised or removed."""
    _, terms = _with_terms(docs, key, text)
    listed = terms.groupBy(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).agg(
        F.collect_set(F.struct("start", "end", "term", "action")).alias("_actions"))
    joined = docs.join(listed, F.col(key).eqNullSafe(F.col("_id")) & (F.xxhash64(F.col(text)) == F.col("_digest")),
                       "left").select(*docs.columns, "_actions")
    return joined.mapInArrow(_replace(docs.columns.index(text)), docs.schema)
