"""Operator 8: WARC archives with a two-level capture index.

Writing: every task writes its pages as WARC records, one gzip member each, to a file of
its own in the shared folder, and returns where each record lies. Of records with the
same payload of ``REVISIT_BYTES`` or more, the one with the largest page_id is the
response, the others are revisits that refer to it and hold no payload.

Index: captures are sorted by a key of reversed host, path and query, page_id and place;
every sorted partition becomes an index file of compressed blocks of ``BLOCK`` lines,
followed by a sparse directory of the blocks' first keys. The files' own first keys are
the upper level, one entry per partition. A search bisects the files, then a file's
directory, reads one block by range, and then the record by range. A host or URL with a
third of all captures is spread over as many blocks and files as it fills.

Files are named by task attempt, and only those that a finished attempt returned are
ever read; a task that is lost and run again leaves an unused file at most. Paths may be
of any store that pyarrow reads (local mount, s3, gs, hdfs).

Defined results: NULL html is an empty payload; NULL url has the key of the empty host;
NULL page_id is smaller than any other; rows with the same page_id and payload are all
responses if theirs is the largest page_id; an empty table gives an archive without
files; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path
from .common import saved, sort_key

BLOCKS_A_TASK = 16      # index blocks read back by one task
REVISIT_BYTES = 1000
BLOCK = 512
BROADCAST_DIGESTS = 100_000
LEVEL = 5
DATE = "1970-01-01T00:00:00Z"   # pages carry no time
TRAILER = "<QQ"    # where the directory starts, and its length


def store(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path within it."""
    if "://" in path or path.startswith("file:"):
        return pyarrow.fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "file:///", path)))
    return pyarrow.fs.LocalFileSystem(), path


def capture_key(url: str | None, page_id: int | None, file: str, offset: int) -> str:
    page = "" if page_id is None else f"{page_id + 2**63:020d}"
    return f"{sort_key(url)} {page:>20} {file} {offset:020d}"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, response_id: int | None,
                revisit: bool) -> bytes:
    """One WARC record; ``digest`` is the payload's SHA-1 in hex."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
            ).encode()
    block = http if revisit else http + payload
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, digest)),
            ("WARC-Date", DATE), ("WARC-Target-URI", uri),
            ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
            ("X-Page-Id", "" if page_id is None else str(page_id))]
    if revisit:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", record_id(response_id, digest)), ("X-Refers-To-Page-Id", str(response_id))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    deflate = zlib.compressobj(LEVEL, wbits=31)
    return deflate.compress(data) + deflate.flush()


def parse_record(member: bytes) -> dict:
    data = zlib.decompress(member, wbits=31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                  for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda s: int(s) if s else None
    out = {"page_id": number(fields["X-Page-Id"]), "url": fields["WARC-Target-URI"],
           "record_type": fields["WARC-Type"], "payload": None, "refers_to": None,
           "payload_bytes": int(re.search(rb"\r\nContent-Length: (\d+)", http)[1]),
           "payload_digest": base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex()}
    if out["record_type"] == "revisit":
        return out | {"refers_to": number(fields["X-Refers-To-Page-Id"])}
    if len(payload) != out["payload_bytes"] or hashlib.sha1(payload).hexdigest() != out["payload_digest"]:
        raise ValueError(f"damaged record of page {out['page_id']}")
    return out | {"payload": payload}


# --- writing -----------------------------------------------------------------------------
def _write_records(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, name = None, 0, f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}.warc.gz"
        fs, folder = store(root)
        try:
            for batch in batches:
                rows = []
                for r in batch.to_pylist():
                    if out is None:
                        fs.create_dir(folder, recursive=True)
                        out = fs.open_output_stream(f"{folder}/{name}", compression=None)
                    member = gzip_member(make_record(r["page_id"], r["url"], (r["html"] or "").encode(), r["digest"],
                                                     r["keeper"], r["revisit"]))
                    out.write(member)
                    rows.append((capture_key(r["url"], r["page_id"], name, at), name, at, len(member)))
                    at += len(member)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64(), pa.int64()))],
                        ["key", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()
    return run


def _write_index(root: str):
    """A sorted partition becomes compressed blocks, their directory and its place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, blocks, lines = None, 0, [], []
        name = f"index-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}"
        fs, folder = store(root)

        def flush():
            nonlocal out, at
            if out is None:
                fs.create_dir(folder, recursive=True)
                out = fs.open_output_stream(f"{folder}/{name}", compression=None)
            data = gzip_member("\n".join(json.dumps(x) for x in lines).encode())
            out.write(data)
            blocks.append((lines[0][0], lines[-1][0], at, len(data)))
            at += len(data)
            lines.clear()
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                lines.append(row)
                if len(lines) == BLOCK:
                    flush()
        if lines:
            flush()
        if out is not None:
            data = gzip_member(json.dumps([[first, start, length] for first, _, start, length in blocks]).encode())
            out.write(data + struct.pack(TRAILER, at, len(data)))
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(blocks), pa.string()),
                                              pa.array([b[0] for b in blocks], pa.string()),
                                              pa.array([b[1] for b in blocks], pa.string())], ["file", "first", "last"])
    return run


@dataclass
class Archive:
    """Where the files are, the upper level of the index, and the blocks' key ranges as a table."""
    root: str
    files: list[tuple[str, str]]        # (first key, index file), sorted
    blocks: DataFrame

    def delete(self) -> None:
        fs, folder = store(self.root)
        fs.delete_dir_contents(folder, missing_dir_ok=True)
        fs.delete_dir(folder) if fs.get_file_info(folder).type != pyarrow.fs.FileType.NotFound else None


@dataclass
class Reader:
    """Searches of one task: bisects files and directories, reads blocks and records by range."""
    root: str
    files: list[tuple[str, str]]
    directories: dict[str, list] = field(default_factory=dict)
    handles: dict = field(default_factory=dict)

    def bytes_at(self, name: str, offset: int, length: int) -> bytes:
        if name not in self.handles:
            if len(self.handles) > 64:
                self.handles.pop(next(iter(self.handles))).close()
            fs, folder = store(self.root)
            self.handles[name] = fs.open_input_file(f"{folder}/{name}")
        return self.handles[name].read_at(length, offset)

    def directory(self, name: str) -> list:
        if name not in self.directories:
            if len(self.directories) > 64:
                self.directories.pop(next(iter(self.directories)))
            self.bytes_at(name, 0, 1)
            size = self.handles[name].size()
            start, length = struct.unpack(TRAILER, self.bytes_at(name, size - 16, 16))
            self.directories[name] = json.loads(zlib.decompress(self.bytes_at(name, start, length), wbits=31))
        return self.directories[name]

    def between(self, low: str, high: str) -> Iterator[tuple[str, str, int, int]]:
        """Index lines with low <= key <= high."""
        first = max(0, bisect_right(self.files, low, key=lambda f: f[0]) - 1)
        for start, name in self.files[first:]:
            if start > high:
                return
            blocks = self.directory(name)
            for key, offset, length in blocks[max(0, bisect_right(blocks, low, key=lambda b: b[0]) - 1):]:
                if key > high:
                    return
                for line in zlib.decompress(self.bytes_at(name, offset, length), wbits=31).split(b"\n"):
                    row = json.loads(line)
                    if low <= row[0] <= high:
                        yield tuple(row)

    def records(self, low: str, high: str) -> Iterator[dict]:
        for _, file, offset, length in self.between(low, high):
            yield parse_record(self.bytes_at(file, offset, length))

    def close(self) -> None:
        for h in self.handles.values():
            h.close()


def write_archive(pages: DataFrame, root: str | None = None) -> Archive:
    """Write all pages (page_id, url, html) and their index below ``root`` (default: a new shared folder)."""
    spark = pages.sparkSession
    root = root or work_path(spark, "warc")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", "html", F.sha1(payload).alias("digest"),
                        F.octet_length(payload).alias("bytes"))
    keepers = saved(rows.filter(F.col("bytes") >= REVISIT_BYTES).groupBy("digest")
                    .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).filter("n > 1")
                    .select("digest", "keeper", F.lit(True).alias("several")))
    if keepers.count() <= BROADCAST_DIGESTS:
        keepers = F.broadcast(keepers)
    typed = rows.join(keepers, "digest", "left").withColumn(
        "revisit", F.coalesce("several", F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("keeper")))
    captures = saved(typed.select("page_id", "url", "html", "digest", "keeper", "revisit")
                     .mapInArrow(_write_records(root), "key string, file string, offset long, length long"))
    blocks = saved(captures.orderBy("key").mapInArrow(_write_index(root), "file string, first string, last string"))
    files = sorted((r["first"], r["file"]) for r in
                   blocks.groupBy("file").agg(F.min("first").alias("first")).collect())
    return Archive(root, files, blocks)


RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def _read(archive_root: str, files, with_payload: bool, ranges):
    names = [x.split()[0] for x in RECORD.split(", ")] + ["payload"] * with_payload
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()] + [pa.binary()] * with_payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(archive_root, files.value)
        try:
            for batch in batches:
                for low, high in ranges(batch):
                    found = []
                    for r in reader.records(low, high):
                        found.append([r[n] for n in names])
                        if len(found) == BLOCK:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names)
                            found = []
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names)
        finally:
            reader.close()
    return run


def read_archive(spark: SparkSession, archive: Archive, with_payload: bool = False) -> DataFrame:
    """All records, each found through the index: one search per block of keys."""
    files = spark.sparkContext.broadcast(archive.files)
    # blocks are key ranges of a few bytes that stand for megabytes of pages: by their own size they would
    # all be merged into one task, so the number of tasks follows the number of blocks
    tasks = max(1, -(-archive.blocks.count() // BLOCKS_A_TASK))
    work = archive.blocks.select("first", "last").repartition(tasks, F.xxhash64("first"))
    return work.mapInArrow(
        _read(archive.root, files, with_payload,
              lambda batch: zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())),
        RECORD + ", payload binary" * with_payload)


def lookup(archive: Archive, urls: DataFrame, url: str = "url", with_payload: bool = True) -> DataFrame:
    """The records of the URLs of a table (those that differ, each once)."""
    files = urls.sparkSession.sparkContext.broadcast(archive.files)

    def ranges(batch):
        keys = sorted({sort_key(u) for u in batch.column(0).to_pylist()})
        return [(k + " ", k + "!") for k in keys]
    return urls.select(url).distinct().mapInArrow(_read(archive.root, files, with_payload, ranges),
                                                  RECORD + ", payload binary" * with_payload)


def archive_digest(pages: DataFrame) -> DataFrame:
    """The contract's columns, from records written to archives and read back through the index."""
    archive = write_archive(pages)
    rows = saved(read_archive(pages.sparkSession, archive).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    archive.delete()
    return rows


#: DuckDB SQL of ``archive_digest``
ORACLE = f"""
WITH d AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
           FROM pages),
largest AS (SELECT payload_digest, max(page_id) AS keeper, count(*) AS n FROM d
            WHERE payload_bytes >= {REVISIT_BYTES} GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN n > 1 AND page_id IS DISTINCT FROM keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n > 1 AND page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
FROM d LEFT JOIN largest USING (payload_digest)"""
