"""Operator 8: exact round trip, record types by plain grouping, index searches against a scan."""

import gzip
import hashlib
import random

import pytest

from rows import SMALL
from subledger.llm import warc
from subledger.llm.queries import op8_warc

SCHEMA = "page_id long, url string, html string"


def plain(rows):
    best = {}
    for i, _, html in rows:
        raw = (html or "").encode()
        if len(raw) >= 1000:
            best.setdefault(raw, []).append(i)
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        top = max(best.get(raw, [None]), key=lambda x: (x is not None, x or 0))
        revisit = raw in best and i != top
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response",
                    top if revisit else None))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()),
                  key=str)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html").collect()]
    assert got(op8_warc(spark, SMALL)) == plain(rows)


def test_read_back_in_as_many_tasks_as_blocks_fill(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 8)
    monkeypatch.setattr(warc, "BLOCKS_A_TASK", 4)
    pages = spark.range(2_000).selectExpr("id page_id", "concat('http://h', id % 7, '.org/', id) url", "'<p>x' html")
    archive = warc.write_archive(pages)
    blocks = archive.blocks.count()
    rows = warc.read_archive(spark, archive)
    assert rows.rdd.getNumPartitions() == -(-blocks // 4) > 1
    assert rows.count() == 2_000
    archive.delete()


def test_sort_key():
    assert warc.sort_key("https://www.Example.com:8080/a b?q=1#top") == "com,example,www:8080)/a%20b?q=1"
    assert warc.sort_key(None) == ")/" == warc.sort_key("")
    assert warc.sort_key("http://[bad") == ")/http://[bad"


@pytest.fixture(scope="module")
def made():
    r = random.Random(1)
    rows = []
    for i in range(700):
        host = r.choice(["a.example.com", "b.example.com", "hot.example.org", "hot.example.org"])
        url = r.choice([f"http://{host}/p/{r.randint(0, 300)}", "https://hot.example.org/same"])
        html = r.choice(["<p>" + "same payload é " * 90, f"<p>{i}</p>" + "x" * r.randint(0, 3000), "short", "", None])
        rows.append((i, url, html))
    rows += [(None, None, None), (None, "no url at all\n", "z" * 2000), (None, None, "z" * 2000),
             (-5, "http://x/", "z" * 2000), (12, "http://twice/", "t" * 1500), (12, "http://twice/", "t" * 1500),
             (9000, "http://long/" + "l" * 5000, "long \r\n\r\n" * 200_000)]
    return rows


def test_round_trip_and_searches(spark, made, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 16)
    pages = spark.createDataFrame([(*r, "x", 1) for r in made], SCHEMA + ", record_type string, bytes int").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several index files
    try:
        archive = warc.write_archive(pages)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(archive.files) > 1 and archive.blocks.count() > 40
    back = warc.read_archive(spark, archive, with_payload=True)
    assert got(back) == plain(made)
    whole = sorted((str(r.page_id), bytes(r.payload)) for r in back.collect() if r.record_type == "response")
    kinds = {(i, n, d): t for i, n, d, t, _ in plain(made)}
    assert whole == sorted((str(i), raw) for i, raw in ((i, (h or "").encode()) for i, _, h in made)
                           if kinds[i, len(raw), hashlib.sha1(raw).hexdigest()] == "response")
    # members are plain gzip, records follow one another
    fs, folder = warc.store(archive.root)
    names = [f.path for f in fs.get_file_info(warc.pyarrow.fs.FileSelector(folder)) if f.path.endswith(".warc.gz")]
    text = b"".join(gzip.decompress(open(n, "rb").read()) for n in names)
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == len(made)
    # searches
    urls = sorted({u for _, u, _ in made if u}) + ["http://nobody/", "zzz", "http://a.example.com/"]
    found = warc.lookup(archive, spark.createDataFrame([(u,) for u in urls], "url string"), with_payload=False)
    assert got(found) == sorted((p for p, (_, u, _) in zip([x for r in made for x in plain_one(made, r)], made) if u),
                                key=str)
    reader = warc.Reader(archive.root, archive.files)
    keys = sorted(k for k, *_ in reader.between("", "\U0010ffff"))
    assert len(keys) == len(set(keys)) == len(made)
    r = random.Random(2)
    for _ in range(40):
        low, high = sorted(r.choice(keys) + r.choice(["", "!"]) for _ in range(2))
        assert [k for k, *_ in reader.between(low, high)] == [k for k in keys if low <= k <= high]
    reader.close()
    archive.delete()
    assert fs.get_file_info(folder).type == warc.pyarrow.fs.FileType.NotFound


def plain_one(rows, row):
    raw = (row[2] or "").encode()
    key = (row[0], len(raw), hashlib.sha1(raw).hexdigest())
    return [next(p for p in plain(rows) if p[:3] == key)]


def test_empty(spark):
    assert warc.archive_digest(spark.createDataFrame([], SCHEMA)).collect() == []
