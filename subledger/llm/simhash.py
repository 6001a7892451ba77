"""Operator 7: SimHash near-duplicates found with vantage-point trees.

Fingerprint: every word shingle of the ASCII-lowercased text is hashed with XXH64
(seed 42); a bit of the 64 is set if more than half of the hashes set it. Texts
whose fingerprints differ in at most ``max_bits`` bits are linked; a document's
component is named by the smallest doc_id reachable over links.

Search: equal fingerprints are grouped first, so copies cost one row. The 64 bits are
cut into ``bands`` bands; two fingerprints within ``max_bits`` differ in at most
``max_bits // bands`` bits of some band. Hamming distance on a band is a metric, so
each band gets a vantage-point tree: an inner node holds a vantage fingerprint v and a
threshold t; fingerprints at distance d <= t belong to the left branch, the others to
the right one. A partner within radius r of a fingerprint at distance d lies at d - r
to d + r (triangle bounds), so a branch outside them is pruned, and a fingerprint
whose bounds cross t also visits the other side. A pair separated at a node needs one
of its two visits only: right ones visit left. The trees' leaves are the shards: every
fingerprint goes to its home shard and the boundary-overlapping ones, and each shard
compares its home fingerprints with one another and with its visitors on all 64 bits,
so the result is exact. Parts of a shard that are too large are split by further
trees inside the task. Shards return a spanning star per linked group, not all pairs.

The trees are built on the driver from a bounded sample (``SAMPLE`` fingerprints with
the smallest hashes); the sample only shapes the shards, every fingerprint is indexed.

Defined results: NULL text and text without words have fingerprint zero and are
linked with one another; NULL doc_ids are named last (a component of only NULL ids
has component NULL); equal rows share a component; empty tables give no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved
from .components import component_roots

SHINGLE_WORDS = 4
MAX_BITS = 4
BANDS = 3
SAMPLE = 16_384
SHARD_ROWS = 2_048
LOCAL_ROWS = 4_096
SEED = 42
CHUNK = 200_000
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, n: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit fingerprint of a text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = min(n, len(words))
    starts, ends = starts[:len(words) - n + 1], ends[n - 1:]
    digest, votes = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for i in range(0, len(starts), CHUNK):
        hashes = b"".join([digest(line[a:b], SEED) for a, b in zip(starts[i:i + CHUNK].tolist(),
                                                                   ends[i:i + CHUNK].tolist())])
        votes += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.uint32)
    return int.from_bytes(np.packbits(votes * 2 > len(starts)).tobytes(), "big", signed=True)


def _fingerprints(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array([fingerprint(x.as_py(), n) for x in batch["text"]], pa.int64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["digest"], values], ["doc_id", "digest", "fp"])
    return run


# --- vantage-point trees -----------------------------------------------------------------
@dataclass
class Node:
    vantage: np.uint64
    mask: np.uint64
    radius: int
    limit: int
    left: int    # a node's number, or -1 - leaf
    right: int


def _split(points: np.ndarray, mask: np.uint64, radius: int) -> tuple[np.uint64, int] | None:
    """Vantage fingerprint and threshold: balanced sides, little mass within the radius of the border."""
    best = None
    for v in points[np.linspace(0, len(points) - 1, 6).astype(int)]:
        counts = np.bincount(np.bitwise_count((points ^ v) & mask), minlength=65).astype(float)
        left = np.cumsum(counts) / len(points)
        for t in range(64):
            if not 0 < left[t] < 1:
                continue
            near = counts[max(0, t - radius + 1):t + radius + 1].sum() / len(points)
            cost = near + 4 * max(0.0, 0.3 - min(left[t], 1 - left[t]))
            if best is None or cost < best[0]:
                best = (cost, v, t)
    return None if best is None else (best[1], best[2])


def build_tree(points: np.ndarray, mask: np.uint64, radius: int, full_radius: int, leaf: int) -> list[Node]:
    """Tree over sample points; leaves hold at most ``leaf`` of them where they can be told apart."""
    nodes: list[Node] = []
    leaves = 0
    todo = [(points, -1, False)]
    while todo:
        own, parent, right = todo.pop()
        found, use, r = None, mask, radius
        if len(own) > leaf:
            found = _split(own, mask, radius)
            if found is None:  # alike on the band: go on with all bits
                found, use, r = _split(own, ALL, full_radius), ALL, full_radius
        if found is None:
            number = -1 - leaves
            leaves += 1
        else:
            number = len(nodes)
            nodes.append(Node(found[0], use, r, found[1], 0, 0))
            d = np.bitwise_count((own ^ found[0]) & use)
            todo += [(own[d > found[1]], number, True), (own[d <= found[1]], number, False)]
        if parent >= 0:
            setattr(nodes[parent], "right" if right else "left", number)
    return nodes


def route(nodes: list[Node], home: np.ndarray, visit: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(leaf, home fingerprints, visitors) for the leaves that are reached."""
    todo = [(0 if nodes else -1, home, visit)]
    while todo:
        at, home, visit = todo.pop()
        if not len(home) and not len(visit):
            continue
        if at < 0:
            yield -1 - at, home, visit
            continue
        n = nodes[at]
        d = np.bitwise_count((home ^ n.vantage) & n.mask).astype(np.int16)
        e = np.bitwise_count((visit ^ n.vantage) & n.mask).astype(np.int16)
        todo.append((n.right, home[d > n.limit], visit[e + n.radius > n.limit]))
        over = home[(d > n.limit) & (d - n.radius <= n.limit)]
        todo.append((n.left, home[d <= n.limit], np.concatenate([over, visit[e - n.radius <= n.limit]])))


def band_masks(bands: int) -> list[np.uint64]:
    edges = [64 * i // bands for i in range(bands + 1)]
    return [np.uint64(((1 << b) - 1) ^ ((1 << a) - 1)) for a, b in zip(edges, edges[1:])]


def _route_task(trees: list[list[Node]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.uint64)
        fps = [b["fp"].to_numpy().view(np.uint64) for b in batches]
        mine = np.concatenate(fps) if fps else none
        for band, nodes in enumerate(trees):
            for i in range(0, len(mine), CHUNK):
                rows = list(route(nodes, mine[i:i + CHUNK], none))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([band] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.int32()),
                         pa.array([r[1].tobytes() for r in rows], pa.binary()),
                         pa.array([r[2].tobytes() for r in rows], pa.binary())], ["band", "shard", "home", "visit"])
    return run


def link(home: np.ndarray, visit: np.ndarray, mask: np.uint64, radius: int, max_bits: int,
         local_rows: int = LOCAL_ROWS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spanning stars (members, roots) of the links of home fingerprints with each other and with visitors."""
    if len(home) > local_rows:
        picked = home[np.linspace(0, len(home) - 1, 2_048).astype(int)]
        nodes = build_tree(np.unique(picked), mask, radius, max_bits, max(8, 2_048 * local_rows // (2 * len(home))))
        if nodes:
            stars = []
            for _, h, v in route(nodes, home, visit):
                # a tree that doesn't make them smaller is not tried again
                stars += link(h, v, mask, radius, max_bits, local_rows if len(h) < len(home) else len(h))
            return stars
    points = np.concatenate([home, visit])
    label = np.arange(len(points))
    for i in range(0, len(home), 32):
        rows = home[i:i + 32, None]
        for j in range(i, len(points), 16_384):
            close = np.bitwise_count(rows ^ points[None, j:j + 16_384]) <= max_bits
            if close.sum() <= len(rows):
                # often just each row with itself
                a, b = np.nonzero(close)
                a, b = a + i, b + j
                keep = a < b
                a, b = a[keep], b[keep]
                for x, y in zip(a, b):
                    if label[x] != label[y]:
                        low, high = sorted((label[x], label[y]))
                        label[label == high] = low
                continue
            for k in range(len(rows)):
                near = np.flatnonzero(close[k]) + j
                roots = np.unique(label[np.append(near, i + k)])
                if len(roots) > 1:
                    label[np.isin(label, roots[1:])] = roots[0]
    moved = np.flatnonzero(label != np.arange(len(points)))
    return [(points[moved], points[label[moved]])] if len(moved) else []


def _link_task(masks: list[np.uint64], radius: int, max_bits: int):
    def run(group: pa.Table) -> pa.Table:
        join = lambda name: np.frombuffer(b"".join(group[name].to_pylist()), np.uint64)
        stars = link(join("home"), join("visit"), masks[group["band"][0].as_py()], radius, max_bits)
        pick = lambda k: np.concatenate([s[k] for s in stars] or [np.empty(0, np.uint64)]).view(np.int64)
        return pa.table({"a": pick(0), "b": pick(1)})
    return run


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, bands: int = BANDS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``fp`` within ``max_bits`` of each other."""
    bands = min(bands, max_bits + 1)
    masks, radius = band_masks(bands), max_bits // bands
    n = prints.count()
    order = F.xxhash64("fp")
    # about twice the sample leaves the tasks, whatever their number
    few = prints.select("fp").filter(F.shiftrightunsigned(order, 11) < min(1.0, 2 * SAMPLE / max(n, 1)) * 2.0 ** 53)
    sample = np.array([r.fp for r in few.orderBy(order, "fp").limit(SAMPLE).collect()], np.int64).view(np.uint64)
    shards = max(1, min(n // SHARD_ROWS, SAMPLE // 8))
    trees = [build_tree(sample, m, radius, max_bits, max(1, len(sample) // shards)) for m in masks]
    routed = prints.select("fp").mapInArrow(_route_task(trees), "band int, shard int, home binary, visit binary")
    return (routed.groupBy("band", "shard")
            .applyInArrow(_link_task(masks, radius, max_bits), "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest, fp, keep): ``keep`` is the (none, doc_id, digest) that stands for the component."""
    prints = saved(docs.select(F.col(key).alias("doc_id"), F.xxhash64(F.col(text)).alias("digest"),
                               F.col(text).alias("text"))
                   .mapInArrow(_fingerprints(shingle), "doc_id long, digest long, fp long"))
    named = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    distinct = saved(prints.groupBy("fp").agg(F.min(named).alias("first")))
    roots = component_roots(near_links(distinct, max_bits))
    member = roots.union(roots.select("b", "b").distinct()).toDF("fp", "root")
    led = member.join(distinct, "fp")
    lead = led.groupBy("root").agg(F.min("first").alias("lead"))
    linked = member.join(lead, "root").select("fp", "lead")
    keep = saved(distinct.join(linked, "fp", "left").select("fp", F.coalesce("lead", "first").alias("keep")))
    return prints.join(keep, "fp")


def simhash_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("keep.doc_id").alias("component_id"))


def deduplicated(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of every component, columns of ``docs``: smallest doc_id, of equal ids the smallest text hash."""
    found = near_duplicates(docs, shingle, max_bits)
    kept = (found.filter(F.col("keep.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("keep.digest") == F.col("digest")))
            .groupBy(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).agg(F.count("*").alias("_n")))
    kept = saved(kept)

    def rows(part: DataFrame) -> DataFrame:
        return docs.join(part, F.col("doc_id").eqNullSafe(F.col("_id"))
                         & (F.xxhash64("text") == F.col("_digest")))

    single = rows(kept.filter("_n = 1"))
    repeated = rows(kept.filter("_n > 1")).dropDuplicates(["_id", "_digest"])
    return single.unionByName(repeated).select(*docs.columns)
