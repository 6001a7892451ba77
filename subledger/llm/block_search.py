"""Operator 13: exact nearest neighbours by a block matrix join of int8 codes.

Query vectors and candidates are dealt by hash into blocks of ``QUERY_BLOCK`` and
``CANDIDATE_BLOCK`` rows; every pair of blocks is one tile and one group of a
cogrouped join. In a tile the unit vectors are rounded to int8 codes. For unit vectors
a, b with codes' vectors a', b' the error of a'.b' is at most |a - a'| + |a'| |b - b'|,
so the integer product of the codes (exact in float32 for slices of ``SLICE``
dimensions) gives a lower and an upper bound of each cosine. Pairs whose upper bound
reaches the query's k-th best lower bound, or best found so far, survive; their cosine
is computed in double precision from the original vectors and kept in a heap per query.
The heaps of a query's tiles are merged by a heap. Nothing is dropped on an estimate:
the result equals a search over all pairs.

Copies of one vector are one candidate with its k + 1 smallest ids (no more of them can
be among the k nearest of any query, the query itself excepted), and one query whose
result is handed to all of them, so a vector that a third of the rows share makes no
larger tile. The copies' ids are limited before the shuffle; results return to hot
query vectors by a salted join. Tiles hold bounded blocks; their number grows with
queries times candidates, which is the work an exact search has.

Defined results: rows without an id, and vectors that are NULL, empty, zero or hold a
NULL or non-finite component, take no part; vectors of another length are no
candidates; of rows that share an id the one with the smallest vector counts; equal
scores go by the smaller id; a query with fewer candidates than k gets all of them,
without any it gives no row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

NEIGHBOURS = 5
EVERY = 50                # a row is a query if its id is divisible by this
QUERY_BLOCK = 4_096
CANDIDATE_BLOCK = 8_192
STRIP = 2_048             # candidates of a tile that are multiplied at a time
SLICE = 1_024             # 127 * 127 * 1024 < 2**24: sums of so many products are exact in float32
SLACK = 1e-5              # rounding of the bounds themselves
PAIRS = 65_536            # pairs recomputed at a time
SALTS = 16


def usable(vec: Column) -> Column:
    return F.coalesce(F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)) \
        & F.exists(vec, lambda x: x != 0)


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of an array column as doubles, each scaled by a power of two (no component over 1; cosines don't change)."""
    flat = column.combine_chunks()
    rows = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, initial=0))[1][:, None])


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row products, summed in the order of the dimensions, so a pair's value doesn't depend on its tile."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total


class Codes:
    """int8 codes of unit vectors and what bounds their error."""

    def __init__(self, rows: np.ndarray):
        self.norm = np.sqrt(dots(rows, rows))
        unit = rows / self.norm[:, None]
        self.scale = np.abs(unit).max(axis=1) / 127
        self.code = np.rint(unit / self.scale[:, None]).astype(np.int8)
        near = self.code * self.scale[:, None]
        self.error = np.linalg.norm(unit - near, axis=1)
        self.size = np.linalg.norm(near, axis=1)

    def bounds(self, other: Codes, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """(estimate of the cosines, its largest error) against rows ``lo`` to ``hi`` of the other side."""
        product = np.zeros((len(self.code), hi - lo))
        for d in range(0, self.code.shape[1], SLICE):
            product += self.code[:, d:d + SLICE].astype(np.float32) @ other.code[lo:hi, d:d + SLICE].astype(np.float32).T
        product *= self.scale[:, None]
        product *= other.scale[lo:hi]
        return product, self.error[:, None] + self.size[:, None] * other.error[lo:hi] + SLACK


def search_tile(queries: np.ndarray, rows: np.ndarray, first: np.ndarray, k: int,
                strip: int = STRIP) -> list[list[tuple[float, int, int]]]:
    """For every query a heap of its k best (cosine, -first id, row number) among the rows."""
    q, c = Codes(queries), Codes(rows)
    heaps: list[list[tuple[float, int, int]]] = [[] for _ in range(len(queries))]
    best = np.full(len(queries), -np.inf)      # the k-th best exact value so far
    for lo in range(0, len(rows), strip):
        hi = min(lo + strip, len(rows))
        near, off = q.bounds(c, lo, hi)
        least = best
        if hi - lo >= k:
            least = np.maximum(best, np.partition(near - off, hi - lo - k, axis=1)[:, hi - lo - k])
        at, to = np.nonzero(near + off >= least[:, None])
        for i in range(0, len(at), PAIRS):
            x, y = at[i:i + PAIRS], to[i:i + PAIRS] + lo
            score = dots(queries[x], rows[y]) / (q.norm[x] * c.norm[y])
            for who, s, f, row in zip(x.tolist(), score.tolist(), (-first[y]).tolist(), y.tolist()):
                if len(heaps[who]) < k:
                    heapq.heappush(heaps[who], (s, f, row))
                elif heaps[who][0] < (s, f, row):
                    heapq.heapreplace(heaps[who], (s, f, row))
        best = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps])
    return heaps


FOUND = pa.struct([("score", pa.float64()), ("id", pa.int64())])


def _tile(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        h1, h2, found = [], [], []
        if left.num_rows and right.num_rows:
            copies = right["ids"].to_pylist()
            first = np.fromiter((ids[0] for ids in copies), np.int64, len(copies))
            heaps = search_tile(matrix(left["vec"]), matrix(right["vec"]), first, k)
            for a, b, heap in zip(left["h1"].to_pylist(), left["h2"].to_pylist(), heaps):
                ids = [(-s, i) for s, _, row in heap for i in copies[row]]
                h1.append(a)
                h2.append(b)
                found.append([{"score": -s, "id": i} for s, i in heapq.nsmallest(k, ids)])
        return pa.table({"h1": pa.array(h1, pa.int64()), "h2": pa.array(h2, pa.int64()),
                         "found": pa.array(found, pa.list_(FOUND))})
    return run


def _merge(k: int):
    """Tiles of the partition's queries met in a heap of k each (a query lies in one partition)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[tuple[int, int], list[tuple[float, int]]] = {}
        for batch in batches:
            for a, b, found in zip(*(batch[name].to_pylist() for name in ("h1", "h2", "found"))):
                heap = heaps.setdefault((a, b), [])
                for x in found:
                    if len(heap) < k:
                        heapq.heappush(heap, (x["score"], -x["id"]))
                    else:
                        heapq.heappushpop(heap, (x["score"], -x["id"]))
        if heaps:
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in heaps], pa.int64()), pa.array([b for _, b in heaps], pa.int64()),
                 pa.array([[{"score": s, "id": -i} for s, i in sorted(h, reverse=True)] for h in heaps.values()],
                          pa.list_(FOUND))], ["h1", "h2", "found"])
    return run


FOUND_SCHEMA = "h1 long, h2 long, found array<struct<score: double, id: long>>"


def nearest(vectors: DataFrame, is_query: Column, k: int = NEIGHBOURS, key: str = "vec_id", vec: str = "embedding",
            query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """(query_id, rank, id, score): the k nearest other rows of every row that ``is_query`` names (a test of its ``id``)."""
    x = F.transform(F.col(vec).cast("array<double>"), lambda v: v + 0.0)   # no negative zeros
    rows = (vectors.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), x.alias("vec"))
            .filter(usable(F.col("vec"))).groupBy("id").agg(F.min("vec").alias("vec"))
            .withColumn("h1", F.xxhash64("vec")).withColumn("h2", F.xxhash64(F.lit(1), "vec")))
    rows = saved(rows)
    # copies: equal vectors, told by 128 bits of hash; only the k + 1 smallest ids leave a task
    rank = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id"))
    classes = saved(rows.withColumn("n", rank).filter(F.col("n") <= k + 1)
                    .groupBy("h1", "h2").agg(F.min("vec").alias("vec"), F.sort_array(F.collect_list("id")).alias("ids")))
    asked = rows.filter(is_query).select(F.col("id").alias("query_id"), "h1", "h2")
    queries = saved(rows.filter(is_query).groupBy("h1", "h2").agg(F.min("vec").alias("vec")))
    q_blocks = max(1, -(-queries.count() // query_block))
    c_blocks = max(1, -(-classes.count() // candidate_block))
    tile = ["dim", "q", "c"]
    left = (queries.withColumn("dim", F.size("vec")).withColumn("q", F.pmod("h1", F.lit(q_blocks)).cast("int"))
            .withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1)))))
    right = (classes.withColumn("dim", F.size("vec")).withColumn("c", F.pmod("h2", F.lit(c_blocks)).cast("int"))
             .withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))))
    tiles = left.groupBy(*tile).cogroup(right.groupBy(*tile)).applyInArrow(_tile(k + 1), FOUND_SCHEMA)
    found = saved(tiles.repartition("h1", "h2").mapInArrow(_merge(k + 1), FOUND_SCHEMA))
    salted = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    mine = (asked.withColumn("salt", F.pmod(F.xxhash64("query_id"), F.lit(SALTS)).cast("int"))
            .join(salted, ["h1", "h2", "salt"]))
    others = F.slice(F.filter("found", lambda f: f["id"] != F.col("query_id")), 1, k)
    return (mine.select("query_id", F.posexplode(others).alias("at", "f"))
            .select("query_id", (F.col("at") + 1).alias("rank"), F.col("f.id").alias(key), F.col("f.score").alias("score")))


def neighbours(vectors: DataFrame) -> DataFrame:
    """The contract's rows: queries are the rows whose id is divisible by ``EVERY``."""
    return nearest(vectors, F.col("id") % EVERY == 0)


#: DuckDB SQL of the query
ORACLE = f"""
WITH v AS (
  SELECT vec_id, min(e) AS e FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
                                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL)
  WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
  GROUP BY vec_id),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         list_dot_product(q.e, c.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(c.e, c.e))) AS score
  FROM v q, v c WHERE q.vec_id % {EVERY} = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM pairs QUALIFY rank <= {NEIGHBOURS}"""
