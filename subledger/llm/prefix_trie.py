"""Operator 11: prefix trie of conversations by padded turn-id matrices.

A conversation is the first turns of its group's head conversation, then its own turns
(``rebuilt``). Every distinct sequence of first turns is a node of the trie; each gets
its members, children, leaves, saved tokens (of prefixes that several members share) and
a hash of the conversations that end there.

Turns are known by a 128-bit digest of role and text, so texts are read once and never
shuffled. A conversation is cut into chunks of ``WIDE`` turns (the last one may be
empty); a chunk knows the digest of all chunks before it, so a conversation of any length
is many bounded rows. Chunks are range-sorted by (level, prefix, turns, conversation) and
written; a partition is a shard of the trie. A shard's turns become a padded matrix of
dense ids, sorted by numpy lexsort; the change of each column against the row above,
OR-accumulated from left to right, marks where nodes start, and reduceat over these
starts aggregates all members of a node, depth by depth. Each shard is also told the
rows next to it in the neighbouring shards (two rows a shard), so its marks are exact.

What a deeper chunk adds to its ancestors (leaves, saved tokens) is charged to one
member and handed up by running sums along the conversation. Nodes that reach over a
shard's border are partial: their records, at most two per shard and depth of a chunk, are
summed by node key; the top node of a deeper chunk level meets its parent the same way. The
list of ids of a node's ends may be long; shards hand on pieces of it, and the hash reads
the pieces of a node one after the other in order.

Defined results: rows without a conv_id take no part; turns of equal number are ordered
by their digest; repeated rows are turns of their own; an empty table has no node, not
even the root; c % 5 has the sign of c, as in SQL; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scan import asc, desc, ordered_scan
from .common import importable, saved

GROUP = 5             # conversations c - c % 5 ... share the head of the first
HEADS = 9             # a head has crc32(c) % 9 turns
WIDE = 16             # turns of a chunk
SLICE = 65_536        # turns of one conversation that are joined in one task
LEVELS = 1_024        # chunks of one conversation that one task sums
PIECE = 512           # ids in a piece of a node's ends
DIGEST = 16           # bytes
EMPTY_HASH = hashlib.sha256(b"").hexdigest()


# --- turns and chunks -----------------------------------------------------------------
def head_turns(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % HEADS


def own_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, id, size): every turn's place in its conversation, digest and bytes."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("id"),
        F.octet_length(text).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("row"), F.lit(1).alias("one"))
    order = [asc("turn", nulls_last=False), asc("id"), asc("row")]
    placed = ordered_scan(turns, ["conv_id"], order, True, pos=("cumsum", "one"))
    return placed.select("conv_id", (F.col("pos") - 1).alias("pos"), "id", "size")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, id, size) of the rebuilt conversations; one row with NULL for a conversation without turns."""
    convs = saved(turns.groupBy("conv_id").agg(F.max("pos").alias("last"))
                  .withColumn("h", head_turns(F.col("conv_id")))
                  .withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP))
    lengths = convs.select(F.col("conv_id").alias("base"), (F.col("last") + 1).alias("base_n"))
    convs = saved(convs.join(lengths, "base", "left").select(
        "conv_id", "base", "last", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("head")))
    firsts = turns.filter(F.col("pos") < HEADS - 1).select(F.col("conv_id").alias("base"), "pos", "id", "size")
    head = convs.join(firsts, "base").filter(F.col("pos") < F.col("head")).select("conv_id", "pos", "id", "size")
    # a conversation may hold any share of all turns: it meets its one row slice by slice
    sliced = convs.select("conv_id", "h", "head", F.explode(F.sequence(F.lit(0), F.floor(F.col("last") / SLICE))).alias("s"))
    own = (turns.withColumn("s", F.floor(F.col("pos") / SLICE)).join(sliced, ["conv_id", "s"])
           .filter(F.col("pos") >= F.col("h"))
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "id", "size"))
    none = convs.filter((F.col("head") == 0) & (F.col("last") < F.col("h"))).select(
        "conv_id", F.lit(None).cast("long"), F.lit(None).cast("string"), F.lit(None).cast("long"))
    return head.union(own).union(none)


def chunks(turns: DataFrame) -> DataFrame:
    """(conv_id, level, p1, p2, turns, sizes, above): chunks of ``WIDE`` turns and the digest of all before them.

    ``turns`` are the digests in a row; ``above`` is the size of the turn before the chunk. The
    last chunk of a conversation has less than ``WIDE`` turns, none if the turns are a multiple.
    """
    level, place = F.floor(F.col("pos") / WIDE), F.struct("pos", "id", "size")
    here = F.struct(F.coalesce(level, F.lit(0)).alias("level"), F.when(F.col("pos").isNotNull(), place).alias("t"),
                    F.lit(None).cast("long").alias("above"))
    after = F.struct((level + 1).alias("level"), F.lit(None).cast("struct<pos: long, id: string, size: long>").alias("t"),
                     F.col("size").alias("above"))
    ends_chunk = F.coalesce(F.col("pos") % WIDE == WIDE - 1, F.lit(False))
    rows = turns.select("conv_id", F.explode(F.when(ends_chunk, F.array(here, after)).otherwise(F.array(here))).alias("r"))
    cut = rows.groupBy("conv_id", F.col("r.level").alias("level")).agg(
        F.sort_array(F.collect_list("r.t")).alias("t"), F.coalesce(F.max("r.above"), F.lit(0)).alias("above"))
    cut = cut.select("conv_id", "level", F.array_join("t.id", "").alias("ids"), F.col("t.size").alias("sizes"), "above",
                     F.floor(F.col("level") / LEVELS).alias("b"))
    cut = cut.withColumn("g1", F.xxhash64("level", "ids")).withColumn("g2", F.xxhash64(F.lit(1), "level", "ids"))
    # digest of all chunks before: XOR within a run of levels, then over the runs
    before = Window.partitionBy("conv_id", "b").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    runs = cut.groupBy("conv_id", "b").agg(F.bit_xor("g1").alias("r1"), F.bit_xor("g2").alias("r2"))
    earlier = Window.partitionBy("conv_id").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    carry = runs.select("conv_id", "b", *[F.coalesce(F.bit_xor(f"r{i}").over(earlier), F.lit(0)).alias(f"c{i}") for i in (1, 2)])
    own = cut.select("*", *[F.coalesce(F.bit_xor(f"g{i}").over(before), F.lit(0)).alias(f"l{i}") for i in (1, 2)])
    return own.join(carry, ["conv_id", "b"]).select(
        "conv_id", F.col("level").cast("int").alias("level"), *[F.col(f"l{i}").bitwiseXOR(F.col(f"c{i}")).alias(f"p{i}") for i in (1, 2)],
        *[F.col(f"l{i}").bitwiseXOR(F.col(f"c{i}")).bitwiseXOR(F.col(f"g{i}")).alias(f"q{i}") for i in (1, 2)],
        F.unhex("ids").alias("turns"), "sizes", "above")


# --- one shard --------------------------------------------------------------------------
Edge = tuple  # (level, p1, p2, turns) of the row next to the shard


class Shard:
    """The sorted padded matrix of a shard and where its nodes start.

    Column 0 is the node that all rows of a (level, prefix) share, column j + 1 the one after turn
    j. ``start[i, c]``: row i is the first of its node in column c; ``stop``: it is the last one.
    """

    def __init__(self, table: pa.Table, before: Edge | None, after: Edge | None):
        conv, level = table["conv_id"].to_numpy(), table["level"].to_numpy()
        p1, p2 = table["p1"].to_numpy(), table["p2"].to_numpy()
        raw = table["turns"].to_pylist()
        many = np.fromiter((len(r) // DIGEST for r in raw), np.int64, len(raw))
        at = np.repeat(np.arange(len(raw)), many)
        col = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
        halves = np.frombuffer(b"".join(raw), ">u8").reshape(-1, 2).astype(np.uint64)
        order = np.lexsort((halves[:, 1], halves[:, 0]))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (halves[order][1:] != halves[order][:-1]).any(axis=1)
        ids = np.empty(len(order), np.int32)
        ids[order] = np.cumsum(fresh)                       # dense ids from 1, in the digests' order; 0 pads
        matrix = np.zeros((len(raw), WIDE), np.int32)
        matrix[at, col] = ids
        size = np.zeros((len(raw), WIDE + 1), np.int64)
        size[:, 0] = table["above"].to_numpy()
        size[at, col + 1] = table["sizes"].combine_chunks().flatten().to_numpy(zero_copy_only=False)

        rows = np.lexsort((conv, *matrix.T[::-1], p2, p1, level))
        self.order, self.matrix, self.size, self.many = rows, matrix[rows], size[rows], many[rows]
        self.conv, self.level, self.p1, self.p2 = conv[rows], level[rows], p1[rows], p2[rows]
        self.raw = [raw[i] for i in rows]
        self.q1, self.q2 = table["q1"].to_numpy()[rows], table["q2"].to_numpy()[rows]
        n = len(rows)
        change = np.empty((n, WIDE + 1), bool)
        head = (self.level[1:] != self.level[:-1]) | (self.p1[1:] != self.p1[:-1]) | (self.p2[1:] != self.p2[:-1])
        change[1:, 0] = head
        change[1:, 1:] = self.matrix[1:] != self.matrix[:-1]
        change[0] = self.against(0, before)
        self.start = np.logical_or.accumulate(change, axis=1)
        self.stop = np.empty_like(self.start)
        self.stop[:-1] = self.start[1:]
        self.stop[-1] = np.logical_or.accumulate(self.against(n - 1, after))
        self.there = np.arange(WIDE + 1) <= self.many[:, None]
        self.ends = self.many < WIDE                          # the conversation ends in this chunk
        self.leaf = self.ends & self.stop[np.arange(n), self.many]
        # saved tokens: every member of a node but its first is charged the bytes of the node's last text
        self.charge = self.size[:, :WIDE] * (self.there & ~self.start)[:, :WIDE]

    def against(self, row: int, edge: Edge | None) -> np.ndarray:
        """In which columns a row differs from the row next to the shard."""
        differs = np.ones(WIDE + 1, bool)
        if edge and edge[:3] == (self.level[row], self.p1[row], self.p2[row]):
            a = np.zeros((2, WIDE, DIGEST), np.uint8)
            there = np.zeros((2, WIDE), bool)
            for k, turns in enumerate((self.raw[row], edge[3])):
                m = len(turns) // DIGEST
                a[k, :m] = np.frombuffer(turns, np.uint8).reshape(m, DIGEST)
                there[k, :m] = True
            differs[0] = False
            differs[1:] = (a[0] != a[1]).any(axis=1) | (there[0] != there[1])
        return differs

    def key(self, row: int, col: int) -> bytes:
        """The same for a node wherever it is met; the last column is the next level's column 0."""
        level, p1, p2, turns = self.level[row], self.p1[row], self.p2[row], self.raw[row][:DIGEST * col]
        if col == WIDE:
            level, p1, p2, turns = level + 1, self.q1[row], self.q2[row], b""
        return hashlib.md5(b"%d:%d:%d:" % (level, p1, p2) + turns).digest()


RECORD = [("kind", pa.int8()), ("key", pa.binary()), ("parent_key", pa.binary()), ("conv_id", pa.int64()),
          ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
          ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("shard", pa.int32()),
          ("piece", pa.int32()), ("ids", pa.string())]
RECORD_SCHEMA = ("kind byte, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
                 "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, shard int, piece int, ids string")
WHOLE, PART, CROSSING, LINK, ENDS = range(5)


def node_records(s: Shard, number: int, more_leaves: np.ndarray, more_saved: np.ndarray) -> list[dict]:
    """Records of a shard's nodes: whole ones, parts, links of the next level's top nodes, pieces of ends."""
    n = len(s.conv)
    deeper = np.cumsum(s.charge[:, ::-1], axis=1)[:, ::-1]       # charges of a row from a column on
    leaves = s.leaf + more_leaves
    out: list[dict] = []
    above = None
    for c in range(WIDE + 1):
        first = np.flatnonzero(s.start[:, c])
        first = first if len(first) and first[0] == 0 else np.append(0, first)   # the node of row 0 may go on from before
        last = np.append(first[1:], n) - 1
        crossing = np.zeros(len(first), bool)
        crossing[0] |= not s.start[0, c]
        crossing[-1] |= not s.stop[-1, c]
        least = np.minimum.reduceat(s.conv, first)
        shown = np.flatnonzero(s.there[first, c])
        parent = np.searchsorted(above[0], first, "right") - 1 if above else None
        if c == WIDE:
            out += [{"kind": LINK, "key": s.key(first[i], c),
                     "parent_key": s.key(first[i], c - 1) if above[2][parent[i]] else None,
                     "parent_conv_id": int(above[1][parent[i]])} for i in shown.tolist()]
            break
        members = np.diff(np.append(first, n))
        children = np.add.reduceat((s.start & s.there)[:, c + 1].astype(np.int64), first)
        n_leaves = np.add.reduceat(leaves, first)
        saved_tokens = np.add.reduceat(deeper[:, c] + more_saved, first)
        ended = np.add.reduceat((s.many == c).astype(np.int64), first)
        for i in shown.tolist():
            row, e = int(first[i]), int(ended[i])
            level = int(s.level[row])
            kind = CROSSING if crossing[i] else PART if c == 0 and level else WHOLE
            record = {"kind": kind, "conv_id": int(least[i]), "depth": level * WIDE + c, "n_convs": int(members[i]),
                      "n_children": int(children[i]), "n_leaves": int(n_leaves[i]), "saved_tokens": int(saved_tokens[i])}
            if c:
                record["parent_conv_id"] = int(above[1][parent[i]])
                if above[2][parent[i]]:
                    record["parent_key"] = s.key(row, c - 1)
            if kind != WHOLE:
                record["key"] = s.key(row, c)
            # ends sort before the members that go on
            ids = s.conv[row:row + e]
            if kind != CROSSING:
                record["ends_sha256"] = hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest() if e else EMPTY_HASH
            else:
                out += [{"kind": ENDS, "key": record["key"], "shard": number, "piece": k // PIECE,
                         "ids": ",".join(map(str, ids[k:k + PIECE].tolist()))} for k in range(0, e, PIECE)]
            out.append(record)
        above = (first, least, crossing)
    return out


def _charges(edges: dict[int, tuple]):
    def run(group: pa.Table) -> pa.Table:
        s = Shard(group, *edges[group["shard"][0].as_py()])
        rows = np.flatnonzero((s.level > 0) | ~s.ends)           # conversations of one chunk hand nothing up
        return pa.table({"conv_id": s.conv[rows], "level": s.level[rows].astype(np.int32),
                         "shard": pa.array(np.full(len(rows), group["shard"][0].as_py(), np.int32)),
                         "leaves": s.leaf[rows].astype(np.int64), "saved": s.charge[rows].sum(axis=1), "ends": s.ends[rows]})
    return run


def _nodes(edges: dict[int, tuple]):
    def run(group: pa.Table, deeper: pa.Table) -> pa.Table:
        out: list[dict] = []
        if group.num_rows:
            number = group["shard"][0].as_py()
            s = Shard(group, *edges[number])
            more = np.zeros((2, len(s.conv)), np.int64)
            if deeper.num_rows:
                place = {k: i for i, k in enumerate(zip(s.conv.tolist(), s.level.tolist()))}
                at = [place[k] for k in zip(deeper["conv_id"].to_pylist(), deeper["level"].to_pylist())]
                more[0, at], more[1, at] = deeper["more_leaves"].to_numpy(), deeper["more_saved"].to_numpy()
            out = node_records(s, number, more[0], more[1])
        return pa.table({name: pa.array([r.get(name) for r in out], kind) for name, kind in RECORD})
    return run


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces come sorted by node, shard and place; one hash runs over the pieces of a node."""
    key, hashed = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([hashed.hexdigest()])], ["key", "sha"])
    for batch in batches:
        for k, ids in zip(batch["key"].to_pylist(), batch["ids"].to_pylist()):
            if k != key:
                if key is not None:
                    yield done()
                key, hashed = k, hashlib.sha256(ids.encode())
            else:
                hashed.update(b"," + ids.encode())
    if key is not None:
        yield done()


# --- the trie ---------------------------------------------------------------------------
def _edges(shards: DataFrame) -> dict[int, tuple]:
    """For every shard the last row of the one before and the first row of the one after (two rows a shard)."""
    row = F.struct("level", "p1", "p2", "turns")
    ends = sorted(shards.groupBy("shard").agg(F.min(row).alias("lo"), F.max(row).alias("hi")).collect())
    plain = [(r.shard, *[(e.level, e.p1, e.p2, bytes(e.turns)) for e in (r.lo, r.hi)]) for r in ends]
    return {shard: (plain[i - 1][2] if i else None, plain[i + 1][1] if i + 1 < len(plain) else None)
            for i, (shard, _, _) in enumerate(plain)}


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations (conv_id, turn, role, text)."""
    importable(conversations.sparkSession)
    turns = saved(own_turns(conversations))
    order = ["level", "p1", "p2", "turns", "conv_id"]
    shards = saved(chunks(rebuilt(turns)).repartitionByRange(*order).withColumn("shard", F.spark_partition_id()))
    edges = _edges(shards)
    up = saved(shards.groupBy("shard").applyInArrow(
        _charges(edges), "conv_id long, level int, shard int, leaves long, saved long, ends boolean"))
    below = ordered_scan(up, ["conv_id"], [desc("level")], -F.floor(F.col("level") / LEVELS),
                         all_leaves=("cumsum", "leaves"), all_saved=("cumsum", "saved"))
    below = below.filter(~F.col("ends")).select(
        "shard", "conv_id", "level", (F.col("all_leaves") - F.col("leaves")).alias("more_leaves"),
        (F.col("all_saved") - F.col("saved")).alias("more_saved"))
    records = saved(shards.groupBy("shard").cogroup(below.groupBy("shard")).applyInArrow(_nodes(edges), RECORD_SCHEMA))

    # nodes over a border: at most two per shard and column, so their table may be broadcast
    crossing = saved(records.filter(F.col("kind") == CROSSING).groupBy("key").agg(F.min("conv_id").alias("top")))
    named = (records.filter(F.col("kind") != ENDS).join(
        F.broadcast(crossing.withColumnRenamed("key", "parent_key")), "parent_key", "left")
        .withColumn("parent_conv_id", F.coalesce("top", "parent_conv_id")))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    whole = named.filter(F.col("kind") == WHOLE).select(*columns)
    pieces = records.filter(F.col("kind") == ENDS).select("key", "shard", "piece", "ids")
    hashed = (pieces.repartition("key").sortWithinPartitions("key", "shard", "piece")
              .mapInArrow(_hash_ends, "key binary, sha string"))
    parts = named.filter(F.col("kind") != WHOLE).groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.min("parent_conv_id").alias("parent_conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends_sha256").alias("own"))
    parts = parts.join(hashed, "key", "left").withColumn("ends_sha256", F.coalesce("sha", "own", F.lit(EMPTY_HASH)))
    return whole.unionByName(parts.select(*columns))


#: DuckDB SQL of the query: CRC-32 by its shift register, prefixes as strings of turn digests
ORACLE = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(text, '') AS text, coalesce(role, '') AS role FROM conversations WHERE conv_id IS NOT NULL),
placed AS (
  SELECT conv_id, md5(CAST(length(role) AS VARCHAR) || ':' || role || text) AS id, strlen(text) AS size,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                            md5(CAST(length(role) AS VARCHAR) || ':' || role || text)) - 1 AS pos FROM turns),
own AS (SELECT conv_id, list(struct_pack(id := id, size := size) ORDER BY pos) AS t FROM placed GROUP BY conv_id),
summed AS (
  SELECT conv_id, t, xor(list_reduce([4294967295] || [CAST(ord(x) AS BIGINT) for x in string_split(CAST(conv_id AS VARCHAR), '')],
           lambda crc, b: list_reduce([xor(crc, b)] || range(8),
             lambda c, step: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295) % {HEADS} AS h FROM own),
whole AS (
  SELECT a.conv_id, coalesce(list_slice(b.t, 1, a.h), []) || list_slice(a.t, a.h + 1, len(a.t)) AS t
  FROM summed a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % {GROUP}),
spots AS (SELECT conv_id, len(t) AS n, t, unnest(range(len(t) + 1)) AS depth FROM whole),
keyed AS (SELECT conv_id, n, depth, t[depth].size AS size,
                 md5(array_to_string([x.id for x in list_slice(t, 1, depth)], '')) AS k,
                 md5(array_to_string([x.id for x in list_slice(t, 1, depth - 1)], '')) AS up FROM spots),
node AS (
  SELECT depth, k, min(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, max(n) = depth AS leaf,
         (count(*) - 1) * coalesce(max(size), 0) AS kept,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
  FROM keyed GROUP BY depth, k),
tree AS (SELECT a.depth, a.k, CAST(sum(CAST(d.leaf AS INTEGER)) AS BIGINT) AS n_leaves, CAST(sum(d.kept) AS BIGINT) AS saved_tokens
         FROM node d JOIN keyed a ON a.conv_id = d.conv_id AND a.depth <= d.depth GROUP BY a.depth, a.k),
kids AS (SELECT depth - 1 AS depth, up AS k, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY depth, up)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n_children, 0) AS n_children,
       tree.n_leaves, tree.saved_tokens, n.ends_sha256
FROM node n JOIN tree USING (depth, k) LEFT JOIN kids USING (depth, k)
LEFT JOIN node p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.k = n.up"""
