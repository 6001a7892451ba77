"""Landed API page documents (JSON text, one page per row) -> edge rows.

A page holds ``data.transactions.edges`` or ``data.app.events.edges``; each
edge is ``{cursor, node}``. Pages whose edge path is missing are kept apart as
a quarantine frame (or raise, when asked), never silently dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S


class PageShapeError(ValueError):
    """A page lacks the expected edge path."""


def _edges_col(api_type: str):
    if api_type == "transactions":
        return F.col("_doc.data.transactions.edges")
    if api_type == "events":
        return F.col("_doc.data.app.events.edges")
    raise ValueError(f"no page layout for feed type {api_type!r}")


def parse_pages(pages: DataFrame, api_type: str, json_col: str = "json") -> DataFrame:
    """Parse page text with the fixed page schema; adds ``_edges`` (NULL when the path is missing)."""
    schema = S.PAGE_SCHEMAS.get(api_type)
    edges = _edges_col(api_type)
    return (pages.withColumn("_doc", F.from_json(F.col(json_col), schema))
            .withColumn("_edges", edges).drop("_doc"))


def read_pages(pages: DataFrame, api_type: str, json_col: str = "json",
               on_missing: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """Explode pages into edges.

    Returns ``(edges, quarantine)``: ``edges`` has ``cursor`` and ``node``;
    ``quarantine`` has the page rows without an edge path. With
    ``on_missing="raise"`` a missing path raises :class:`PageShapeError`
    (this runs one small job: ``limit(1)`` on the quarantine frame).
    """
    parsed = parse_pages(pages, api_type, json_col)
    bad = parsed.where(F.col("_edges").isNull()).drop("_edges")
    if on_missing == "raise" and bad.limit(1).count() > 0:
        raise PageShapeError(f"page without edges for api type {api_type}")
    edges = (parsed.where(F.col("_edges").isNotNull())
             .select(F.explode("_edges").alias("e"))
             .select(F.col("e.cursor").alias("cursor"), F.col("e.node").alias("node")))
    return edges, bad


EDGE_PATHS = {"transactions": "$.data.transactions.edges", "events": "$.data.app.events.edges"}


def _node_schema(api_type: str) -> T.StructType:
    return {"transactions": S.TRANSACTION_NODE, "events": S.EVENT_NODE}[api_type]


def unknown_fields(node: Column, schema: T.StructType, path: str = "$", prefix: str = "") -> Column:
    """Map of the fields of a VARIANT ``node`` that ``schema`` lacks, at any depth of its structs: name path -> JSON."""
    fields = F.try_variant_get(node, path, "map<string, variant>")
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    own = F.map_filter(fields, lambda k, v: ~F.array_contains(known, k))
    own = F.map_from_entries(F.transform(F.map_entries(own), lambda e: F.struct(
        F.concat(F.lit(prefix), e["key"]).alias("key"), F.to_json(e["value"]).alias("value"))))
    nothing = F.create_map().cast("map<string, string>")
    parts = [F.coalesce(own, nothing)]
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            parts.append(unknown_fields(node, f.dataType, f"{path}.{f.name}", f"{prefix}{f.name}."))
    return F.map_concat(*parts) if len(parts) > 1 else parts[0]


def explode_pages(pages: DataFrame, api_type: str, json_col: str = "json", at: Column | None = None,
                  order: Column | None = None, rescue: bool = False) -> DataFrame:
    """One pass over the pages: edge rows (cursor, node), and rows with ``_page`` for pages without an edge path.

    ``_seq`` says in which order rows landed: the fetch time ``at`` (default: now), the page's place
    ``order`` in the fetch (default: its row in the frame), the edge's place in the page. With
    ``rescue`` the fields that the page schema lacks are kept in ``_rescued`` (a JSON object of name
    path and JSON text, NULL if there are none), read from the page as VARIANT.
    """
    at = F.current_timestamp() if at is None else at.cast("timestamp")
    order = F.monotonically_increasing_id() if order is None else order.cast("long")
    parsed = parse_pages(pages.withColumn("_at", at).withColumn("_order", order), api_type, json_col)
    bad = F.when(F.col("_edges").isNull(), F.coalesce(F.col(json_col), F.lit("")))
    extra = [F.try_variant_get(F.try_parse_json(json_col), EDGE_PATHS[api_type], "array<variant>").alias("_variants")]
    rows = parsed.select(bad.alias("_page"), "_at", "_order", F.posexplode_outer("_edges").alias("_edge", "e"),
                         *(extra if rescue else []))
    kept = []
    if rescue:
        rows = rows.withColumn("_more", unknown_fields(F.get("_variants", F.col("_edge")), _node_schema(api_type), "$.node"))
        kept = [F.when(F.size("_more") > 0, F.to_json("_more")).alias("_rescued")]
    seq = F.struct(F.col("_at").alias("at"), F.col("_order").alias("page"), F.col("_edge").alias("edge"))
    return (rows.where(F.col("e").isNotNull() | F.col("_page").isNotNull())
            .select(F.col("e.cursor").alias("cursor"), F.col("e.node").alias("node"), "_page", seq.alias("_seq"), *kept))


def rescued_fields(rows: DataFrame, key: str = "cursor") -> DataFrame:
    """(key, field, value): one row per field that was kept beside the schema, its value as JSON text."""
    fields = F.from_json("_rescued", "map<string, string>")
    return rows.where(F.col("_rescued").isNotNull()).select(key, F.explode(fields).alias("field", "value"))
