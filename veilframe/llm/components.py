"""Connected components of a graph of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm.shared import replaced, stored


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for the nodes of ``links`` (a, b, of one type, not null).

    Alternating stars: every node hangs its larger neighbours, then itself and its smaller
    ones, on the smallest node it sees, until nothing moves.  The rounds grow with the
    logarithm of the nodes; each is written to the shared folder.  Nothing is gathered by
    node: smallest neighbours are partial aggregates, joined back.  A link to itself keeps
    its node; an empty table gives no row.
    """
    links = stored(links.select("a", "b"), "links")  # read three times
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = stored(edges, "links"), None
    while (now := _state(edges)) != before:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")).select("w", F.least("w", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("w")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        joined = large.join(least, F.col("u") == F.col("w"))
        small = joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges, before = replaced(edges, small.union(least.select("w", "m")).distinct(), "links"), now
    stars = edges.select(F.col("u").alias("n"), F.col("v").alias("root"))
    return nodes.join(stars, F.col("node") == F.col("n"), "left").select("node", F.coalesce("root", "node").alias("component"))


def _state(edges: DataFrame) -> tuple:
    """Number of links and a sum over them; equal for two rounds that changed nothing."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
