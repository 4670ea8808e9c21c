"""Connected components of an edge table by alternating stars; every round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _mark(edges: DataFrame) -> tuple:
    """A fingerprint of an edge table: its size and the sum of its rows' hashes."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node, root for every node of an edge; root is the smallest node of the component.

    Large star: a node's larger neighbours are linked to its smallest neighbour (itself included). Small star: a node and its
    smaller neighbours are linked to the smallest of them. Alternating both ends, in a number of rounds logarithmic in the nodes,
    in stars around the smallest nodes. Neighbourhoods are reduced to a minimum and joined back, so a hot node's edges may lie in
    any number of tasks; nothing but a count and a checksum of the edges reaches the driver. Self-links and nulls fall out.
    """
    u, v = F.greatest(a, b), F.least(a, b)
    edges = materialize(edges.select(u.alias("u"), v.alias("v")).where("u > v").distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low)
        edges = materialize(small.distinct(), "edges")
        last, mark = mark, _mark(edges)
        if mark == last:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
