"""Connected components of an edge table by alternating large and small stars.

Every step is a grouped minimum and an equi-join on the edge table, written to
the shared scratch folder, so that lineage stays short and a lost executor
costs one step. Nothing but a row count and a checksum reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links the neighbours of each node (large: those above it; small: those
    not above it) to the smallest of its neighbours and itself."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    out = both.join(low, "u")
    if large:
        out = out.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = out.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each node reaches. Nodes
    without an edge to another node are left out; an empty edge table gives an
    empty result; repeated edges and loops change nothing."""
    e = materialize(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
                    .where(F.col("u") != F.col("v")).distinct(), "edges")
    mark = None
    while True:
        r = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        now = (r[0], r[1])
        if now == mark or now[0] == 0:
            break
        mark = now
        e = materialize(_star(_star(e, True), False), "edges")
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
