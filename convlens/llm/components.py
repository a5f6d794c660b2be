"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convlens.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest one."""
    both = edges.union(edges.select("v", "u"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang every smaller neighbour of a node, and the node, on the smallest one."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return moved.union(low.select("u", "m")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of each node that is not the smallest of its component.

    `links` has two columns of one orderable type. Rows with equal or null ends
    link nothing; repeated rows count once; no links give an empty table. Each
    round is written to the shared checkpoint folder, so lineage stays short;
    only a count and a checksum reach the driver. A hot node is a hot join key,
    which AQE splits; its minimum is combined before the shuffle.
    """
    a, b = links.columns
    edges = stage(links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v"))
    before = None
    while True:
        sign = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if sign[0] == 0 or sign == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = sign
        edges = stage(_small_star(_large_star(edges)))
