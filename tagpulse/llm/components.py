"""Connected components of a graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagpulse.llm.shared import settle


def components(links: DataFrame) -> DataFrame:
    """Each node of ``links`` (a bigint, b bigint) with the smallest node it is linked to, as
    (node, root). Nulls and loops link nothing.

    Large-star and small-star steps in turn: every node's larger neighbours, then its smaller
    ones, are linked to the smallest it knows, until every link leads to a root. That takes
    about log(nodes) rounds; each round is a partial minimum and an equi-join, which AQE can
    split where a node is hot, and its table is written, so lineage stays short.
    """
    now = settle(_ordered(links), "links")
    while True:
        star = settle(_small_star(_large_star(now)), "links")
        # Done when no node is both below a root and a root of others.
        open_ends = star.select("b").join(star.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        if open_ends.isEmpty():
            break
        now = star
    return star.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))


def _ordered(links: DataFrame) -> DataFrame:
    """Links once each, the smaller node as ``a``."""
    return links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    smallest = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    larger = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    return _ordered(larger.join(smallest, "u").select(F.col("m").alias("a"), F.col("v").alias("b")))


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of these."""
    smallest = links.groupBy("b").agg(F.min("a").alias("m"))
    moved = links.join(smallest, "b").select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b"))
    return _ordered(moved)
