"""Connected components by alternating star contractions, as joins and partial aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfeat.llm.common import stored


def _stars(edges: DataFrame) -> DataFrame:
    """A large and a small star over ``edges`` (a > b): the larger neighbours of each node, then its smaller ones, are tied
    to its smallest neighbour.

    The smallest neighbour is an aggregate and goes back to the edges by a join, so a node with very many neighbours is
    never gathered in one place. Larger neighbours do not lower it, so each edge is read in one direction only.
    """
    least = edges.groupBy(F.col("a").alias("_of")).agg(F.min("b").alias("_m"))
    large = edges.join(least, F.col("b") == F.col("_of"), "left").select("a", F.coalesce("_m", "b").alias("c"))
    least = large.groupBy(F.col("a").alias("_of")).agg(F.min("c").alias("m"))
    tied = large.join(least, F.col("a") == F.col("_of"))
    both = F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("c").alias("a"), F.col("m").alias("b")))
    return tied.select(F.explode(both).alias("_e")).select("_e.a", "_e.b").where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: long), the component being its smallest node.

    Repeated links, links to oneself and links in both directions are allowed; NULL ends are dropped with their link.
    Every step is written to the shared folder. A path of n nodes takes about log(n) steps, stars one.
    """
    edges = links.select("a", "b").where(F.col("a") != F.col("b"))
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    sums = [F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    mark, now = None, edges.agg(*sums).first()
    while now != mark:
        edges = stored(_stars(edges), "components")
        mark, now = now, edges.agg(*sums).first()
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())
