"""Connected components of a table of links, as Spark joins over tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.llm._batches import stored


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over links (a, b), for every id that has a link.

    Each round hooks every id to its smallest neighbour, shortens the resulting trees by pointer doubling, and
    contracts the links to those between trees, until none is left. Every join reads two stored tables, so AQE can
    split the partition of an id with very many links. Nulls and links of an id with itself are ignored.
    """
    edges = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = None
    while not edges.isEmpty():
        trees = stored(edges.groupBy("b").agg(F.min("a").alias("m")))
        while True:
            up = trees.select(F.col("b").alias("m"), F.col("m").alias("above"))
            jumped = stored(trees.join(up, "m", "left").select("b", F.coalesce("above", "m").alias("m"), F.col("above").isNotNull().alias("moved")))
            trees = jumped.select("b", "m")
            if jumped.where("moved").isEmpty():
                break
        if labels is None:
            labels = trees.select(F.col("b").alias("id"), F.col("m").alias("component"))
        else:
            after = trees.select(F.col("b").alias("component"), F.col("m").alias("above"))
            labels = stored(labels.join(after, "component", "left").select("id", F.coalesce("above", "component").alias("component"))
                            .unionByName(trees.select(F.col("b").alias("id"), F.col("m").alias("component"))).distinct())
        on_a = trees.select(F.col("b").alias("a"), F.col("m").alias("ma"))
        on_b = trees.select("b", F.col("m").alias("mb"))
        edges = stored(stored(edges.join(on_a, "a", "left").select(F.coalesce("ma", "a").alias("a"), "b")).join(on_b, "b", "left")
                       .select("a", F.coalesce("mb", "b").alias("b")).where("a <> b")
                       .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    if labels is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = labels.select(F.col("component").alias("id"), "component").distinct()
    return labels.unionByName(roots).distinct()
