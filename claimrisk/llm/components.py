"""Connected components of a table of links, by contraction."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimrisk.session import store


def connected_components(links: DataFrame) -> DataFrame:
    """``node, label`` for each node of ``links`` (``a, b``): label is the smallest node of its component.

    Each round sends every node to the smallest neighbour of its smallest neighbour and replaces the
    links by links between these, so the table shrinks; a component ends when it is one node. The
    smallest neighbour combines before the shuffle, so a node with very many links is no hot spot.
    """
    edges = store(_distinct(links.select("a", "b")))
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("up"))
        least = store(least)
        moved = store(least.join(
            least.select(F.col("node").alias("up"), F.col("up").alias("label")), "up"
        ).select("node", "label"))
        if labels is None:
            labels = moved
        else:
            labels = store(labels.join(
                moved.select(F.col("node").alias("label"), F.col("label").alias("next")), "label", "left"
            ).select("node", F.coalesce("next", "label").alias("label")))
        to_a = moved.select(F.col("node").alias("a"), F.col("label").alias("new_a"))
        to_b = moved.select(F.col("node").alias("b"), F.col("label").alias("new_b"))
        edges = store(_distinct(edges.join(to_a, "a").join(to_b, "b").select(
            F.col("new_a").alias("a"), F.col("new_b").alias("b"))))
    if labels is None:
        return links.sparkSession.createDataFrame([], "node long, label long")
    return labels


def _distinct(links):
    return links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
