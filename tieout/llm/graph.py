"""Connected components by contraction, as joins of narrow tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for the nodes of ``links`` (a, b): the smallest node that each can reach.

    Each round sends every node to its smallest neighbour, halves the chains that
    this makes, and keeps the links between what remains; a round at least halves
    the nodes of every component. Each round is a written table. A node with any
    number of links is reduced before it moves.
    """
    edges = cut_lineage(links.select("a", "b").filter("a <> b").distinct())
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("comp"))
        to = cut_lineage(to)
        for _ in range(2):
            further = to.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
            to = to.join(further, "comp").select("node", F.col("next").alias("comp"))
        to = cut_lineage(to)
        if labels is None:
            labels = to
        else:
            step = to.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
            labels = cut_lineage(labels.join(step, "comp", "left").select("node", F.coalesce("next", "comp").alias("comp")))
        a = to.select(F.col("node").alias("a"), F.col("comp").alias("ca"))
        b = to.select(F.col("node").alias("b"), F.col("comp").alias("cb"))
        moved = edges.join(a, "a").join(b, "b").filter("ca <> cb")
        edges = cut_lineage(moved.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct())
    return labels if labels is not None else links.select(F.col("a").alias("node"), F.col("a").alias("comp")).limit(0)
