"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.storage import written


def connected(links: DataFrame) -> DataFrame:
    """``id, comp``: the smallest id reachable from each end of links (a, b).

    Each round maps every vertex to the smallest of itself and its neighbours
    and contracts the edges; vertices at least halve, whatever the shape, as
    every vertex with a smaller neighbour disappears. Maps are composed at the
    end of each round, so a label is final when no edge is left. Empty: empty.
    """
    edges = links.select("a", "b").where("a <> b")
    labels = None
    while True:
        edges = written(edges, "edges")
        if edges.isEmpty():
            break
        both = edges.union(edges.select("b", "a"))
        step = written(both.groupBy("a").agg(F.least(F.min("a"), F.min("b")).alias("to")), "step")
        if labels is None:
            labels = step.select(F.col("a").alias("id"), F.col("to").alias("comp"))
        else:
            labels = labels.join(step, labels["comp"] == step["a"], "left").select(
                "id", F.coalesce("to", "comp").alias("comp"))
        labels = written(labels, "labels")
        one = step.select(F.col("a").alias("x"), F.col("to").alias("u"))
        two = step.select(F.col("a").alias("y"), F.col("to").alias("v"))
        edges = (edges.join(one, F.col("a") == F.col("x")).join(two, F.col("b") == F.col("y"))
                 .where("u <> v").select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct())
    if labels is None:
        return links.select(F.col("a").alias("id"), F.col("b").alias("comp")).where("false")
    return labels
