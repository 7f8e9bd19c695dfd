"""Connected components of a table of links, by contraction in rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gameflow.llm.store import stored


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (one node of its component) for every node of ``links(a, b)``.

    In each round a node points at its smallest neighbour's smallest neighbour, if smaller than
    itself, and links move to where their ends point; what is left are links between fewer nodes.
    A hub's links are reduced by a minimum, which Spark combines before the shuffle. Each round
    is written to the shared folder, so no lineage grows with the number of rounds.
    """
    spark = links.sparkSession
    edges = stored(spark, links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        near = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("up"))
        near = stored(spark, near, "near")
        # Only nodes that point away from themselves and at one that does so too go on a step.
        far = near.where("node <> up").select(F.col("node").alias("mid"), F.col("up").alias("top"))
        step = near.join(far, near["up"] == far["mid"], "left").select("node", F.coalesce("top", "up").alias("up"))
        step = stored(spark, step.where("node <> up"), "step")
        steps.append(step)

        def moved(frame: DataFrame, column: str, step: DataFrame = step) -> DataFrame:
            to = step.select(F.col("node").alias("__node"), F.col("up").alias("__up"))
            return frame.join(to, frame[column] == to["__node"], "left").withColumn(
                column, F.coalesce("__up", column)
            ).drop("__node", "__up")

        next_edges = moved(moved(edges, "a"), "b").where("a <> b")
        edges = stored(
            spark, next_edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
        )
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct().withColumn("root", F.col("node"))
    for step in steps:
        to = step.select(F.col("node").alias("__node"), F.col("up").alias("__up"))
        nodes = nodes.join(to, nodes["root"] == to["__node"], "left").select("node", F.coalesce("__up", "root").alias("root"))
    return nodes
