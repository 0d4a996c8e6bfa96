"""Connected components of an edge table by contraction, without collecting any component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumtide.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge; the root is one of the component's nodes.

    ``edges`` has bigint columns a and b. Every round hangs each node below its smallest
    neighbour, shortens the paths, and keeps the edges between different roots, which at
    least halves the nodes left. Smallest neighbours combine before the shuffle, and the sides
    that are joined are stored, so a node with most of the edges is split over tasks. Runs jobs.
    """
    rest = materialize(
        edges.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
        .where("u < v").distinct(), "edges",
    )
    labels = None
    while not rest.isEmpty():
        ends = rest.select(F.col("u").alias("node"), F.col("v").alias("other")).unionAll(
            rest.select(F.col("v").alias("node"), F.col("u").alias("other"))
        )
        parents = materialize(
            ends.groupBy("node").agg(F.min("other").alias("other"))
            .select("node", F.least("node", "other").alias("up")), "parents",
        )
        for _ in range(2):
            above = parents.select(F.col("node").alias("up"), F.col("up").alias("top"))
            parents = materialize(
                parents.join(above, "up").select("node", F.col("top").alias("up")), "parents"
            )
        if labels is None:
            labels = parents.withColumnRenamed("up", "root")
        else:
            moved = parents.select(F.col("node").alias("root"), "up")
            labels = materialize(
                labels.join(moved, "root", "left")
                .select("node", F.coalesce("up", "root").alias("root")), "labels",
            )
        low = parents.select(F.col("node").alias("u"), F.col("up").alias("lo"))
        high = parents.select(F.col("node").alias("v"), F.col("up").alias("hi"))
        rest = materialize(
            rest.join(low, "u").join(high, "v")
            .select(F.least("lo", "hi").alias("u"), F.greatest("lo", "hi").alias("v"))
            .where("u < v").distinct(), "edges",
        )
    if labels is None:
        return rest.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return labels
