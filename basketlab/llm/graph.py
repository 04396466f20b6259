"""Connected components of a link table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlab.llm.common import written


def _roots(up: DataFrame) -> DataFrame:
    """(node, up): every node's topmost node; each round doubles how far up it looks."""
    while True:
        above = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
        step = up.join(above, "up").select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved"))
        step = written(step, "roots")
        up = step.select("node", "up")
        if not step.where("moved").limit(1).count():
            return up


def components(links: DataFrame) -> DataFrame:
    """(node, label): label is the least node of the component. ``links``: (a, b), either order.

    Each round every node hooks to its least neighbour, trees are flattened to
    their roots, and the links are contracted: both ends become roots, links
    within a root go, equal ones merge. So a round works on what is left of the
    graph only, and no node keeps its many links into one component.
    Nodes without links are not listed; a link to itself lists its node.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges, labels = written(both, "links"), None
    while True:
        least = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        up = _roots(written(least.select("node", F.least("node", "m").alias("up")), "hooks"))
        if labels is None:
            labels = up.withColumnRenamed("up", "label")
        else:
            moved = up.select(F.col("node").alias("label"), "up")
            labels = written(labels.join(moved, "label", "left").select("node", F.coalesce("up", "label").alias("label")), "labels")
        ends = edges.where("a < b").join(up.select(F.col("node").alias("a"), F.col("up").alias("p")), "a")
        ends = ends.join(up.select(F.col("node").alias("b"), F.col("up").alias("q")), "b").where("p != q")
        half = ends.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()
        edges = written(half.select(F.inline(F.array(F.struct(F.col("a"), F.col("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))), "links")
        if not edges.limit(1).count():
            return labels
