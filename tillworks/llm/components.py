"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.storage import stored


def _lowest(up: DataFrame) -> DataFrame:
    """``node`` and the ``root`` at the end of its way, where each node's ``root`` is a smaller node or itself. A round
    doubles the steps."""
    while True:
        upper = up.select(F.col("node").alias("root"), F.col("root").alias("up"))
        jumped = stored(up.join(upper, "root").select("node", F.col("root").alias("old"), F.col("up").alias("root")), "roots")
        up = jumped.select("node", "root")
        if jumped.where("old <> root").isEmpty():
            return up


def components(links: DataFrame) -> DataFrame:
    """``node`` and the smallest node of its component (``root``) for links ``a``, ``b`` of longs.

    Each round sends every node to its smallest neighbour, if that is smaller, and on to where the ways end. Links then
    lead between these ends: those within one are gone, the others are told once, so that only the first round meets all
    links. Two rounds at least halve the nodes of each component. Every table is written out, so lineage stays short.
    """
    edges, roots = stored(links.select("a", "b").distinct(), "links"), None
    while True:
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = ends.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root"))
        step = _lowest(stored(step, "roots"))
        if roots is None:
            roots = step
        else:
            then = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
            roots = stored(roots.join(then, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "roots")
        one = step.select(F.col("node").alias("a"), F.col("root").alias("x"))
        two = step.select(F.col("node").alias("b"), F.col("root").alias("y"))
        between = edges.join(one, "a").join(two, "b").where("x <> y")
        edges = stored(between.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        if edges.isEmpty():
            return roots
