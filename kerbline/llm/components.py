"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.llm.shared import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b``, both long, no nulls);
    the component is the least node that can be reached.  No edges give no rows.

    In each round every node moves to the least of itself and its neighbours, and the edges move
    along; an edge whose ends meet goes.  The node and its new place were neighbours, so nothing
    gets disconnected, and a star collapses in one round.  Minima combine before the shuffle, and
    no neighbourhood is gathered.
    """
    edges = stored(edges.where("a <> b").distinct(), "edges")
    places = None
    while not edges.isEmpty():
        ends = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        step = stored(step.select("node", F.least("node", "least").alias("to")), "steps")
        if places is None:
            places = step.select("node", F.col("to").alias("component"))
        else:
            moved = step.select(F.col("node").alias("component"), "to")
            places = stored(
                places.join(moved, "component", "left").select(
                    "node", F.coalesce("to", "component").alias("component")
                ),
                "places",
            )
        from_a = step.select(F.col("node").alias("a"), F.col("to").alias("a_to"))
        from_b = step.select(F.col("node").alias("b"), F.col("to").alias("b_to"))
        edges = stored(
            edges.join(from_a, "a")
            .join(from_b, "b")
            .where("a_to <> b_to")
            .select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))
            .distinct(),
            "edges",
        )
    if places is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return places
