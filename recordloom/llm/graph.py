"""Connected components by neighbour minima and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import discard, materialize


def connected_components(edges: DataFrame, *, rounds: int = 60) -> DataFrame:
    """Components of the graph with the edges ``(a, b)``, both of type long.

    Returns ``(node, comp)`` for every node of an edge; ``comp`` is the smallest
    node of its component. Null ends and loops add nothing; no edges give no rows.

    Each round takes every node's smallest neighbouring label (an aggregation with
    map-side partials), gives it also to the node that the old label names, so that
    whole groups move at once, and then follows the label's own label. Chains take
    rounds by the logarithm of their length, in whatever order their nodes lie. All
    joins are on keys, never between the members of a component; a node with very
    many neighbours is a skewed join side that AQE splits. Labels are written to the
    shared folder between the rounds. A graph that has not come to rest after
    ``rounds`` is an error, never a partial answer.
    """
    e = edges.where("a is not null and b is not null and a <> b").select("a", "b")
    e = materialize(e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialize(e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("comp")), "labels")
    for _ in range(rounds):
        near = e.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        paired = labels.join(near, "node")
        hook = paired.groupBy(F.col("comp").alias("node")).agg(F.min("near").alias("hook"))
        hooked = paired.join(hook, "node", "left").select("node", F.col("comp").alias("was"), F.least("comp", "near", "hook").alias("comp"))
        up = labels.select(F.col("node").alias("comp"), F.col("comp").alias("above"))
        fresh = materialize(hooked.join(up, "comp").select("node", "was", F.least("comp", "above").alias("comp")), "labels")
        moved = fresh.where("comp <> was").limit(1).count()
        discard(labels)
        labels = fresh
        if not moved:
            return labels.select("node", "comp")
    raise RuntimeError(f"components did not settle in {rounds} rounds")
