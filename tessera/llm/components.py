"""Connected components of a graph of links, by min-label steps with shortcuts, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """links: pairs of node ids. Returns node, component (the smallest node id reachable) for every node on a link.

    Each round every node takes the smallest label among its own and its neighbours' and then its label's label, so a path of
    n nodes takes about log n rounds. Labels are aggregated map-side, so a node with very many links is no hot key. The
    driver sees one number a round.
    """
    both = links.where(F.col(a) != F.col(b)).select(F.explode(F.array(F.struct(F.col(a).alias("x"), F.col(b).alias("y")), F.struct(F.col(b).alias("x"), F.col(a).alias("y")))).alias("e")).select("e.x", "e.y").distinct()
    edges = materialize(both, "links")
    labels = materialize(edges.groupBy("x").agg(F.min("y").alias("y")).select(F.col("x").alias("node"), F.least("x", "y").alias("label")), "labels")
    for _ in range(max_rounds):
        seen = edges.join(labels, edges.y == labels.node).groupBy("x").agg(F.min("label").alias("seen"))
        near = labels.join(seen, labels.node == seen.x, "left").select("node", F.col("label").alias("old"), F.least("label", "seen").alias("label"))
        up = labels.select(F.col("node").alias("up_node"), F.col("label").alias("up_label"))
        # Links also hook the old label's node, so that whole trees move at once.
        hooks = near.groupBy("old").agg(F.min("label").alias("hook")).withColumnRenamed("old", "hook_node")
        moved = near.join(up, near.label == up.up_node, "left").join(hooks, near.node == hooks.hook_node, "left").select("node", "old", F.least("label", F.coalesce("up_label", "label"), F.coalesce("hook", "label")).alias("label"))
        after = materialize(moved, "labels")
        discard(labels)
        labels = after.select("node", "label")
        labels._tessera_path = after._tessera_path
        if after.where("label <> old").isEmpty():
            discard(edges)
            return labels.select("node", F.col("label").alias("component"))
    raise RuntimeError(f"components are not settled after {max_rounds} rounds")
