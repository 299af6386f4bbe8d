"""Connected components of a graph given as edges, by contraction; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import dropped, written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of edges (u, v): label is the same within a component only.

    In a round nodes are in a new random order. Each points to the first of its neighbours and itself and then to where that points, and what points to
    the same node becomes one node. Whatever the nodes' names and the graph's shape, the nodes left are on average a fixed share of those before (a path's fewer
    than half), so rounds are logarithmic. Edges are summed up to distinct pairs after each round; a node with many edges is one side of joins whose other side has one row a key."""
    graph = written(edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u <> v").distinct(), "edges")
    labels, turn = None, 0
    while not graph.isEmpty():
        turn += 1
        place = lambda x: F.struct(F.xxhash64(F.lit(turn), x).alias("k"), F.col(x).alias("node"))  # noqa: B023, E731
        step = graph.groupBy("u").agg(F.min(place("v")).alias("best")).select("u", F.least("best", place("u")).getField("node").alias("p"))
        step = written(step, "step")
        up = step.select(F.col("u").alias("_u"), F.col("p").alias("_p"))
        jump = written(step.join(up, F.col("p") == F.col("_u")).select("u", F.col("_p").alias("p")), "jump")
        other = jump.select(F.col("u").alias("v"), F.col("p").alias("q"))
        smaller = graph.join(jump, "u").join(other, "v").select(F.col("p").alias("u"), F.col("q").alias("v")).where("u <> v").distinct()
        smaller = written(smaller, "edges")
        if labels is None:
            merged = jump.select(F.col("u").alias("node"), F.col("p").alias("label"))
        else:
            merged = labels.join(jump, labels.label == jump.u, "left").select("node", F.coalesce("p", "label").alias("label"))
        merged = written(merged, "labels")
        for old in (graph, step, jump, labels):
            if old is not None:
                dropped(old)
        graph, labels = smaller, merged
    if labels is None:
        return graph.select(F.col("u").alias("node"), F.col("v").alias("label"))
    dropped(graph)
    return labels
