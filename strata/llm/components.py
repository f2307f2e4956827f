"""Connected components of an edge table, without collecting it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Store = Callable[[DataFrame, str], DataFrame]


def _followed(labels: DataFrame, store: Store) -> DataFrame:
    """``node, label`` with every label followed to its end (each round doubles the steps taken)."""
    labels = store(labels, "cc_labels")
    while True:
        up = labels.select(F.col("node").alias("up_node"), F.col("label").alias("up"))
        moved = labels.join(up, F.col("label") == F.col("up_node")).select("node", F.col("up").alias("label"), (F.col("up") != F.col("label")).alias("moved"))
        moved = store(moved, "cc_labels")
        labels = moved.select("node", "label")
        if moved.filter("moved").isEmpty():
            return labels


def connected_components(edges: DataFrame, store: Store) -> DataFrame:
    """``a, b`` edges -> ``node, label``: the least node of each component.

    Every node takes its least neighbour (an aggregate with partial sums in
    each task, so a node with many edges costs no more than its rows), labels
    are followed to their ends, and the edges are contracted to edges between
    different labels.  Each round at least halves what is left, stars take
    one.  Tables are stored after each round, so lost executors repeat one
    round at most.
    """
    both = store(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc_edges")
    labels = None
    while True:
        found = _followed(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), store)
        if labels is None:
            labels = found
        else:
            last = found.select(F.col("node").alias("l_node"), F.col("label").alias("last"))
            labels = store(labels.join(last, F.col("label") == F.col("l_node"), "left").select("node", F.coalesce("last", "label").alias("label")), "cc_labels")
        x = found.select(F.col("node").alias("x_node"), F.col("label").alias("x"))
        y = found.select(F.col("node").alias("y_node"), F.col("label").alias("y"))
        ends = both.join(x, F.col("a") == F.col("x_node")).join(y, F.col("b") == F.col("y_node")).filter("x != y")
        both = store(ends.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "cc_edges")
        if both.isEmpty():
            return labels
