"""Connected components of an undirected graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opticlake.operators.joins import join_per_key
from opticlake.session import materialize

PART_ROWS = 500_000


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows of edges (a, b) to (node, label): the smallest node that each node reaches.

    In each round a node takes the smallest of its label, the labels around it and the label of its label, so paths
    shrink by half. Rounds end when no label changes. Nodes with very many edges are spread: minima are combined before
    the shuffle. Tables are kept in as few parts as their rows need, so a small graph is not shuffled at all.
    """
    pairs = edges.where("a <> b").select("a", "b")
    both = materialize(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    parts = 1 + both.count() // PART_ROWS
    both = both.coalesce(parts)
    first = both.groupBy("a").agg(F.min("b").alias("_m")).select(F.col("a").alias("node"), F.least("a", "_m").alias("label"))
    labels = materialize(first, "labels").coalesce(parts)
    while True:
        around = join_per_key(both, labels.select(F.col("node").alias("b"), "label"), ["b"], "inner")
        onward = labels.select(F.col("node").alias("label"), F.col("label").alias("_next"))
        jumped = join_per_key(labels, onward, ["label"]).select("node", F.col("label").alias("old"), F.least("label", F.coalesce("_next", "label")).alias("_j"))
        near = around.groupBy(F.col("a").alias("node")).agg(F.min("label").alias("_m"))
        moved = jumped.join(near, "node").select("node", "old", F.least("_j", "_m").alias("label"))
        moved = materialize(moved, "labels").coalesce(parts)
        labels = moved.select("node", "label")
        if moved.where("old <> label").isEmpty():
            return labels
