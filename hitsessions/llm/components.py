"""Connected components of an edge list, on Spark.

Every node takes the smallest label among itself and its neighbours, then
the label of its label, until nothing changes. Labels are pre-aggregated
before each shuffle; each round is a written table, so a lost executor
costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import kept, removed, written


def components(edges: DataFrame) -> DataFrame:
    """node, label (the smallest node of its component), from long pairs a, b; a written table."""
    both = written(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")),
                     "labels")
    while True:
        old = labels
        near = (both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node"))
                .agg(F.min("label").alias("near")))
        # A table, so that the join below has an exchange on both sides: a large component is a skewed key there.
        moved = written(labels.join(near, "node").select("node", "label", F.least("label", "near").alias("to")), "moved")
        up = moved.select(F.col("node").alias("to"), F.col("to").alias("further"))
        new = written(moved.join(up, "to").select("node", F.col("further").alias("label"),
                                                  (F.col("further") != F.col("label")).alias("changed")), "labels")
        removed(moved, old)
        if new.where("changed").isEmpty():
            removed(both)
            return kept(new.drop("changed"), new)
        labels = new
