"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradebars.llm._tables import settle


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the label is the least node that the edges (a, b) reach.

    Every round takes the least label among the neighbours and then the label of that label, so that long chains shrink
    by halves. Rounds end when no label changes; each is written to the shared folder.
    """
    size = 2 * edges.count()
    both = settle(edges.select("a", "b").union(edges.select("b", "a")).distinct(), size)
    labels = settle(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), size)
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        step = settle(labels.join(near, labels["node"] == near["a"]).select("node", "label", F.least("label", "near").alias("lower")), size)
        parents = step.select(F.col("node").alias("parent"), F.col("lower").alias("above"))
        jumped = settle(step.join(parents, step["lower"] == parents["parent"]).select("node", "label", F.least("lower", "above").alias("next")), size)
        labels = jumped.select("node", F.col("next").alias("label"))
        if jumped.where("next < label").isEmpty():
            return labels
