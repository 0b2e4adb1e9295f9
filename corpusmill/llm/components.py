"""Connected components by label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for the nodes of `edges`; the component is named by its smallest node.

    Each round gives a node the smallest label among its own and its neighbours', then the label of that
    label, which halves long chains. A round's labels are written to the shared folder and read back, so lost
    executors cost no more than a round. It ends when a round changes nothing. A node with many edges is no
    hot key, as labels are combined by minimum before they are shuffled.
    """
    pairs = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    both = materialize(pairs.union(pairs.select("y", "x")).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("x").alias("node")).agg(F.least(F.col("node"), F.min("y")).alias("label")), "labels")
    while True:
        offers = both.join(labels.withColumnRenamed("node", "y"), "y").groupBy(F.col("x").alias("node")).agg(F.min("label").alias("offer"))
        nearer = labels.join(offers, "node", "left").select("node", F.col("label").alias("was"), F.least("label", "offer").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = materialize(nearer.join(jump, "label", "left").select("node", "was", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        labels = moved.select("node", "label")
        if moved.where("label <> was").isEmpty():
            return labels.withColumnRenamed("label", "component")
