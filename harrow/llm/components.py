"""Connected components of an edge table, by smallest label and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node of ``edges`` (a, b).

    Every round takes the smallest label among the neighbours, summed up before the
    shuffle, and then the label of the label; each round is a table on disk, so a lost
    executor costs the round at most.  A long chain halves in every round.
    """
    edges = edges.select("a", "b").filter("a <> b")
    both = materialize(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.col("node"), F.min("b")).alias("root")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "root"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near")))
        # A root learns what its followers have heard, then each follower asks its root.
        heard = labels.join(near, "node").withColumn("near", F.least("near", "root"))
        told = (heard.groupBy(F.col("root").alias("node")).agg(F.min("near").alias("told")))
        step = (heard.join(told, "node", "left")
                .select("node", F.col("root").alias("old"),
                        F.least("near", F.coalesce("told", "near")).alias("root")))
        jumped = (step.join(step.select(F.col("node").alias("root"), F.col("root").alias("next")),
                            "root")
                  .select("node", "old", F.least("root", "next").alias("root")))
        done = materialize(jumped, "labels")
        labels = done.select("node", "root")
        if done.filter(F.col("old") != F.col("root")).isEmpty():
            return labels
