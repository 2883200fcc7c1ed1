"""Distributed union-find over an edge table, in DataFrame operations only."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from balances.llm.common import dropped, narrow


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (id, component): every end of an edge with the
    smallest id it can reach. Each round takes the least label among the
    neighbours and then the label of one's label (path halving), so the rounds
    grow with the logarithm of a component's width; every round is written to
    the shared folder, and the loop ends when no label falls."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = narrow(both.where("a <> b").distinct(), "links")
    labels = narrow(both.groupBy("a").agg(F.min("b").alias("m"))
                     .select(F.col("a").alias("id"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy(
            F.col("a").alias("id")).agg(F.min("label").alias("m"))
        step = labels.join(near, "id").select("id", F.least("label", "m").alias("up"),
                                              F.col("label").alias("old"))
        # the label of the label: any label is itself an end of some edge
        above = labels.select(F.col("id").alias("up"), F.col("label").alias("top"))
        new = narrow(step.join(above, "up").select(
            "id", F.least("up", "top").alias("label"), (F.least("up", "top") < F.col("old")).alias("fell")), "labels")
        done = new.where("fell").isEmpty()
        dropped(labels)
        labels = new.select("id", "label")
        labels.scratch_path = new.scratch_path
        if done:
            dropped(both)
            return labels.select("id", F.col("label").alias("component"))
