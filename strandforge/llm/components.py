"""Connected components of an edge table, by smallest label."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """node, component: the smallest node reachable over ``edges`` (a, b); nodes without an edge are not listed.

    Every round a node takes the smallest label of its neighbours and itself, then the label of that label; both are joins on
    the label table, written once per round. Labels at least halve the remaining distance, so rounds grow with the logarithm of the widest component.
    """
    both = cut_lineage(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = cut_lineage(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("component")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "component"), "b")
                .groupBy("a").agg(F.min("component").alias("near")).withColumnRenamed("a", "node"))
        step = labels.join(near, "node").select("node", "component", F.least("component", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("far"))
        told = cut_lineage(step.join(jump, "next", "left").select(
            "node", "component", F.least("next", F.coalesce("far", "next")).alias("next")), "labels")
        if not told.filter("component <> next").limit(1).count():
            return labels
        labels = told.select("node", F.col("next").alias("component"))
