"""Connected components of an edge list, by repeated hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.base import stored


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) for every node of ``src``, ``dst`` (both of one integer type).

    Loops and NULL ends say nothing and are left out; no edges give no rows. Each round takes the smallest label
    among the neighbours, then the label of the label; rounds grow with the logarithm of a component's width.
    Both inputs of every join are tables just read, so a hub with many edges is split by adaptive execution.
    """
    one = edges.filter("src <> dst").select("src", "dst")
    both = stored(one.union(one.select("dst", "src")).distinct(), "edges")
    labels = stored(
        both.groupBy(F.col("src").alias("node")).agg(F.least(F.first("src"), F.min("dst")).alias("component")), "labels")
    while True:
        seen = both.join(labels, both.src == labels.node).groupBy(F.col("dst").alias("node")).agg(F.min("component").alias("seen"))
        hooked = stored(labels.join(seen, "node").select("node", "component", F.least("component", "seen").alias("hooked")), "hooked")
        up = hooked.select(F.col("node").alias("parent"), F.col("hooked").alias("root"))
        nxt = stored(hooked.join(up, hooked.hooked == up.parent).select("node", F.least("hooked", "root").alias("to"), "component"), "labels")
        labels = nxt.select("node", F.col("to").alias("component"))
        if nxt.filter("to < component").isEmpty():
            return labels
