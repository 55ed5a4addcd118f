"""Connected components of links, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilspark.llm.common import drop, written


def components(links: DataFrame) -> DataFrame:
    """links: x, y (bigint). Returns node, component (the least node that it reaches), for every node of a link.

    Each round, a node takes the least label among its own and its neighbours', then its label's label, so
    labels run along chains in steps that double. Rounds end when no label changes. Every round's labels are
    written to the shared folder, and those of the round before are removed. Only one number, the count of changes, comes to the driver.
    """
    both = written(links.select("x", "y").union(links.select(F.col("y").alias("x"), F.col("x").alias("y"))).filter("x <> y").distinct(), "links")
    labels = written(both.groupBy(F.col("x").alias("node")).agg(F.least(F.first("x"), F.min("y")).alias("component")), "labels")
    before = labels
    while True:
        near = both.join(labels.select(F.col("node").alias("y"), F.col("component").alias("c")), "y").groupBy(F.col("x").alias("node")).agg(F.min("c").alias("c"))
        taken = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "c").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("component").alias("c"))
        # a label is itself a node, so its own label is in the table
        new = written(taken.join(jump, "mid", "left").select("node", "old", F.least("mid", F.coalesce("c", "mid")).alias("component")), "labels")
        drop(before)
        before, labels = new, new.select("node", "component")
        if new.filter("old <> component").isEmpty():
            drop(both)
            return labels


def extended(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components of found's links and of more links: only the groups that these join take part in new rounds."""
    label = lambda c: F.coalesce(c, F.col("_own"))
    ends = links
    for end in ("x", "y"):
        known = found.select(F.col("node").alias(end), F.col("component").alias("_c"))
        ends = ends.join(known, end, "left").withColumn("_own", F.col(end)).withColumn(f"c{end}", label(F.col("_c"))).drop("_c", "_own")
    joined = components(ends.select(F.col("cx").alias("x"), F.col("cy").alias("y")))
    moved = joined.select(F.col("node").alias("component"), F.col("component").alias("_to"))
    old = found.join(moved, "component", "left").select("node", F.coalesce("_to", "component").alias("component"))
    return written(old.union(joined.join(found, "node", "left_anti").select("node", "component")), "labels")
