"""Connected components of a link table, without driver-side graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import storage


def components(links: DataFrame, folder: str) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), root being the smallest node that it reaches.

    Each round takes the least root among a node and its neighbours, then follows the root's own
    root, so paths halve; it ends when nothing changes. Rounds are tables in shared storage. Repeated
    links count once, a link from a node to itself and one with a null end name no node; no links, no rows."""
    both = storage.staged(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).filter("a <> b").distinct(), f"{folder}/links")
    roots = storage.staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")), f"{folder}/round-0")
    k = 0
    while True:
        k += 1
        near = both.join(roots.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = roots.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("up"))
        jump = roots.select(F.col("node").alias("up"), F.col("root").alias("over"))
        new = storage.staged(step.join(jump, "up", "left").select("node", F.least("up", F.coalesce("over", "up")).alias("root"), "old"), f"{folder}/round-{k}")
        roots = new.select("node", "root")
        if not new.filter("root <> old").limit(1).count():
            return roots
