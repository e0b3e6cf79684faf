"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.llm._shared import stored


def components(links: DataFrame) -> DataFrame:
    """Columns node and component (the smallest node reachable) for all nodes of links (u, v).

    Every round takes the smallest component among a node's neighbours and then that component's own,
    which halves the way to go. Minima are combined before they are shuffled and the joins may be split,
    so a node with very many links is no burden; only a count comes to the driver.
    """
    both = stored(links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    known = stored(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("node"), F.min("v")).alias("component")))
    while True:
        near = (
            both.join(known.select(F.col("node").alias("v"), F.col("component").alias("other")), "v")
            .groupBy(F.col("u").alias("node"))
            .agg(F.min("other").alias("other"))
        )
        lower = known.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "other").alias("component"))
        lower = stored(lower)
        to = lower.select(F.col("node").alias("component"), F.col("component").alias("beyond"))
        jumped = stored(lower.join(to, "component").select("node", "was", F.least("component", "beyond").alias("component")))
        known = jumped.select("node", "component")
        if jumped.where("component <> was").isEmpty():
            return known
