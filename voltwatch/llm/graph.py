"""Connected components of a link table, by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltwatch.llm.common import frozen


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (smallest id reachable) for every id of ``links`` (columns a, b; any order, repeats
    and a = b allowed; a row with a null is ignored; no links: no rows).

    Each round gives an id the least label among its neighbours' and then the label of that label, so labels cross a
    chain in a logarithmic number of rounds. Rounds are checkpointed; nothing but a count comes to the driver.
    """
    pairs = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    edges = frozen(pairs.union(pairs.select("b", "a")).distinct())
    labels = frozen(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("l")).select(F.col("a").alias("id"), F.col("l").alias("component")))
    while True:
        near = edges.join(labels, edges.b == labels.id).groupBy("a").agg(F.min("component").alias("least"))
        met = labels.join(near, labels.id == near.a).select("id", "component", F.least("component", "least").alias("now"))
        jump = labels.select(F.col("id").alias("now"), F.col("component").alias("beyond"))
        new = frozen(met.join(jump, "now").select("id", F.col("component").alias("old"), F.least("now", "beyond").alias("component")))
        labels = new.select("id", "component")
        if new.where("old <> component").limit(1).count() == 0:
            return labels
