"""Connected components of pairs, for work that only rows of one component need to do together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eligo.sources.shared import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """(u, p): each node of ``edges`` (a, b: of any type that has an order) with the least node of its component.

    Each round a node's label falls to the least label that its neighbours' labels have, the node that was its label
    falls along, and labels of labels are taken: paths halve, so rounds grow with the logarithm of the longest. A round
    ends in a checkpoint."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    both = checkpointed(both.unionAll(edges.select("b", "a")).distinct())
    labels = checkpointed(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("p")))
    while True:
        up = labels.select(F.col("u").alias("p"), F.col("p").alias("g"))
        tops = labels.join(up, "p").select("u", "p", "g")
        offers = both.join(tops.select(F.col("u").alias("v"), "g"), "v").groupBy("u").agg(F.min("g").alias("o"))
        tops = checkpointed(tops.join(offers, "u"))
        hooks = tops.groupBy(F.col("p").alias("u")).agg(F.min("o").alias("h"))
        fallen = tops.join(hooks, "u", "left").select("u", F.least("g", "o", F.coalesce("h", "o")).alias("p"), F.col("p").alias("was"))
        fallen = checkpointed(fallen)
        labels = fallen.select("u", "p")
        if fallen.filter("p <> was").isEmpty():
            return labels
