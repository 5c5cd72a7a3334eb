"""Connected components of links, as joins and aggregations over a staged edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) -> id, label: the smallest id that each linked id reaches.

    Every round takes the smallest label among the neighbours and then the label of that label, so long chains
    shorten by jumps; it ends with the first round that changes nothing.
    """
    edges = stage(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = stage(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("label")), "labels")
    while True:
        near = edges.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("label").alias("near"))
        better = labels.join(near, F.col("id") == F.col("a")).select("id", F.col("label").alias("was"), F.least("label", "near").alias("to"))
        jump = better.select(F.col("id").alias("to"), F.col("to").alias("jumped"))
        moved = stage(better.join(jump, "to").select("id", "was", F.least("to", "jumped").alias("label")), "labels")
        labels = moved.select("id", "label")
        if moved.where("label <> was").isEmpty():
            return labels
