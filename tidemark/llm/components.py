"""Connected components of a graph that lies in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of ``links``: the smallest node reachable.

    Each round takes the smallest label among neighbours, then the label's own
    label, so chains shrink by halves; a round is a written table, and only the
    number of changed labels comes to the driver. No links, no rows.
    """
    edges = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    edges = written(edges.union(edges.select("other", "node")).distinct(), "edges")
    labels = written(edges.groupBy("node").agg(F.least("node", F.min("other")).alias("component")), "labels")
    while True:
        heard = edges.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("component").alias("heard"))
        lower = labels.join(heard, "node").select("node", F.col("component").alias("was"), F.least("component", "heard").alias("via"))
        jump = labels.select(F.col("node").alias("via"), F.col("component").alias("next"))
        moved = written(lower.join(jump, "via").select("node", "was", F.least("via", "next").alias("component")), "labels")
        if moved.where(F.col("was") != F.col("component")).limit(1).count() == 0:
            return moved.select("node", "component")
        labels = moved.select("node", "component")
