"""Connected components of links between rows, by spreading the smallest label and jumping to labels of labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from moorage.session import materialise


def components(links: DataFrame) -> DataFrame:
    """node and label, the smallest node it reaches, of every node of ``links`` (a, b), which are stored.

    Each round is stored in turn, so lineage stays short. A round halves the way to the smallest node at least.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = both.unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
    labels = materialise(both.groupBy("node").agg(F.least("node", F.min("other")).alias("label")), "labels")
    while True:
        known = labels.select(F.col("node").alias("other"), F.col("label").alias("offered"))
        offers = both.join(known, "other").groupBy("node").agg(F.min("offered").alias("offered"))
        nearer = labels.join(offers, "node").select("node", "label", F.least("label", "offered").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("further"))
        moved = nearer.join(jump, "next").select(
            "node", F.least("next", "further").alias("label"), (F.least("next", "further") < F.col("label")).alias("moved")
        )
        stored = materialise(moved, "labels")
        labels = stored.select("node", "label")
        if stored.where("moved").isEmpty():
            return labels
