"""Connected components of links, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipsieve.llm.stages import write_stage


def connected(links: DataFrame) -> DataFrame:
    """``node, root``: for every node of ``a, b`` links the least node that it is connected with.

    In each round a node takes the least label of its neighbours, then the label of its label; the number of
    rounds grows with the logarithm of the longest path. Every round is written to the shared folder; only
    the number of changed labels comes to the driver. Group minima have map-side partial results, and a label
    with very many nodes is on the side of the join that adaptive execution splits. Null links are dropped;
    no link gives no row.
    """
    links = links.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    both = write_stage(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = write_stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root")))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("least"))
        lower = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("root").alias("old"), F.least("root", "least").alias("root")
        )
        lower = write_stage(lower)
        of_label = lower.select(F.col("node").alias("label"), F.col("root").alias("next"))
        jumped = lower.join(of_label, lower["root"] == of_label["label"]).select("node", "old", F.col("next").alias("root"))
        labels = write_stage(jumped)
        if not labels.where("root <> old").limit(1).count():
            return labels.select("node", "root")
        labels = labels.select("node", "root")
