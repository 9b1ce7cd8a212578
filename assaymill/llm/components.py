"""Connected components of links, without gathering a component anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); the label is the component's smallest node.

    Each round, a node takes the smallest label among its neighbours, so does the node that
    its old label names, and then every label is replaced by the label of the node it
    names. Rounds grow with the logarithm of the longest chain. Every round is
    written to the shared folder, so no lineage builds up.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .where("a <> b").distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        named = labels.select(F.col("node").alias("b"), F.col("label").alias("theirs"))
        lowest = both.join(named, "b").groupBy(F.col("a").alias("node")).agg(F.min("theirs").alias("theirs"))
        offers = labels.join(lowest, "node").select("node", "label", F.least("label", "theirs").alias("new"))
        offers = offers.select("node", "new").unionByName(
            offers.where("new < label").select(F.col("label").alias("node"), "new"))
        hooked = stored(offers.groupBy("node").agg(F.min("new").alias("label")), "hooked")
        target = hooked.select(F.col("node").alias("label"), F.col("label").alias("to"))
        jumped = stored(hooked.join(target, "label").select("node", F.col("to").alias("label")), "labels")
        old = labels.select("node", F.col("label").alias("old"))
        if jumped.join(old, "node").where("label <> old").isEmpty():
            return jumped
        labels = jumped
