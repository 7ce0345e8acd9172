"""Connected components of an edge table, by label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def components(edges: DataFrame) -> DataFrame:
    """``a, b`` (long node ids) -> ``node, comp`` for every node with an edge; ``comp``
    is the smallest node reachable. Each round takes the neighbours' minimum,
    then the label's own label; rounds are staged tables and end when no label
    changes (logarithmic in the longest path, not linear)."""
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "cc-edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("comp")), "cc")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("comp").alias("near")))
        step = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("comp").alias("jump"))
        after = stage(step.join(jump, "low").select("node", F.col("comp").alias("old"),
                                                    F.least("low", "jump").alias("comp")), "cc")
        labels = after.select("node", "comp")
        if after.filter("old <> comp").isEmpty():
            return labels
