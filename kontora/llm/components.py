"""Connected components of an edge table, by least neighbour and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kontora.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``v, comp`` for every end of ``edges(a, b)``; ``comp`` is the least vertex that can be reached.

    Each round takes the least label among a vertex and its neighbours, then the label of that label, so a chain of n
    edges needs about log n rounds. Only the number of changed labels reaches the driver. No edges give no rows.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("v")).agg(F.least(F.col("a"), F.min("b")).alias("comp")), "labels")
    while True:
        seen = both.join(labels.select(F.col("v").alias("b"), "comp"), "b").groupBy(F.col("a").alias("v")).agg(F.min("comp").alias("near"))
        step = stored(labels.join(seen, "v").select("v", F.col("comp").alias("was"), F.least("comp", "near").alias("comp")), "labels")
        jump = step.select(F.col("v").alias("comp"), F.col("comp").alias("next"))
        labels = stored(step.join(jump, "comp").select("v", "was", F.col("next").alias("comp")), "labels")
        if labels.filter("was != comp").isEmpty():
            return labels.select("v", "comp")
        labels = labels.select("v", "comp")
