"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, label) of every id in ``edges`` (a, b); the label is the component's smallest id.

    Each round gives every id the smallest label among itself, its neighbours
    and its label's label, and is written to the shared folder; long chains
    halve with every round.  Ends when a round changes nothing.
    """
    both = stored(
        edges.select(F.col("a").alias("id"), F.col("b").alias("other"))
        .unionByName(edges.select(F.col("b").alias("id"), F.col("a").alias("other")))
        .distinct(),
        f"{name}-edges",
    )
    labels = stored(both.groupBy("id").agg(F.least(F.col("id"), F.min("other")).alias("label")), f"{name}-labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("other"), "label"), "other").select("id", "label")
        jump = labels.join(labels.select(F.col("id").alias("label"), F.col("label").alias("up")), "label").select("id", F.col("up").alias("label"))
        # The old label rides along, so that one pass also tells whether anything changed.
        best = (
            near.unionByName(jump)
            .select("id", "label", F.lit(None).cast("long").alias("old"))
            .unionByName(labels.select("id", "label", F.col("label").alias("old")))
            .groupBy("id")
            .agg(F.min("label").alias("label"), F.max("old").alias("old"))
        )
        step = stored(best, f"{name}-labels")
        labels = step.select("id", "label")
        if step.where(F.col("label") != F.col("old")).isEmpty():
            return labels
