"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """Nodes of `edges` (`a`, `b`) with the smallest node they can reach as `label`.

    Each round takes the smallest label among neighbours and then follows labels to theirs, so the
    distance to the smallest node shrinks by a factor, also along chains. Loops end when no label
    changes. Everything stays in tables of the shared folder.
    """
    both = materialise(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    state = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label"))
    state = materialise(state, "labels")
    while True:
        near = both.join(state, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = state.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        lower = materialise(lower, "labels")
        onward = lower.select(F.col("node").alias("at"), F.col("low").alias("further"))
        jumped = lower.join(onward, F.col("low") == F.col("at")).select("node", F.col("label").alias("old"), F.least("low", "further").alias("label"))
        state = materialise(jumped, "labels")
        if state.where("old <> label").isEmpty():
            return state.drop("old")
        state = state.drop("old")
