"""Connected components of a graph given as edges, each named by its smallest node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_recs.llm.store import materialize

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b: long).

    Each round takes the smallest node that a node or one of its neighbours is
    labelled with, then the label of that label (pointer jumping), and writes
    the labels to the shared folder.  It ends when no label changes.

    Defined results: no edges give no rows; an edge of a node with itself gives
    none (such a node is absent unless it has another edge); an edge with a null
    is left out; repeated and reversed edges count once; further columns are
    ignored.
    """
    both = materialize(edges.select("a", "b").filter("a <> b")
                            .select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
                            .select("e.a", "e.b").distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    for _ in range(MAX_ROUNDS):
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                    .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        step = (labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label")))
        step = materialize(step, "labels")
        jump = step.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        new = materialize(step.join(jump, "label", "left").select("node", "was", F.coalesce("jump", "label").alias("label")), "labels")
        labels = new.select("node", "label")
        if not new.filter("was <> label").limit(1).count():
            return labels.withColumnRenamed("label", "component")
    raise RuntimeError("components: no end after the largest number of rounds")
