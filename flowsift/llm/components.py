"""Connected components of an edge table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsift.storage import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, comp`` for every node of the edges ``a, b``; ``comp`` is one of its nodes.

    In each round every vertex joins the neighbour, or itself, with the smallest hash;
    edges are renamed to the new vertices, loops and repeated edges go. Hashes make the
    rounds few even for long chains of versions. Each round is written to the shared
    folder, so nothing is recomputed after a loss and the lineage stays short. The
    driver only learns whether edges remain.
    """
    edges = materialize(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("comp", F.col("node"))
    while not edges.isEmpty():
        ends = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        least = ends.groupBy("a").agg(F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("id"))).alias("m"))
        own = F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("id"))
        step = materialize(least.select(F.col("a").alias("old"), F.least(own, F.col("m"))["id"].alias("new")), "step")
        labels = labels.join(step, F.col("comp") == F.col("old"), "left")
        labels = materialize(labels.select("node", F.coalesce("new", "comp").alias("comp")), "labels")
        left, right = step.toDF("a", "na"), step.toDF("b", "nb")
        edges = edges.join(left, "a").join(right, "b").where("na <> nb")
        edges = edges.select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")).distinct()
        edges = materialize(edges, "edges")
    return labels
