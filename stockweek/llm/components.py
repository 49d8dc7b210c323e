"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def component_labels(edges: DataFrame, scratch: str) -> DataFrame:
    """``node`` and ``label`` for every end of the ``a``, ``b`` edges (bigint).

    Nodes of a component get the same label, itself a node. Every round moves
    each node to the smallest of itself and its neighbours and keeps the edges
    between different targets, so the graph shrinks until no edge is left. With
    labels in random order that takes about log(nodes) rounds. Minima are
    combined before they are shuffled, so a node with many neighbours costs one
    row per task. Each round is written to ``scratch``, so that no plan grows.
    """
    spark = edges.sparkSession
    spark.createDataFrame([], "a bigint, to bigint").write.parquet(f"{scratch}/step-none")
    steps = [spark.read.parquet(f"{scratch}/step-none")]
    while True:
        at = f"{scratch}/round-{len(steps)}"
        one_way = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        one_way.filter(F.col("a") < F.col("b")).distinct().write.parquet(f"{at}-edges")
        edges = spark.read.parquet(f"{at}-edges")
        if edges.isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("to"))
        lowest.select("a", F.least("a", "to").alias("to")).write.parquet(f"{at}-step")
        step = spark.read.parquet(f"{at}-step")
        steps.append(step)
        moved = edges.join(step.withColumnRenamed("to", "to_a"), "a")
        moved = moved.join(step.select(F.col("a").alias("b"), F.col("to").alias("to_b")), "b")
        edges = moved.select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
    first, *later = steps[1:] or steps
    labels = first.select(F.col("a").alias("node"), F.col("to").alias("label"))
    for step in later:
        step = step.select(F.col("a").alias("label"), "to")
        labels = labels.join(step, "label", "left").select(
            "node", F.coalesce("to", "label").alias("label")
        )
    return labels
