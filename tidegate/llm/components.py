"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.shared import written


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of an undirected edge table ``a``, ``b``.

    The root is the smallest node of the component. Each round gives every node the smallest
    of itself and its neighbours, replaces the ends of all edges by that and drops loops; an
    edge table shrinks by at least half its nodes' number in a round, so rounds are few. A
    node with many edges is reduced by partial minima before anything is shuffled.
    """
    edges = written(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    names = written(nodes.withColumn("root", F.col("node")), "names")
    while edges.count():
        both = edges.union(edges.select("b", "a"))
        least = written(
            both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")),
            "least",
        )
        names = written(
            names.join(least, F.col("root") == F.col("a"), "left").select(
                "node", F.coalesce("m", "root").alias("root")
            ),
            "names",
        )
        ends = edges.join(least, "a").select(F.col("m").alias("x"), "b")
        ends = ends.join(least.withColumnRenamed("a", "b"), "b").select(
            F.col("x").alias("a"), F.col("m").alias("b")
        )
        edges = written(
            ends.where(F.col("a") != F.col("b"))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct(),
            "edges",
        )
    return names
