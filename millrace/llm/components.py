"""Connected components by rounds of hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.staging import stored


def _smallest_neighbour(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("w")).unionAll(edges.select("b", "a"))
    return both.groupBy("v").agg(F.least("v", F.min("w")).alias("root"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(v, root) for every vertex of ``edges`` (a, b): vertices share a root if and only if linked.

    Each round every vertex takes its smallest neighbour as parent, parents are followed to the root by pointer
    doubling, and edges are contracted to the roots' edges, so the graph shrinks at least by half. No
    component is gathered in one place: minima are combined before the shuffle, and a vertex with very many edges
    only makes a skewed join, which adaptive execution splits. Null ends and loops are ignored.
    """
    edges = stored(edges.where("a <> b").distinct(), "cc-edges")
    mapping = None
    while not edges.isEmpty():
        parents = stored(_smallest_neighbour(edges), "cc-parents")
        while True:
            up = parents.select(F.col("v").alias("root"), F.col("root").alias("above"))
            parents = stored(
                parents.join(up, "root").select("v", F.col("above").alias("root"), (F.col("above") != F.col("root")).alias("moved")),
                "cc-parents",
            )
            moved = not parents.where("moved").isEmpty()
            parents = parents.select("v", "root")
            if not moved:
                break
        left, right = (parents.select(F.col("v").alias(c), F.col("root").alias(f"r{c}")) for c in "ab")
        edges = stored(
            edges.join(left, "a").join(right, "b").where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
            "cc-edges",
        )
        if mapping is None:
            mapping = parents
        else:
            later = parents.select(F.col("v").alias("root"), F.col("root").alias("later"))
            mapping = stored(
                mapping.join(later, "root", "left").select("v", F.coalesce("later", "root").alias("root")), "cc-map"
            )
    if mapping is None:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("root"))
    return mapping
