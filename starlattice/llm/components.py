"""Connected components of a graph by joins, with every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlattice.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """The smallest node that each node of the edges (a, b: long) reaches: node, root.

    Alternates two steps until nothing changes: every node links its larger
    neighbours, then its smaller ones, to its smallest neighbour. Edges never grow
    in number, a hot node's edges fold map-side, and rounds grow with the logarithm
    of the graph. Nulls and loops are left out; no edges: no rows.
    """
    links = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    before = None
    while True:
        large = _star(links, larger=True)
        links = stored(_star(large, larger=False), "edges")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Links each node's larger (or its smaller) neighbours to the smallest of the node and its neighbours."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not larger:
        both = both.where("b < a")
    # Stored, so that the join stands alone and skew handling can split the edges of a hot node.
    least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")), "least")
    moved = both.join(least, "a")
    if larger:
        moved = moved.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = moved.select(F.col("b").alias("x"), "a", "least").select(
            F.explode(F.array(F.struct(F.col("x").alias("a"), F.col("least").alias("b")), F.struct("a", F.col("least").alias("b")))).alias("e")
        ).select("e.*")
    return moved.where("a <> b").distinct()
