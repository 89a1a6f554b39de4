"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.session import staged


def _linked_to_least(arcs: DataFrame) -> DataFrame:
    """Each arc ``(u, v)`` with ``m``, the least of u and its neighbours.

    The minimum is summed up before the shuffle; a node with very many
    neighbours only meets the join, which Spark splits at run time.
    """
    least = arcs.groupBy("u").agg(F.min("v").alias("least"))
    return arcs.join(least, "u").select("u", "v", F.least("u", "least").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        _linked_to_least(both).where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges run from the larger to the smaller end."""
    near = _linked_to_least(edges)
    pulled = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return pulled.unionByName(near.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    )


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` of every node that has an edge to another one.

    ``edges`` holds two columns of node numbers, in any order and direction;
    loops, repeats and edges with a NULL end are ignored.  The component is
    its least node.  Each round is written to the shared folder, so the
    lineage stays short and a lost executor costs a re-read.
    """
    a, b = (F.col(c) for c in edges.columns[:2])
    current = staged(
        edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    before = _state(current)
    for _ in range(max_rounds):
        if not before[0]:
            break
        current = staged(_small_star(_large_star(current)), "edges")
        now = _state(current)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    own = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own)
