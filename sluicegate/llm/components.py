"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.common import landed


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v), each with the least neighbour of its u. The least is an aggregate, reduced in each
    map task, so that a node with very many neighbours costs no task more than its share of edges."""
    least = edges.groupBy(F.col("u").alias("m_u")).agg(F.min("v").alias("m"))
    return edges.join(least, F.col("u") == F.col("m_u"))


def _larger(edges: DataFrame) -> DataFrame:
    """Each node passes its larger neighbours to the least of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    seen = _with_least(both).withColumn("m", F.least("u", "m"))
    return seen.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _smaller(edges: DataFrame) -> DataFrame:
    """Each node passes its smaller neighbours, and itself, to the least of them."""
    seen = _with_least(edges)
    moved = seen.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = seen.where("v = m").select("u", "v")
    return moved.unionByName(own).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b", most: int = 60) -> DataFrame:
    """``node`` and ``component``, its least reachable node, of every node that has a link.

    Large-star and small-star steps in turn until the edges, all stars then, stay as they are; the
    number of rounds grows with the logarithm of the longest path. Nodes may be of any type that sorts. Each
    round is landed in the shared folder; only its edge count and hash reach the driver. Links to itself and
    repeated links change nothing; no links give no rows.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = landed(edges, "components")
    state = _fingerprint(edges)
    for _ in range(most):
        if not state[0]:
            break
        edges = landed(_smaller(_larger(edges)), "components")
        now = _fingerprint(edges)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(centres)
