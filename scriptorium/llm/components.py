"""Connected components by alternating large-star and small-star steps on DataFrames.

Nothing is gathered on the driver but counts; each round is written to the shared folder, which also cuts the lineage.
Both sides of each join are plain tables, so that adaptive execution can split a node with very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.common import drop_staged, staged

MOST_ROUNDS = 60


def _parents(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rows: int | None = None) -> DataFrame:
    """(node, component) for each node of an edge; the component is its smallest node. Edges are pairs of bigint;
    loops and pairs with a null are left out, repeated pairs count once. rows: about how many there are, if known."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).alias("_a"), F.col(b).alias("_b"))
    e = staged(e.where(F.col("_a").isNotNull() & F.col("_b").isNotNull() & (F.col("u") != F.col("v"))).select("u", "v").distinct(), "edges", rows)
    for _ in range(MOST_ROUNDS):
        rows = e.count()  # none of the tables of a round has more
        p = staged(_parents(e), "parents", rows)
        deep = e.join(p.select(F.col("u").alias("v")), "v", "left_semi").count()
        if not deep and p.count() == rows:
            break
        small = e.join(p, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        e1 = staged(small.unionByName(p.select("u", F.col("m").alias("v"))).distinct(), "edges", rows)
        p1 = staged(_parents(e1).select(F.col("u").alias("v"), "m"), "parents", rows)
        e2 = staged(e1.join(p1, "v", "left").select("u", F.coalesce("m", "v").alias("v")).distinct(), "edges", rows)
        drop_staged(e, p, e1, p1)
        e = e2
    else:
        raise RuntimeError(f"no end after {MOST_ROUNDS} rounds")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    drop_staged(p)
    out = stars.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    out.staged_at = e.staged_at  # what may be deleted when the result has been read
    return out
