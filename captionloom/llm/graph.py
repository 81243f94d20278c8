"""Connected components of large graphs by alternating large-star and small-star steps, with DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Work

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("v", "p"))).first()
    return row[0], row[1] or 0


def components(edges: DataFrame, work: Work, label: str = "cc") -> DataFrame:
    """edges(a long, b long), undirected, neither null -> (node, root) for every node of an edge but the roots.

    root is the smallest node that can be reached. Each step keeps the components and hangs neighbours on
    smaller nodes (Kiveris et al., 2014), until every node hangs on its root; the rounds grow with the logarithm
    of the longest path. Tables of every step are written to the shared folder. Joins read written tables on
    both sides, so that the many edges of a hub are a skewed partition which Spark splits.
    """
    now = edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("p")).where("v <> p").distinct()
    now = work.save(now, f"{label}0")
    state, old = _state(now), f"{label}0"
    for k in range(MAX_ROUNDS):
        if not state[0]:
            break
        both = now.select(F.col("v").alias("u"), F.col("p").alias("w")).unionByName(
            now.select(F.col("p").alias("u"), F.col("v").alias("w"))
        )
        least = work.save(both.groupBy("u").agg(F.least(F.min("w"), F.col("u")).alias("m")), f"{label}_large{k}")
        large = both.where("w > u").join(least, "u").select(F.col("w").alias("v"), F.col("m").alias("p")).distinct()
        large = work.save(large, f"{label}_l{k}")
        least = work.save(large.groupBy("v").agg(F.min("p").alias("m")), f"{label}_small{k}")
        hung = large.join(least, "v").where("p <> m").select(F.col("p").alias("v"), F.col("m").alias("p"))
        now = work.save(hung.unionByName(least.select("v", F.col("m").alias("p"))).distinct(), f"{label}{k + 1}")
        work.drop(old, f"{label}_large{k}", f"{label}_l{k}", f"{label}_small{k}")
        old, before, state = f"{label}{k + 1}", state, _state(now)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return now.select(F.col("v").alias("node"), F.col("p").alias("root"))
