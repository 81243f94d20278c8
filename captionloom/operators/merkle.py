"""Digests of whole tables as trees over ranges of an integer key, which tell where two tables differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captionloom.work import Work

#: Keys of a leaf, and children of a node.
LEAF_KEYS, FAN = 64, 16


def row_digest(columns: list[Column]) -> Column:
    """md5 of the columns as JSON strings with their places, so that nulls and separators inside values are told apart."""
    return F.md5(F.to_json(F.array(*(F.coalesce(c.cast("string"), F.lit("\u0000")) for c in columns))).cast("binary"))


def leaves(df: DataFrame, key: str, digest: Column, keys: int = LEAF_KEYS) -> DataFrame:
    """node (the range of `keys` keys), rows and digest of each range with rows. The digest of a range is that of the number
    and the sums of its rows' digests, in two parts of 60 bits: it does not depend on any order, and rows are summed up
    before they are shuffled, however many have one key. A null key lies in the range of -1."""
    at = F.floor(F.coalesce(F.col(key), F.lit(-1)) / keys).cast("long")
    part = lambda first: F.sum(F.conv(F.substring("_d", first, 15), 16, 10).cast("decimal(20,0)"))
    sums = df.select(at.alias("node"), digest.alias("_d")).groupBy("node").agg(F.count(F.lit(1)).alias("rows"), part(1).alias("a"), part(16).alias("b"))
    return sums.select("node", "rows", F.md5(F.concat_ws("|", *(F.col(c).cast("string") for c in ("rows", "a", "b"))).cast("binary")).alias("digest"))


def parents(level: DataFrame, fan: int = FAN) -> DataFrame:
    """The level above: digests of the places and digests of up to `fan` children in order."""
    up = F.floor(F.col("node") / fan).cast("long")
    ordered = F.array_sort(F.collect_list(F.struct("node", "digest")))
    child = F.transform(ordered, lambda x: F.concat_ws(":", x["node"].cast("string"), x["digest"]))
    return level.groupBy(up.alias("_up")).agg(F.sum("rows").alias("rows"), F.md5(F.array_join(child, ",").cast("binary")).alias("digest")).withColumnRenamed("_up", "node")


def tree(df: DataFrame, key: str, digest: Column, work: Work, name: str = "tree", keys: int = LEAF_KEYS, fan: int = FAN) -> list[DataFrame]:
    """Levels from the leaves to the root, each written. A root of an even tree is node 0 or -1: keys of both signs have two."""
    out = [work.save(leaves(df, key, digest, keys), f"{name}_0")]
    while out[-1].where("node not in (-1, 0)").limit(1).count():
        out.append(work.save(parents(out[-1], fan), f"{name}_{len(out)}"))
    return out


def root(levels: list[DataFrame]) -> DataFrame:
    """One row: rows, digest (null of an empty table), height."""
    ordered = F.array_sort(F.collect_list(F.struct("node", "digest")))
    return levels[-1].agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.when(F.count(F.lit(1)) > 0, F.md5(F.array_join(F.transform(ordered, lambda x: x["digest"]), ",").cast("binary"))).alias("digest"),
        F.lit(len(levels)).alias("height"),
    )


def difference(a: list[DataFrame], b: list[DataFrame], work: Work, keys: int = LEAF_KEYS, fan: int = FAN) -> DataFrame:
    """first_key, last_key, rows_a, rows_b of the leaves that differ. Trees are compared from the top: a level's nodes are looked at
    only below nodes that differ, so equal parts of the tables cost nothing below their common node. What differs is written
    level by level, as each level is looked up twice in the one above."""
    height = max(len(a), len(b))
    a, b = (levels + _more(levels, height, fan) for levels in (a, b))
    open_ = None
    for k, (x, y) in enumerate(zip(reversed(a), reversed(b), strict=True)):
        if open_ is not None:
            below = lambda level: level.withColumn("_up", F.floor(F.col("node") / fan).cast("long")).join(open_, F.col("_up") == F.col("_open"), "left_semi").drop("_up")  # noqa: B023, E731
            x, y = below(x), below(y)
        both = x.select("node", F.col("rows").alias("rows_a"), F.col("digest").alias("da")).join(y.select("node", F.col("rows").alias("rows_b"), F.col("digest").alias("db")), "node", "full_outer")
        found = work.save(both.where(~F.col("da").eqNullSafe(F.col("db"))), f"differs_{k}")
        open_ = found.select(F.col("node").alias("_open"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return found.select((F.col("node") * keys).alias("first_key"), (F.col("node") * keys + keys - 1).alias("last_key"), zero("rows_a"), zero("rows_b"))


def _more(levels: list[DataFrame], height: int, fan: int) -> list[DataFrame]:
    """Further levels of a tree that is lower than another."""
    out, last = [], levels[-1]
    for _ in range(height - len(levels)):
        last = parents(last, fan)
        out.append(last)
    return out
