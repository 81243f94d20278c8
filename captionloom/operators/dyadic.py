"""Interval joins for intervals of any length: each side is laid on a dyadic tree of time and pairs meet at a node.

An interval is the union of at most two maximal nodes of each level. Two intervals that share a cell have, above the first
cell that they share, one maximal node each, and one of these two is the other's ancestor or the same node. So one side
offers its maximal nodes, the other those and their ancestors, and each pair is found at exactly one node; an interval
of a year costs as many rows as its length has bits, and not one for each cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Milliseconds of a cell, the smallest node.
CELL = 1000
#: A node is its place within its level times this, plus its level.
LEVELS = 64


def node(place: Column, level: Column) -> Column:
    return place * LEVELS + level


def maximal_nodes(low: Column, high: Column, levels: int) -> Column:
    """The largest nodes of levels 0 to `levels` inside the cells low to high, which they cover exactly; levels has to reach
    the length of the longest interval."""

    def of(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        first, end = F.ceil(low / size).cast("long"), F.floor((high + 1) / size).cast("long")
        some, odd = first < end, lambda c: F.pmod(c, F.lit(2)) == 1
        return F.array_compact(F.array(F.when(some & odd(first), node(first, level)), F.when(some & odd(end), node(end - 1, level))))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), of))


def ancestors(low: Column, high: Column, levels: int) -> Column:
    """The nodes above maximal ones, up to `levels`: those that hold an end of the interval and reach beyond it."""

    def of(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        beyond = lambda p: (p * size < low) | ((p + 1) * size - 1 > high)
        a, b = F.floor(low / size).cast("long"), F.floor(high / size).cast("long")
        return F.array_compact(F.array(F.when(beyond(a), node(a, level)), F.when(beyond(b) & (a != b), node(b, level))))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), of))


def laid(rows: DataFrame, key: str, start: Column, end: Column, cell: int) -> DataFrame:
    """key renamed to _key, _low and _high (cells) and the row itself as _row. An interval that ends before it starts has the
    cell of its start."""
    grid = lambda c: F.floor(c / cell).cast("long")
    return rows.select(F.col(key).alias("_key"), grid(start).alias("_low"), F.greatest(grid(start), grid(end)).alias("_high"), F.struct(*rows.columns).alias("_row"))


def levels_of(*sides: DataFrame) -> int:
    """The level whose nodes are longer than the longest interval, and so the highest that is of use."""
    longest = [side.agg(F.max(F.col("_high") - F.col("_low"))).first()[0] for side in sides]
    return max((x + 1).bit_length() for x in (*(x or 0 for x in longest), 0))


def dyadic_join(
    left: DataFrame, right: DataFrame, key: str, left_span: tuple[str, str], right_span: tuple[str, str], pad: int = 0, inclusive: bool = False, cell: int = CELL
) -> DataFrame:
    """interval_join() with a bound for any interval: 4 rows for each bit of the longest one's length. Same columns and rows.

    Nodes of long intervals that many others lie in are skewed keys of plain equi-joins, which adaptive execution splits. Both
    sides are merged: by the size of their files they look small enough to be broadcast, but they are laid out to many rows each,
    which would all pass through the driver."""
    (a, b), (c, d) = left_span, right_span
    lefts = laid(left, key, F.col(a) - pad, F.col(b) + pad, cell)
    rights = laid(right, key, F.col(c), F.col(d), cell)
    levels = levels_of(lefts, rights)
    at = lambda side, nodes, name: side.select(F.col("_key").alias(f"{name}k"), F.col("_low").alias(f"{name}low"), F.col("_row").alias(f"{name}row"), F.explode(nodes).alias(f"{name}node"))
    own, above = maximal_nodes(F.col("_low"), F.col("_high"), levels), ancestors(F.col("_low"), F.col("_high"), levels)
    same = (F.col("lk") == F.col("rk")) & (F.col("lnode") == F.col("rnode"))
    pairs = at(lefts, own, "l").join(at(rights, F.concat(own, above), "r").hint("merge"), same)
    pairs = pairs.unionByName(at(lefts, above, "l").join(at(rights, own, "r").hint("merge"), same))
    level = F.pmod("lnode", F.lit(LEVELS)).cast("int")
    first = F.greatest("llow", "rlow")
    # the node that is met at holds the first shared cell
    once = pairs.where(F.call_function("shiftright", first, level) == F.floor((F.col("lnode") - level) / LEVELS))
    near = (F.col(d) >= F.col(a) - pad) & (F.col(c) <= F.col(b) + pad) if inclusive else (F.col(d) > F.col(a) - pad) & (F.col(c) < F.col(b) + pad)
    return once.select("lrow.*", *(F.col(f"rrow.{x}").alias(x) for x in right.columns if x != key)).where(near)
