"""Exact quantiles of whole tables by distributed selection: no task holds all values, and no value is sent that is not asked for."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from captionloom.work import ROW_BITS, Work


def ranked_values(df: DataFrame, column: str, ranks: Sequence[int], work: Work) -> dict[int, object]:
    """The values at the given ranks (from 0) of the column's values in order; nulls have none.

    Values are counted first, so a frequent one is one row, and dealt by ranges of their order. The counts of the ranges tell
    which of them has a rank, and only those ranges are looked into.
    """
    counts = df.select(F.col(column).alias("v")).where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    placed = work.save(counts.orderBy("v").withColumn("_id", F.monotonically_increasing_id()), f"values_{column}")
    part = F.shiftright("_id", ROW_BITS)
    before, wanted = 0, {}
    for r in sorted(placed.groupBy(part.alias("part")).agg(F.sum("n").alias("n")).collect()):
        for rank in ranks:
            if before <= rank < before + r.n:
                wanted.setdefault(r.part, []).append((rank, rank - before))
        before += r.n
    found: dict[int, object] = {}
    for p, places in wanted.items():
        low, high = p << ROW_BITS, (p + 1) << ROW_BITS
        upto = F.sum("n").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        own = placed.where((F.col("_id") >= low) & (F.col("_id") < high)).select("v", (upto - F.col("n")).alias("first"), upto.alias("end"))
        hit = own.where(" or ".join(f"(first <= {k} and {k} < end)" for _, k in places)).collect()
        found.update((rank, next(r.v for r in hit if r["first"] <= k < r.end)) for rank, k in places)
    return found


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float], work: Work) -> dict[str, list[float | None]]:
    """By column, its quantiles with linear interpolation between neighbouring values; None without values."""
    sizes = df.agg(*(F.count(c).alias(c) for c in columns)).first()
    out = {}
    for c in columns:
        places = [p * (sizes[c] - 1) for p in shares]
        ranks = sorted({f(x) for x in places for f in (math.floor, math.ceil)}) if sizes[c] else []
        values = ranked_values(df, c, ranks, work) if ranks else {}
        between = lambda x: float(values[math.floor(x)]) + (float(values[math.ceil(x)]) - float(values[math.floor(x)])) * (x - math.floor(x))  # noqa: B023, E731
        out[c] = [between(x) if values else None for x in places]
    return out
