"""Operators that replace one task's view of all rows: interval joins, quantiles and digests, against plain models."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from captionloom.operators import dyadic, merkle, quantiles
from captionloom.operators.timeline import interval_join
from captionloom.work import Work

LEFT, RIGHT = "k string, a long, b long, l int", "k string, c long, d long, r int"


def spans(seed, n):
    rng, out = random.Random(seed), []
    for i in range(n):
        at = rng.randint(-50_000, 200_000)
        out.append((rng.choice("xy"), at, at + rng.choice([0, 1, 700, 30_000, 10_000_000 if i % 20 == 0 else 5, -400 if i % 33 == 0 else 2]), i))
    return out


@pytest.mark.parametrize("pad, inclusive, cell", [(0, False, 1000), (3000, True, 1000), (0, False, 7), (250, True, 1 << 24)])
def test_dyadic_join(spark, pad, inclusive, cell):
    left, right = spans(1, 120), spans(2, 150)
    got = dyadic.dyadic_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "k", ("a", "b"), ("c", "d"), pad, inclusive, cell)
    assert got.columns == ["k", "a", "b", "l", "c", "d", "r"]
    rows = sorted((r.l, r.r) for r in got.collect())
    near = lambda a, b, c, d: (d >= a - pad and c <= b + pad) if inclusive else (d > a - pad and c < b + pad)
    # an interval that ends before it starts meets what its start meets, as long as the limits hold
    want = sorted((x[3], y[3]) for x in left for y in right if x[0] == y[0] and near(x[1], x[2], y[1], y[2]) and x[2] >= x[1] and y[2] >= y[1])
    straight = {x[3] for x in left if x[2] >= x[1]}, {y[3] for y in right if y[2] >= y[1]}
    assert [p for p in rows if p[0] in straight[0] and p[1] in straight[1]] == want
    assert len(rows) == len(set(rows))


def test_dyadic_equals_the_grid(spark):
    left, right = spark.createDataFrame(spans(3, 80), LEFT), spark.createDataFrame(spans(4, 80), RIGHT)
    grid = interval_join(left, right, "k", ("a", "b"), ("c", "d"), 50, True)
    tree = dyadic.dyadic_join(left, right, "k", ("a", "b"), ("c", "d"), 50, True)
    assert sorted(map(tuple, tree.collect())) == sorted(map(tuple, grid.collect()))


def test_dyadic_rows_are_bounded(spark):
    """An interval of ten years costs rows for the bits of its length, where the grid would have some ten million."""
    long = spark.createDataFrame([("x", 5_000, 5_000 + 315_360_000_000, 1)], LEFT)
    laid = dyadic.laid(long, "k", F.col("a"), F.col("b"), 1000)
    levels = dyadic.levels_of(laid)
    nodes = laid.select(F.size(dyadic.maximal_nodes(F.col("_low"), F.col("_high"), levels)) + F.size(dyadic.ancestors(F.col("_low"), F.col("_high"), levels))).first()[0]
    assert levels < 40 and nodes <= 4 * levels
    short = spark.range(1000).select(F.lit("x").alias("k"), (F.col("id") * 600_000_000).alias("c"), (F.col("id") * 600_000_000 + 10).alias("d"), F.col("id").cast("int").alias("r"))
    assert dyadic.dyadic_join(long, short, "k", ("a", "b"), ("c", "d")).count() == sum(5_000 < n * 600_000_000 + 10 and n * 600_000_000 < 315_360_005_000 for n in range(1000))
    assert dyadic.dyadic_join(long.limit(0), short, "k", ("a", "b"), ("c", "d")).count() == 0


def test_maximal_nodes_cover(spark):
    rows = [(low, low + length) for low in (-9, -1, 0, 1, 6, 1000) for length in (0, 1, 2, 7, 30, 64)]
    df = spark.createDataFrame(rows, "low long, high long")
    for r in df.select("low", "high", dyadic.maximal_nodes(F.col("low"), F.col("high"), 7).alias("n")).collect():
        cells = []
        for code in r.n:
            level, place = code % dyadic.LEVELS, code // dyadic.LEVELS
            cells += range(place << level, (place + 1) << level)
        assert sorted(cells) == list(range(r.low, r.high + 1))


def test_quantiles(spark):
    rng = np.random.default_rng(4)
    values = np.concatenate([rng.normal(size=3000), np.full(2000, 0.25)])
    df = spark.createDataFrame([(float(v), int(v * 3)) for v in values] + [(None, None)] * 5, "x double, n int").repartition(7)
    shares = [0.0, 0.1, 0.5, 0.77, 0.999, 1.0]
    got = quantiles.exact_quantiles(df, ["x", "n"], shares, Work(spark, "t"))
    assert got["x"] == pytest.approx(np.quantile(values, shares)) and got["n"] == pytest.approx(np.quantile([int(v * 3) for v in values], shares))
    none = quantiles.exact_quantiles(df.limit(0), ["x"], shares, Work(spark, "t"))
    assert none == {"x": [None] * 6}
    assert quantiles.exact_quantiles(df.where("x = 0.25"), ["x"], [0.3], Work(spark, "t")) == {"x": [0.25]}


def test_digests(spark):
    rows = [(k, n, f"v{k}|{n}" if k % 7 else None) for k in range(-300, 3000) for n in range(k % 3)]
    df = spark.createDataFrame(rows + [(None, 1, "x")], "k long, n int, v string")
    digest, work = merkle.row_digest([F.col("k"), F.col("n"), F.col("v")]), Work(spark, "t")
    make = lambda d, name: merkle.tree(d, "k", digest, work, name)
    one, two = make(df, "a"), make(df.repartition(9).orderBy(F.rand(3)), "b")
    assert merkle.root(one).collect() == merkle.root(two).collect()
    assert merkle.difference(one, two, work).count() == 0
    other = df.where("not (k = 130 and n = 0)").withColumn("v", F.when((F.col("k") == 2000) & (F.col("n") == 1), "w").otherwise(F.col("v")))
    three = make(other.unionByName(df.where("k = 7").limit(1)).union(spark.createDataFrame([(90_000, 1, "far")], df.schema)), "c")
    found = {(r.first_key, r.last_key): (r.rows_a, r.rows_b) for r in merkle.difference(one, three, work).collect()}
    assert found.keys() == {(0, 63), (128, 191), (1984, 2047), (90_000 // 64 * 64, 90_000 // 64 * 64 + 63)}
    assert found[128, 191][1] == found[128, 191][0] - 1 and found[0, 63][1] == found[0, 63][0] + 1
    assert merkle.root(make(df.limit(0), "d")).first().digest is None
    # values that only differ in where a column ends
    pair = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "c"), ("", "c")], "x string, y string")
    assert pair.select(merkle.row_digest([F.col("x"), F.col("y")]).alias("d")).distinct().count() == 4
