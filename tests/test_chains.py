"""Chains by pointer jumping against the walks over whole sources, with blocks much shorter than a source."""

import random

import numpy as np
import pytest

from captionloom.operators import captions as cp
from captionloom.operators import chains as ch
from captionloom.operators import segmentation as sg
from captionloom.params import CLIPS, Budget
from captionloom.work import Work

WORDS = "video_id string, word_no int, start_ms long, end_ms long, boundary_score double"


def words(seed):
    """One source with most of the words, some short ones, and one whose words overlap, so that their ends do not rise."""
    rng, out = random.Random(seed), []
    for source, n in (("a", 900), ("b", 3), ("c", 1), ("d", 60)):
        at = 0
        for k in range(n):
            length = rng.choice([200, 400, 900, 2500]) if source != "d" else rng.choice([100, 9000])
            at += rng.choice([0, 50, 600, 17_000 if k % 97 == 0 else 10]) + (length if source != "d" else 300)
            out.append((source, k, at - length, at, rng.choice([0.0, 1.5, 2.75, 4.0, 9.0])))
    return out


@pytest.mark.parametrize("block, halo", [(64, 4), (16, 40), (4096, 256)])
def test_clips_equal_the_walk(spark, block, halo):
    rows = words(block)
    df = spark.createDataFrame(rows, WORDS).repartition(5)
    got = {}
    for r in ch.clip_spans_linked(df, Work(spark, "t"), block=block, halo=halo).collect():
        got.setdefault(r.video_id, []).append((r.clip_no, r.first_no, r.last_no, r.score, r.forced, r.merged, r.basis_no))
    for source in "abcd":
        own = [r for r in rows if r[0] == source]
        start, end, points = (np.array(x) for x in ([r[2] for r in own], [r[3] for r in own], [int(r[4] * sg.UNIT) for r in own]))
        assert sorted(got[source]) == [(k + 1, *span) for k, span in enumerate(sg.chain(start, end, points, CLIPS))]


@pytest.mark.parametrize("block, halo, cost", [(32, 2, 5), (8, 30, 0), (4096, 256, 1)])
def test_packs_equal_the_walk(spark, block, halo, cost):
    rng, budget = random.Random(cost), Budget(60, 90, 120, cost)
    items = [(s, k, rng.choice([0, 1, 7, 30, 200])) for s, n in (("a", 500), ("b", 2), ("c", 40)) for k in range(n)]
    df = spark.createDataFrame(items, "video_id string, n int, size int").repartition(3)
    got = {(r.video_id, r.n): r.pack_no for r in ch.pack_linked(df, budget, ["n"], "size", Work(spark, "t"), block=block, halo=halo).collect()}
    for source in "abc":
        own = [size for s, _, size in items if s == source]
        assert [got[source, k] for k in range(len(own))] == cp.pack_numbers(own, budget)


def test_a_source_is_spread(spark):
    """The links of one long source come from as many groups as it has blocks."""
    rows = spark.createDataFrame([("a", k, 1) for k in range(4000)], "video_id string, at long, size long")
    work = Work(spark, "t")
    links = ch.linked(rows, "video_id", ch.pack_kernel(Budget(10, 10, 10, 0)), work, block=50, halo=16)
    assert links.select("block").distinct().count() == 80
    packs = ch.visited(links, "video_id", work, 50).orderBy("rank").collect()
    assert [(r.at, r["last"]) for r in packs] == [(k, k + 9) for k in range(0, 4000, 10)]


def test_empty(spark):
    assert ch.pack_linked(spark.createDataFrame([], "video_id string, n int, size int"), Budget(1, 1, 1, 0), ["n"], "size", Work(spark, "t")).count() == 0
    assert ch.clip_spans_linked(spark.createDataFrame([], WORDS), Work(spark, "t")).count() == 0
