"""Operators against literal edge cases and small Python models."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from captionloom import params as P
from captionloom.operators import alignment as al
from captionloom.operators import audit as au
from captionloom.operators import captions as cp
from captionloom.operators import sampling as sm
from captionloom.operators import segmentation as sg
from captionloom.operators import timeline as tl
from captionloom.work import Work


def test_percent_rank(spark):
    df = spark.createDataFrame([("a", v) for v in (0, 0, 1, 2, 2, 2, 5)] + [("b", 1)], "k string, v int")
    got = sorted(r.v_percentile for r in tl.percent_rank_average(df, "v", "k").where("k = 'a'").collect())
    assert got == pytest.approx([1.5 / 7, 1.5 / 7, 3 / 7, 5 / 7, 5 / 7, 5 / 7, 1])
    assert tl.percent_rank_average(df, "v", "k").where("k = 'b'").first().v_percentile is None


def test_interval_edges(spark):
    left = spark.createDataFrame([("s", 1, 1000, 2000)], "k string, id int, a int, b int")
    right = spark.createDataFrame([("s", n, c, d) for n, (c, d) in enumerate([(0, 1000), (2000, 3000), (1999, 2001), (0, 90_000)])], "k string, n int, c int, d int")
    strict = tl.interval_join(left, right, "k", ("a", "b"), ("c", "d"))
    assert sorted(r.n for r in strict.collect()) == [2, 3]
    touching = tl.interval_join(left, right, "k", ("a", "b"), ("c", "d"), inclusive=True)
    assert sorted(r.n for r in touching.collect()) == [0, 1, 2, 3]


def test_interval_join_has_no_nested_loop(spark):
    left = spark.range(10).selectExpr("'s' k", "id i", "id * 100 a", "id * 100 + 50 b")
    right = spark.range(10).selectExpr("'s' k", "id n", "id * 90 c", "id * 90 + 70 d")
    df = tl.interval_join(left, right, "k", ("a", "b"), ("c", "d"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    want = sum(1 for i in range(10) for n in range(10) if n * 90 + 70 > i * 100 and n * 90 < i * 100 + 50)
    assert df.count() == want


@pytest.mark.parametrize("middle,bucket", [(29_999, 0), (30_000, 1)])
def test_buckets(spark, middle, bucket):
    assert spark.range(1).select(tl.bucket_of(F.lit(middle), F.lit(middle)).alias("b")).first().b == bucket


def test_fallback_of_a_span():
    points = np.zeros(3, int)
    # no end between 3 and 14 s: the first end past 14 s if it is within 16 s, else the word before it
    assert sg.chain(np.array([0, 2600, 25_500]), np.array([2500, 15_000, 29_000]), points)[0][:2] == (0, 1)
    assert sg.chain(np.array([0, 2600, 17_500]), np.array([2500, 17_000, 18_000]), points)[0][:2] == (0, 0)


@pytest.mark.parametrize("end,merged", [(15_900, True), (16_100, False)])
def test_short_tail(end, merged):
    start, stop = np.array([0, end - 2000]), np.array([8000, end])
    spans = sg.chain(start, stop, np.array([160_000, 0]))
    assert len(spans) == (1 if merged else 2)
    assert spans[0][4] is merged


def naive_chain(start, end, points):
    """The rules word by word."""
    spans, at = [], 0
    while at < len(start):
        options, fallback = [], at
        for i in range(at, len(start)):
            dur = end[i] - start[at]
            if dur <= 16_000:
                fallback = i
            if dur > 14_000:
                break
            if dur >= 3000:
                fit = max(0.0, 2.5 - abs(dur - 8000) / 8000 * 2.5)
                options.append((points[i] / 16_000 + fit + (0.5 if i - at >= 2 else -2), -abs(dur - 8000), -i))
        last = -max(options)[2] if options else fallback
        spans.append((at, last))
        at = last + 1
    if len(spans) > 1 and end[spans[-1][1]] - start[spans[-1][0]] < 3000 and end[spans[-1][1]] - start[spans[-2][0]] <= 16_000:
        spans[-2:] = [(spans[-2][0], spans[-1][1])]
    return spans


def test_chain_against_rules():
    rng = np.random.default_rng(1)
    for _ in range(60):
        n = rng.integers(1, 120)
        dur, gap = rng.integers(200, 6000 if rng.random() < 0.3 else 900, n), rng.choice([0, 50, 400, 700, 5000], n)
        start = np.concatenate([[0], np.cumsum(dur + gap)[:-1]])
        points = rng.choice([0, 12_000, 24_000, 64_000, 80_000], n)
        assert [x[:2] for x in sg.chain(start, start + dur, points)] == naive_chain(start, start + dur, points)


@pytest.mark.parametrize(
    "change,decision",
    [({}, "KEEP_AUTO"), ({"raw_end_ms": 16_000}, "REVIEW"), ({"raw_end_ms": 16_001}, "DROP"), ({"mean_word_probability": 0.7799}, "REVIEW"), ({"word_count": 1}, "DROP"),
     ({"mean_word_probability": None, "word_probability_p10": None}, "KEEP_AUTO"), ({"boundary_basis": "forced_max_or_short_tail"}, "REVIEW"), ({"caption_trusted": False}, "KEEP_WHISPER_PRIMARY")],
)
def test_decisions(spark, change, decision):
    row = {"raw_start_ms": 0, "raw_end_ms": 8000, "word_count": 9, "mean_word_probability": 0.78, "word_probability_p10": 0.45, "median_segment_avg_logprob": -0.9,
           "max_segment_no_speech_prob": 0.35, "boundary_basis": "terminal", "caption_trusted": True, "clip_consensus_mean": 0.55}
    schema = "raw_start_ms int, raw_end_ms int, word_count int, mean_word_probability double, word_probability_p10 double, median_segment_avg_logprob double, max_segment_no_speech_prob double, boundary_basis string, caption_trusted boolean, clip_consensus_mean double"
    df = spark.createDataFrame([tuple((row | change).values())], schema)
    assert df.select(sg.decide()[0].alias("d")).first().d == decision


def test_even_picks(spark):
    df = spark.range(10).selectExpr("'s' as video_id", "id")
    assert sorted(r.id for r in sm.even_picks(df, F.lit(5), ["id"]).collect()) == [0, 2, 4, 7, 9]
    assert sm.even_picks(df, F.lit(20), ["id"]).count() == 10
    assert [r.id for r in sm.even_picks(df, F.lit(1), ["id"]).collect()] == [5]


def test_spread_indices():
    assert sm.spread_indices(list("aabbc"), 3) == [0, 2, 4]
    assert sm.spread_indices(list("aaaab"), 3) == [0, 4, 3]
    with pytest.raises(ValueError):
        sm.spread_indices(["a"], 2)


def test_packs_never_split_items():
    assert cp.pack_numbers([10, 10, 10, 100, 5], P.Budget(20, 30, 30, 0)) == [1, 1, 1, 2, 3]
    assert cp.pack_numbers([19, 19, 19], P.Budget(20, 30, 60, 1)) == [1, 2, 3]
    assert cp.pack_numbers([18, 18, 18, 18], P.Budget(20, 30, 60, 1)) == [1, 1, 2, 2]
    assert cp.pack_numbers([9, 9, 9, 9], P.Budget(100, 100, 30, 1)) == [1, 1, 1, 2]
    assert cp.pack_numbers([], P.REVIEW_PACKS) == []


def test_one_to_one_fails_closed(spark):
    left, right = spark.range(2).withColumnRenamed("id", "k"), spark.createDataFrame([(0, "x"), (0, "y"), (1, "z")], "k long, v string")
    with pytest.raises(Exception, match="one to one"):
        au.one_to_one(left, right, "k").collect()
    with pytest.raises(Exception, match="unmapped"):
        spark.createDataFrame([("q",)], "v string").select(au.mapped(F.col("v"), {"a": "b"})).collect()


def test_validation_errors(spark):
    blocks = spark.createDataFrame([("a", "x y."), ("b", "z"), ("c", "w")], "block_id string, source_text string")
    seg = "array<struct<text_exact:string,label:string>>"
    results = spark.createDataFrame([("a", 1, [("x", "BAD")]), ("b", 1, [("q", "BAD")]), ("b", 2, [("z", "KEEP_CANDIDATE")]), ("d", 1, [])], f"block_id string, result_no int, segments {seg}")
    got = {r.block_id: r.errors for r in au.validate_results(blocks, results).collect()}
    assert got == {"a": "INVALID_LABEL:0:BAD;TEXT_COVERAGE_MISMATCH", "b": "", "c": "MISSING_RESULT_BLOCK", "d": "EXTRA_RESULT_BLOCK"}


def test_alignment(spark):
    clips = spark.createDataFrame([("a", "one two three", "Zero. One two three. Four five"), ("b", "one", "no mark"), ("c", "one", "One two three four five.")], "clip_id string, text string, window_text string")
    got = {r.clip_id: r for r in al.sentence_alignment(clips).collect()}
    assert got["a"].alignment_decision == "ACCEPT_CAPTION" and got["a"].proposal_text == "One two three."
    assert got["b"].alignment_reason == "no_complete_caption_sentence"
    assert got["c"].alignment_reason == "no_length_compatible_complete_sentence_span"
    pair = spark.createDataFrame([("a", ["b", "c"], ["a", "b", "c", "d"]), ("b", [], ["a"])], "clip_id string, w array<string>, c array<string>")
    assert {tuple(r) for r in al.token_subsequence(pair, Work(spark, "t")).collect()} == {("a", 1.0, "b c"), ("b", 0.0, "")}
