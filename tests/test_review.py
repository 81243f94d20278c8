"""Numbering, samples, checks and validation against small models."""

import random
from collections import Counter
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from captionloom.functions.similarity import multiset_similarity
from captionloom.operators import alignment as al
from captionloom.operators import audit as au
from captionloom.operators import qc
from captionloom.operators import sampling as sm
from captionloom.operators import segmentation as sg
from captionloom.plans import adapters as ad
from captionloom.streaming import streams
from captionloom.work import Work, numbered

SF = "/root/testdata/sf0.001"


def test_numbered_gives_every_place_once(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 k").repartition(5)
    got = numbered(df, ["k", F.desc("id")], "n", Work(spark, "t")).collect()
    assert [(r.k, r.id) for r in sorted(got, key=lambda r: r.n)] == sorted(((i % 7, i) for i in range(1000)), key=lambda x: (x[0], -x[1]))
    assert sorted(r.n for r in got) == list(range(1000))
    assert numbered(df.where("id < 0"), ["k"], "n", Work(spark, "t")).count() == 0


def naive_spread(sources, count):
    n, chosen = len(sources), []
    for target in [0] if count == 1 else [round(k * (n - 1) / (count - 1)) for k in range(count)]:
        free = sorted((i for i in range(n) if i not in chosen), key=lambda i: (abs(i - target), i))
        chosen.append(next((i for i in free if sources[i] not in {sources[c] for c in chosen}), free[0]))
    return chosen


@pytest.mark.parametrize("sources,count", [(30, 5), (3, 5), (1, 4), (8, 8), (9, 1)])
def test_spread_sample(spark, sources, count):
    rng = random.Random(sources)
    rows = [(f"v{rng.randrange(sources)}", f"c{n:03d}", n, rng.choice([None, 0.5, rng.random()])) for n in range(60)]
    df = spark.createDataFrame(rows, "video_id string, clip_id string, raw_start_ms int, q double")
    known = sorted(r[3] for r in rows if r[3] is not None)
    median = (known[(len(known) - 1) // 2] + known[len(known) // 2]) / 2
    ordered = sorted(rows, key=lambda r: (median if r[3] is None else r[3], r[0], r[2], r[1]))
    got = sm.spread_sample(df, count, "q", Work(spark, "t"), "s").orderBy("sample_order").collect()
    assert [r.clip_id for r in got] == [ordered[i][1] for i in naive_spread([r[0] for r in ordered], count)]
    with pytest.raises(ValueError, match="not enough"):
        sm.spread_sample(df, 61, "q", Work(spark, "t"), "s")


def test_members_are_the_words_of_spans(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 40").write.parquet(f"{tmp_path}/documents.parquet")
    scored = ad.scored(spark, ad.timed(spark, str(tmp_path)))
    spans = sg.clip_spans(scored).collect()
    want = sorted((r.video_id, n, r.clip_no, r.score, r.forced, r.merged) for r in spans for n in range(r.first_no, r.last_no + 1))
    got = sg.clip_members(scored)
    assert sorted((r.video_id, r.word_no, r.clip_no, r.score, r.forced, r.merged) for r in got.collect()) == want
    basis = {(r.video_id, r.word_no): r.boundary_basis for r in scored.collect()}
    own = {(r.video_id, r.clip_no): r.own_basis for r in got.collect()}
    assert own == {(r.video_id, r.clip_no): basis[r.video_id, r.basis_no] for r in spans}


def test_manifest_reads_written_tables(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 40").write.parquet(f"{tmp_path}/documents.parquet")
    plan = ad.manifest(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "InArrow" not in plan and "InPandas" not in plan and "Exchange" not in plan


def test_multiset_similarity(spark):
    rows = [(1, ["a", "a", "b"], ["a", "b", "b"]), (2, [], []), (3, ["x"], []), (4, ["q"], ["q"])]
    df = spark.createDataFrame(rows, "k int, a array<string>, b array<string>")
    got = {r.k: r.s for r in multiset_similarity(df, ["k"], F.col("a"), F.col("b"), "s").collect()}
    assert got == {1: pytest.approx(2 / 3), 2: 1.0, 3: 0.0, 4: 1.0}


def test_overlap_consensus(spark):
    rng = random.Random(2)
    words = [f"w{n}" for n in range(40)]
    said = [" ".join(rng.choices(words, k=60)) for _ in range(6)]
    segments = [("v", n, n * 1000, n * 1000 + 900, said[n]) for n in range(6)]
    events = [("v", n, n * 1000, n * 1000 + 1500, said[n].replace("w1", "other") if n % 2 else said[n].upper()) for n in range(5)]
    s = spark.createDataFrame(segments, "video_id string, segment_id int, start_ms int, end_ms int, text string")
    e = spark.createDataFrame(events, "video_id string, event_index int, event_start int, event_end int, event_text string")
    for r in al.overlap_consensus(s, e).collect():
        mine = segments[r.segment_id]
        text = " ".join(t for _, _, a, b, t in events if b > mine[2] and a < mine[3])
        want = SequenceMatcher(None, mine[4], text.lower()).ratio() if text else 0.0
        assert r.overlap_text == text and r.lexical_similarity == pytest.approx(want)
        assert r.match_band == ("HIGH" if want >= 0.85 else "MID" if want >= 0.65 else "LOW")


def test_token_subsequence_against_all_runs(spark):
    rng = random.Random(3)
    rows = []
    for k in range(30):
        words = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 9))]
        caption = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 14))]
        if k % 3 == 0:
            caption[2:2] = words
        rows.append((k, words, caption))
    df = spark.createDataFrame(rows, "k int, w array<string>, c array<string>")
    found = {r.k: r for r in al.token_subsequence(df, Work(spark, "t"), "k").collect()}
    assert found.keys() == {k for k, _, _ in rows}
    for r in df.collect():
        m, n, best = len(r.w), len(r.c), (-1.0, 0.0, "")
        if m and n:
            for size in range(max(1, m - max(4, m // 4)), min(n, m + max(6, int(m * 0.35))) + 1):
                for at in range(n - size + 1):
                    sim = SequenceMatcher(None, r.w, r.c[at : at + size], autojunk=False).ratio()
                    if sim - 0.03 * abs(size - m) / m > best[0]:
                        best = (sim - 0.03 * abs(size - m) / m, sim, " ".join(r.c[at : at + size]))
        assert found[r.k].similarity == pytest.approx(best[1]) and found[r.k].matched == best[2]


def test_run_bounds_are_multiset_counts(spark):
    rng = random.Random(4)
    rows = [(k, rng.choices("abcde", k=rng.randint(0, 12)), rng.choices("abcdef", k=rng.randint(0, 20))) for k in range(25)]
    got = {(r.k, r.size, r["at"]): r.common for r in al.run_bounds(spark.createDataFrame(rows, "k int, w array<string>, c array<string>"), "k").collect()}
    want = {}
    for k, w, c in rows:
        m, n = len(w), len(c)
        if m and n:
            for size in range(max(1, m - max(4, m // 4)), min(n, m + max(6, int(m * 0.35))) + 1):
                want.update({(k, size, i): sum((Counter(w) & Counter(c[i : i + size])).values()) for i in range(n - size + 1)})
    assert got == want


def test_few_runs_are_matched(spark):
    """On captions of recognised words, bounds leave less than a twentieth of the runs to be matched."""
    from captionloom.functions import text as tx
    from captionloom.plans import adapters as ad
    from captionloom.plans import registry

    sf = ad.timed(spark, "/root/testdata/sf0.001")
    c = ad.caption_windows(registry._clips(spark, sf), ad.captions(spark, sf), 4000)
    work = Work(spark, "t")
    al.token_subsequence(c.select("clip_id", tx.tokens(F.col("text")).alias("w"), tx.tokens(F.coalesce("window_text", F.lit(""))).alias("c")), work).count()
    runs, matched = (spark.read.parquet(f"{work.path}/{n}").count() for n in ("bounds", "rest"))
    assert runs > 100_000 and matched + spark.read.parquet(f"{work.path}/top").count() < runs / 20


def test_item_errors(spark):
    seg = "array<struct<text_exact:string,label:string>>"
    items = spark.createDataFrame([("a", "x y."), ("b", "z"), ("c", "w"), ("d", "v"), ("e", "q r")], "pilot_id string, source_text string")
    rows = [("a", "a", [("x", "KEEP_CANDIDATE"), ("y.", "BROKEN_TEXT")]), ("b", "x", []), ("d", "d", [None, ("", "BAD")]), ("e", None, [("q", "KEEP_CANDIDATE")])]
    results = spark.createDataFrame(rows, f"pilot_id string, result_id string, segments {seg}")
    got = {r.pilot_id: (r.errors, r.feedback) for r in au.validate_items(items, results).collect()}
    assert got["a"] == ("", None)
    assert got["b"][0] == got["c"][0] == "PILOT_ID_MISMATCH;NO_SEGMENTS"
    assert got["d"][0] == "SEGMENT_0_NOT_OBJECT;SEGMENT_1_EMPTY_TEXT;SEGMENT_1_INVALID_LABEL:BAD;TEXT_COVERAGE_MISMATCH"
    assert got["e"] == ("PILOT_ID_MISMATCH;TEXT_COVERAGE_MISMATCH", "Correct these errors: PILOT_ID_MISMATCH, TEXT_COVERAGE_MISMATCH")


def test_structural_qc_counts_each_defect(spark):
    rows = [("a", "a1", "DROP", 0, 9, 0.0, 9.0, "x"), ("a", "a1", "REVIEW", 0, 0, 0.0, 9.0, "x"), ("a", "a2", "ODD", 0, 500, 0.0, 9.0, " "), ("a", "a3", "DROP", 100, 90, 1.0, 9.0, "x"),
            ("x", "x1", "REVIEW", 0, 9, 0.0, 9.0, "x"), ("x", "a1", "DROP", 20, 30, 9.0, 40.0, "x")]
    clips = spark.createDataFrame(rows, "video_id string, clip_id string, decision string, raw_start_ms int, raw_end_ms int, cut_start_ms double, cut_end_ms double, text string")
    sources = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "video_id string")
    (r,) = qc.structural_qc(clips, sources).collect()
    assert (r.rows, r.duplicate_ids, r.unknown_decisions, r.invalid_active, r.invalid_drop, r.empty_text) == (6, 1, 1, 1, 1, 1)
    assert (r.missing_sources, r.extra_sources, r.overlaps, r.severe_overlaps) == (2, 1, 1, 1)
    assert r.errors == "DUPLICATE_IDS;UNKNOWN_DECISIONS;INVALID_ACTIVE;EMPTY_TEXT;MISSING_SOURCES;EXTRA_SOURCES;SEVERE_OVERLAPS" and not r.qc_pass
    (r,) = qc.structural_qc(clips.where("false"), sources.where("false")).collect()
    assert r.qc_pass and r.rows == 0 and r.missing_sources == 0


def test_hours_round_halves_up(spark):
    got = spark.createDataFrame([(58_095.0,), (226_575.0,), (0.5,), (0.0,)], "ms double").select(qc.hours(F.col("ms")).alias("h")).collect()
    assert [r.h for r in got] == [0.016138, 0.062938, 0.0, 0.0]


def test_balanced_fails_closed(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    with pytest.raises(ValueError, match="expected 2 rows"):
        qc.balanced(df, "k", 2, 2)
    assert qc.balanced(df.where("k = 'a'"), "k", 2, 1).count() == 1
    with pytest.raises(ValueError):
        qc.balanced(df.where("false"), "k", 2, 1)


def test_small_helpers(spark):
    df = spark.createDataFrame([("v", 1, None, "GOOD"), ("v", 2, 5, " "), ("w", 3, None, "")], "video_id string, n int, x int, verdict string")
    assert {r.video_id: r.x for r in qc.first_values(df, ["x"], "n").collect()} == {"v": 5, "w": None}
    assert [r.n for r in au.reviewed_only(df).collect()] == [1]
    stamp = au.stamped(df).first().created_at
    assert len(stamp) == 25 and stamp.endswith("+00:00")
    flags = qc.density_flags(df, F.col("n") * 0.0, F.col("n"), F.lit(19), F.col("x")).orderBy("n").collect()
    assert [(r.low_density, r.high_ratio) for r in flags] == [(False, False), (False, True), (False, False)]


def test_islands(spark):
    rows = [("k", 0), ("k", 30), ("k", 200), ("l", 5)]
    df = spark.createDataFrame(rows, "k string, s long").withColumn("t", F.timestamp_seconds("s"))
    got = sorted((r.k, r.events) for r in streams.islands(df, "k", "t").collect())
    assert got == [("k", 1), ("k", 2), ("l", 1)]
