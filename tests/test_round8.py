"""Matching at size: kernels against plain models, and plans without rows for pairs or runs."""

import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from captionloom.functions import similarity as si
from captionloom.operators import alignment as al
from captionloom.operators import timeline as tl
from captionloom.plans import adapters as ad
from captionloom.plans import registry

SF = "/root/testdata/sf0.001"


def three_tasks():
    sf = ad.Timed(SF)
    sf.tasks = 3
    return sf


def physical(df) -> str:
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def plain(a, b) -> float:
    return SequenceMatcher(None, a, b, autojunk=False).ratio() if a or b else 1.0


def test_matching_blocks_are_those_of_the_library():
    rng = random.Random(1)
    for k in range(4000):
        a, b = (rng.choices("abcdefghij"[: 1 + k % 10], k=rng.randint(0, 30)) for _ in range(2))
        if k % 4 == 0:
            b = [t for t in a if rng.random() < 0.9]
        assert si.ratio(a, b) == plain(a, b) and si.ratio("".join(a), "".join(b), autojunk=True) == plain(a, b)
    long = "".join(rng.choices("abcd ", k=260))
    for b in (long, long[:199], long[3:] + "x", long[::-1]):
        assert si.ratio(long, b, autojunk=True) == SequenceMatcher(None, long, b).ratio()


def test_lists_are_the_pairs_of_the_join(spark):
    rng = random.Random(6)
    span = lambda at: (at, at + rng.choice([0, 1, 900, 45_000, -400]))
    some = lambda: [(rng.choice(["x", "y", None]), i, *span(rng.randint(-50_000, 90_000))) for i in range(80)] + [("x", 99, None, None)]
    left, right = spark.createDataFrame(some(), "k string, i int, a long, b long"), spark.createDataFrame(some(), "k string, j int, c long, d long")
    for more in ((0, False), (3000, True), (250, False, 700)):
        pairs = tl.dealt_interval_join(left, right, "k", ("a", "b"), ("c", "d"), *more)
        lists = tl.dealt_interval_lists(left, right, "k", "i", ("a", "b"), ("c", "d"), "near", *more)
        assert lists.columns == [*left.columns, "near"] and lists.count() == left.count()
        assert all(r.near == sorted(r.near) for r in lists.collect())
        again = lists.select("*", F.explode("near").alias("r")).select(*left.columns, "r.j", "r.c", "r.d")
        assert pairs.count() and sorted(map(tuple, again.collect())) == sorted(map(tuple, pairs.collect()))


def test_event_runs_are_no_rows(spark):
    """Of each clip the run that the row-wise operator finds; a clip is a row throughout."""
    rng, pairs = random.Random(2), []
    for clip in range(60):
        own = " ".join(rng.choices("abcde", k=rng.randint(0, 12)))
        last = rng.randint(0, 15)
        for n in range(last + 1):
            pairs.append((f"c{clip}", own, n, n, n, None if rng.random() < 0.1 and n < last else " ".join(rng.choices("abcdef.", k=rng.randint(0, 4)))))
    df = spark.createDataFrame(pairs, "clip_id string, text string, event_start int, event_end int, event_index int, event_text string")
    form = lambda c: al.tx.lexical(F.col(c))
    event = F.struct("event_start", "event_end", "event_index", "event_text", form("event_text").alias("event_form"))
    clips = df.groupBy("clip_id", form("text").alias("form")).agg(F.array_sort(F.collect_list(event)).alias("events"))
    want = sorted(map(tuple, al.event_run_match(df).collect()))
    assert len(want) == 60 and sorted(map(tuple, al.event_run_match_by_clip(clips).collect())) == want
    assert al.event_run_match_by_clip(clips.withColumn("events", F.slice("events", 1, 0))).count() == 0
    plan = physical(registry.event_run_match(spark, three_tasks()))
    assert plan.count("Exchange hashpartitioning") == 2 and "Window" not in plan.split("ArrowEvalPython")[0]


def test_sentence_runs_are_no_rows(spark):
    """The best run by a plain model, from one pass over the words and nothing written."""
    rng, rows = random.Random(3), []
    for k in range(80):
        said = " ".join(rng.choices("abcde", k=rng.randint(0, 25)) + ["x."] * rng.randint(0, 2))
        for mark in (". ", "! ", "… "):
            said = said.replace(rng.choice("abcde") + " ", rng.choice("abcde") + mark)
        rows.append((f"c{k}", " ".join(rng.choices("abcde", k=rng.randint(0, 9))), said if k % 9 else None))
    clips = spark.createDataFrame(rows, "clip_id string, text string, window_text string")
    split = {r.clip_id: r for r in clips.select("clip_id", F.split("text", " ").alias("w"), al.tx.complete_sentences(F.coalesce("window_text", F.lit(""))).alias("s")).collect()}
    found, some = al.sentence_alignment(clips).collect(), 0
    for r in found:
        w, s = [t for t in split[r.clip_id].w if t], split[r.clip_id].s
        best = None
        for i in range(len(s)):
            for k in range(1, min(6, len(s) - i) + 1):
                p = "".join(c if c.isalnum() else " " for c in " ".join(s[i : i + k])).split()
                if w and p and 0.65 <= len(p) / len(w) <= 1.35:
                    sim = plain(w, p)
                    best = max(best or (-9,), (sim - 0.04 * abs(len(p) - len(w)) / len(w), -i, -k, sim, " ".join(s[i : i + k]), len(p) / len(w)))
        want = (best[4], best[3], best[5], -best[2]) if best else ("", 0.0, None, 0)
        assert (r.proposal_text, r.proposal_similarity, r.proposal_token_ratio, r.proposal_sentence_count) == want
        some += best is not None
    assert len(found) == 80 and some > 20
    plan = physical(registry.sentence_alignment(spark, three_tasks()))
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


def test_overlapping_texts_need_one_pass(spark):
    """Segments and their events meet in lists, without a join of segments with themselves."""
    plan = physical(registry.segment_overlap_consensus(spark, three_tasks()))
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


def test_facts_need_no_word_rows(spark, tmp_path, monkeypatch):
    """The facts of clips from Arrow columns are those from rows of words, in any size of batch, with words that are odd or look so."""
    from captionloom.operators import segmentation as sg

    rng = random.Random(4)
    words = ["a", "Bee.", "c,", "(d", "e)", "&amp;", "&lt;b&gt;", "f\u200b", "\u200b", "g.\u2028", "(\u2028", "h!\x85", "\xa0", "“", "”", "…", "i…”", "Đẹp", "j;»", "8.", "x\x0by", "…k", "‘l", "\U0001f600"]
    docs = [(k, " ".join(rng.choices(words, k=rng.randint(1, 200)))) for k in range(60)] + [(60, None), (61, " \t"), (62, "one"), (63, " ".join(["word"] * 3000)), (-7, "minus seven is. a source "), (None, "no id at all. " * 9)]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    rows = lambda df: {(r.video_id, r.clip_no): r for r in df.collect()}
    want = rows(sg.clip_facts(ad.scored(spark, str(tmp_path))))
    assert len(want) > 300 and rows(sg.clip_facts_of(ad.texts(spark, str(tmp_path)), ad.word_times)) == want
    monkeypatch.setattr(sg, "WORDS_AT_A_TIME", 50)
    found = sg.clip_facts_of(ad.texts(spark, str(tmp_path)), ad.word_times)
    assert found.dtypes == sg.clip_facts(ad.scored(spark, str(tmp_path))).dtypes and rows(found) == want
    assert "Window" not in physical(found) and "Generate" not in physical(found)
    assert sg.clip_facts_of(ad.texts(spark, str(tmp_path)).where("false"), ad.word_times).count() == 0


def test_multisets_are_counted_in_their_row(spark, monkeypatch):
    """One exchange of documents serves the bound too: tokens are no rows, and pairs are not written."""
    monkeypatch.setattr(ad.Work, "save", lambda *_: 1 / 0)
    found = registry.quick_ratio_buckets(spark, three_tasks())
    assert physical(found).count("Exchange hashpartitioning") == physical(registry.bucket_pairs(spark, three_tasks())).count("Exchange hashpartitioning")
    rows = [(1, ["a", None, "a", "b"], ["a", "b", "b"]), (2, None, None), (3, ["x", None], None), (4, [None], [])]
    df = spark.createDataFrame(rows, "k int, a array<string>, b array<string>")
    assert {r.k: r.s for r in si.multiset_similarity(df, ["k"], F.col("a"), F.col("b"), "s").collect()} == {1: 2 / 3, 2: 1.0, 3: 0.0, 4: 1.0}


def test_windows_are_joined_without_pair_rows(spark, monkeypatch):
    """Texts near a clip come from its list of events, and a clip's tokens are encoded once for all of its runs."""
    spelt = []
    monkeypatch.setattr(al, "spelt", lambda *x, f=al.spelt: (spelt.append(1), f(*x))[1])
    rng = random.Random(8)
    for k in range(300):
        w, c = (rng.choices("abcdefgh"[: 1 + k % 8], k=rng.randint(1, n)) for n in (9, 40))
        runs = [(plain(w, c[i : i + n]) - 0.03 * abs(n - len(w)) / len(w), -n, -i, plain(w, c[i : i + n])) for n in range(max(1, len(w) - 4), len(w) + 7) for i in range(len(c) - n + 1)]
        best = max(runs, default=None)
        assert al.best_run(w, c) == ((best[3], " ".join(c[-best[2] : -best[2] - best[1]])) if best else (0.0, "")), (w, c)
    assert len(spelt) <= 300
    near = physical(ad.caption_windows(registry._clips(spark, three_tasks()), ad.captions(spark, three_tasks())))
    assert near.count("Generate explode") <= 3 and "_rs" in near


def test_packs_deal_long_sources_alone(spark, monkeypatch):
    """Sources that fit in a block are walked where they are; the links of the others come from a search for each limit."""
    import numpy as np

    from captionloom.operators import captions as cp
    from captionloom.operators import chains as ch
    from captionloom.params import Budget
    from captionloom.work import Work

    rng = random.Random(9)
    for k in range(400):
        budget = Budget(*sorted(rng.choices(range(1, 120), k=3)), rng.choice([0, 3]))
        sizes = [[rng.choice([0, 1, 7, 30, 200]) for _ in range(rng.randint(1, 40))] for _ in range(3)]
        last, *_, open_ = ch.pack_kernel(budget)({"size": np.concatenate(sizes)}, np.repeat(np.arange(3), list(map(len, sizes))), k % 2 == 0)
        base = 0
        for own in sizes:
            for i in range(len(own)):
                numbers = cp.pack_numbers(own[i:], budget)
                n = numbers.count(1)
                assert last[base + i] == base + i + n - 1 and open_[base + i] == (k % 2 == 1 and own is sizes[-1] and i + n == len(own))
            base += len(own)
    items = [(s, i, f"{s}{i}", rng.choice([0, 1, 7, 30, 200])) for s, n in (("a", 300), ("b", 2), ("c", 40), (None, 3), ("e", 41)) for i in range(n)]
    df, budget, saved = spark.createDataFrame(items, "video_id string, n int, id string, size int").repartition(5), Budget(60, 90, 120, 1), []
    monkeypatch.setattr(Work, "save", lambda self, df, name, save=Work.save: (saved.append((name, save(self, df, name))), saved[-1][1])[1])
    for block in (40, 1000):
        got = {r.id: r.pack_no for r in ch.pack_by_length(df, budget, ["n"], "size", Work(spark, "t"), block=block).collect()}
        for source in {s for s, *_ in items}:
            own = [x for x in items if x[0] == source]
            assert [got[x[2]] for x in own] == cp.pack_numbers([x[3] for x in own], budget) and len(got) == len(items)
        tables = dict(saved)
        assert ("items_at" in tables) == (block == 40) and (block == 1000 or {r.video_id for r in tables["items_at"].collect()} == {"a", "e"})
        saved.clear()


def test_ids_of_packs_do_not_collide(spark):
    """Ids have four digits at least, as the source's {n:04d}: those past 9,999 are not cut. (DuckDB's lpad() of the SQL cuts them.)"""
    from captionloom.operators import captions as cp
    from captionloom.work import Work

    packed = spark.range(10_003).selectExpr("'v' AS video_id", "int(id) AS pack_no", "id AS n", "string(id) AS piece_id", "1 AS size")
    ids = {r.pack_no: r.pack_id for r in cp.pack_index(packed, "piece_id", ["n"], "size", Work(spark, "t")).collect()}
    assert len(set(ids.values())) == 10_003 and (ids[0], ids[9_998], ids[9_999], ids[10_002]) == ("review_pack_0001", "review_pack_9999", "review_pack_10000", "review_pack_10003")


def test_texts_are_made_and_shuffled_once(spark, tmp_path):
    """Whether a document has words is asked of its first other character; a clip's text meets what is known of the clip in one join."""
    from captionloom.operators import segmentation as sg

    docs = [(0, "a  b"), (1, " \t\n\r\f"), (2, ""), (3, None), (4, "\xa0"), (5, "\x0b"), (6, "\n x")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.video_id: r.t for r in ad.texts(spark, str(tmp_path)).collect()} == {"d0": "a b", "d4": "\xa0", "d5": "\x0b", "d6": "x"}
    assert physical(ad.texts(spark, str(tmp_path))).count("regexp_replace") == 1
    facts = sg.clip_facts_of(ad.texts(spark, SF), ad.word_times)
    clips = sg.candidates(facts, ad.segments(spark, SF), ad.consensus(spark, SF))
    join = clips._jdf.queryExecution().optimizedPlan().children().apply(0)
    while join.nodeName() != "Join":
        join = join.children().apply(0)
    rows, about = (join.children().apply(k) for k in range(2))
    assert "Window" not in rows.toString() and "Join" not in rows.toString() and "Window" in about.toString()
    assert "text" not in {about.output().apply(k).name() for k in range(about.output().size())}


def test_sums_of_durations_need_no_sum_by_word(spark):
    rows = [(["a", "bc", "é…"],), (["x" * 40],), ([],)]
    df = spark.createDataFrame(rows, "ws array<string>")
    own = F.aggregate(F.transform("ws", ad.duration), F.lit(0).cast("long"), lambda t, x: t + x)
    assert all(a == b for a, b in df.select(own, ad.durations(F.col("ws"))).collect())
    plan = physical(ad.captions(spark, SF))
    assert plan.count("aggregate(") == 1
