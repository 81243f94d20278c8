"""Plans and kernels that failed at size: each test would have failed before its change."""

from __future__ import annotations

from captionloom.operators.dyadic import dyadic_join
from captionloom.operators.timeline import interval_join


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_sides_of_interval_joins_never_pass_through_the_driver(spark):
    left = spark.createDataFrame([("a", 1, 0, 900_000)], "k string, i int, a long, b long")
    right = spark.createDataFrame([("a", 2, 5, 7)], "k string, j int, c long, d long")
    for join in (dyadic_join, interval_join):
        df = join(left, right, "k", ("a", "b"), ("c", "d"))
        assert df.collect() == [("a", 1, 0, 900_000, 2, 5, 7)]
        assert "BroadcastExchange" not in plan(df) and "SortMergeJoin" in plan(df)


def test_words_are_dealt_before_they_are_made(spark):
    """Documents are shuffled, their words are not: one exchange serves windows, groups and buckets by source."""
    from captionloom.plans import adapters as ad
    from captionloom.plans import registry

    sf = ad.timed(spark, "/root/testdata/sf0.001")
    sf.tasks = 3
    scored = ad.scored(spark, sf)
    assert plan(scored).split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 1
    for df in (ad.segments(spark, sf), ad.captions(spark, sf), registry.best_end(spark, sf), registry.clip_spans(spark, sf)):
        assert plan(df).split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 1
    assert "Join" not in plan(registry.bucket_pairs(spark, sf)).split("== Physical Plan ==")[1]


def test_chains_of_many_sources_are_those_of_each():
    import numpy as np

    from captionloom.operators import segmentation as sg

    rng = np.random.default_rng(4)
    for _ in range(200):
        sizes = rng.integers(1, 60, 5)
        parts = []
        for n in sizes:
            start = np.cumsum(rng.integers(100, 4000, n))
            parts.append((start, start + rng.integers(50, 3000, n), rng.integers(0, 9, n) * sg.UNIT))
        source = np.repeat(np.arange(5), sizes)
        got = sg.chains(*(np.concatenate(x) for x in zip(*parts, strict=True)), source)
        base, want = 0, []
        for k, part in enumerate(parts):
            for number, (first, last, score, forced, merged, basis) in enumerate(sg.chain(*part)):
                want.append((k, number + 1, base + first, base + last, score, base + basis, forced, merged))
            base += len(part[0])
        assert [tuple(x) for x in zip(*(got[c].tolist() for c in ("source", "clip_no", "first", "last", "score", "basis", "forced", "merged")), strict=True)] == want


def test_facts_of_walks_are_those_of_members(spark, tmp_path):
    from captionloom.operators import segmentation as sg
    from captionloom.plans import adapters as ad

    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 60").write.parquet(f"{tmp_path}/documents.parquet")
    scored = ad.scored(spark, ad.timed(spark, str(tmp_path)))
    rows = lambda df: sorted((r.video_id, r.clip_no, sorted(r.segments), *(x for c, x in sorted(r.asDict().items()) if c != "segments")) for r in df.collect())
    got = rows(sg.clip_facts(scored))
    assert got and got == rows(sg.member_facts(sg.clip_members(scored)))


def test_every_entity_name_is_found_by_its_hash(spark):
    """All names, each whole, cut off by one character and with letters after it, without a search through all names."""
    import html.entities

    from pyspark.sql import functions as F

    from captionloom.functions import text as tx

    texts = [t for n in html.entities.html5 for t in (f"&{n}", f"&{n[:-1]}", f"&{n}x&")] + ["&#0000000000065;", "&#x;&#32;&#126;&#127;&#31;"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.unescape(F.col("t")).alias("u")).collect()
    assert [r.u for r in got] == [html.unescape(t) for t in texts]
    assert max(b.count("\u0001") for b in tx.entity_buckets()) < 10


def test_sql_of_unescaped_pages_knows_all_references(spark, tmp_path):
    import html.entities
    import random

    import duckdb

    from captionloom.plans import oracle, registry

    rng, names = random.Random(14), list(html.entities.html5)
    bits = ["&amp", "&am", "&", "&copy", "&amp;lt;", "&#39", "&#x41;", "&#0;", "&#128;", "&#xD800;", "&#11;", "&#99999999999;", "&#x;", "&#x1F600;", "&#xg", "&notit;", " ", "\t", "a", ";", "é"]
    rows = [(i, "", "".join(rng.choices(bits + [f"&{rng.choice(names)}"], k=rng.randint(1, 8)))) for i in range(800)] + [(900, "", None), (901, "", "")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted((r.page_id, r.clean_md5, r.clean_chars) for r in registry.unescaped_pages(spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert got == sorted(con.sql(oracle.SQL["unescaped_pages"]).fetchall())


def test_texts_of_event_runs_are_split_once(spark):
    """Above the explosion to runs no text is split again, and the tokens of a run are those of its joined text."""
    from difflib import SequenceMatcher

    from pyspark.sql import functions as F

    from captionloom.functions import text as tx
    from captionloom.operators.alignment import event_run_match

    events = ["a &am", "p; ΟΔΟΣ", None, "", "&nbspb &lt", "; c​d", "ΣΑΣ e"]
    pairs = spark.createDataFrame([("x", "a p οδος b c d", k, k, k, t) for k, t in enumerate(events)], "clip_id string, text string, event_start int, event_end int, event_index int, event_text string")
    out = event_run_match(pairs)
    above = plan(out).split("== Optimized Logical Plan ==")[1].split("Generate explode")[0]
    assert "regexp_replace" not in above
    joins = {(i, k): " ".join(t for t in events[i : i + k] if t is not None).strip() for i in range(7) for k in range(1, 8 - i)}
    said = {r.j: r.t for r in spark.createDataFrame([(j,) for j in [*joins.values(), pairs.first().text]], "j string").select("j", tx.lexical_tokens(F.col("j")).alias("t")).collect()}
    own = said[pairs.first().text]
    best = max(SequenceMatcher(None, own, said[j], autojunk=False).ratio() if said[j] else 0.0 for j in joins.values())
    got = out.first()
    assert got.similarity == best and got.matched in joins.values()
