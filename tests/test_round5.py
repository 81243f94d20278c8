"""Plans that failed at size: each test would have failed before its change."""

from __future__ import annotations

from captionloom.sources import sinks


def test_files_by_source_do_not_grow_with_sources(spark, tmp_path):
    """Folders are bounded; sources that are written again are replaced, whole, and the others of their folders stay."""
    path = str(tmp_path / "t")
    table = lambda names, n, text: spark.createDataFrame([(v, i, text) for v in names for i in range(n)], "video_id string, n int, text string")
    names = [f"d{k}" for k in range(500)] + [None]
    sinks.write_by_source(table(names, 3, "old"), path)
    files = list(tmp_path.glob("t/**/*.parquet"))
    assert len(files) <= sinks.SOURCE_FOLDERS and len({f.parent for f in files}) == len(files)
    again = ["d1", "d2", "d499", None, "new"]
    sinks.write_by_source(table(again, 2, "new"), path)
    got = sinks.read_by_source(spark, path)
    assert got.columns == ["video_id", "n", "text"]
    want = {(v, i, "old") for v in names if v not in again for i in range(3)} | {(v, i, "new") for v in again for i in range(2)}
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    sinks.write_by_source(table(["d7"], 0, "").unionByName(table(["d8"], 1, "x")), path)
    assert got.sparkSession.read.parquet(path).where("video_id = 'd8'").count() == 1


def exchanges(df) -> int:
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1].count("Exchange hashpartitioning")


def test_runs_of_tokens_are_no_rows(spark):
    """The best run of a clip is found in its row, whatever part of the runs is counted at a time: no run is written or shuffled."""
    import random

    from captionloom.operators import alignment as al
    from captionloom.plans import adapters as ad
    from captionloom.plans import registry
    from captionloom.work import Work

    rng, rows = random.Random(5), []
    for k in range(60):
        words, said = (rng.choices("abcdefgh"[: rng.randint(1, 8)], k=rng.randint(0, n)) for n in (12, 40))
        said[2:2] = words if k % 3 == 0 else []
        rows.append((k, words, said))
    pairs = spark.createDataFrame(rows, "k int, w array<string>, c array<string>")
    want = sorted(map(tuple, al.token_subsequence(pairs, Work(spark, "t"), "k").collect()))
    assert sorted(map(tuple, al.token_subsequence_by_clip(pairs, "k").collect())) == want
    for counted in (1, 50):
        al.COUNTED, before = counted, al.COUNTED
        try:
            assert [(k, *al.best_run(w, c)) for k, w, c in rows] == want
        finally:
            al.COUNTED = before
    sf = ad.timed(spark, "/root/testdata/sf0.001")
    sf.tasks = 3
    assert exchanges(registry.token_subsequence(spark, sf)) == 3


def test_sides_that_are_dealt_by_source_stay_where_they_are(spark):
    """Overlaps of rows that documents were dealt for need no exchange of their own, and are those of the join."""
    import random

    from captionloom.operators import timeline as tl
    from captionloom.plans import adapters as ad
    from captionloom.plans import registry

    rng = random.Random(6)
    span = lambda at: (at, at + rng.choice([0, 1, 900, 45_000, -400]))
    some = lambda: [(rng.choice(["x", "y", None]), i, *span(rng.randint(-50_000, 90_000))) for i in range(80)]
    left, right = spark.createDataFrame(some(), "k string, i int, a long, b long"), spark.createDataFrame(some(), "k string, j int, c long, d long")
    for more in ((0, False), (3000, True), (250, False, 700)):
        one, two = (f(left, right, "k", ("a", "b"), ("c", "d"), *more) for f in (tl.interval_join, tl.dealt_interval_join))
        assert one.columns == two.columns and one.count() and sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    sf = ad.timed(spark, "/root/testdata/sf0.001")
    sf.tasks = 3
    assert exchanges(registry.overlap_text(spark, sf)) == 2 and exchanges(registry.density_flags(spark, sf)) == 3
    assert exchanges(ad.caption_windows(registry._clips(spark, sf), ad.captions(spark, sf))) == 3


def test_sentencepiece_writes_its_blocks_alone(spark, tmp_path, monkeypatch):
    """Answers go to their blocks without a table of their own, words of like frequency are numbered by their letters, and ids go as
    the lengths of pieces, but for words that their pieces do not spell."""
    import random

    import numpy as np

    from captionloom.llm import queries
    from captionloom.llm import sentencepiece_codec as sc

    saved = []
    monkeypatch.setattr(sc.Work, "save", lambda self, df, name, save=sc.Work.save: (saved.append(name), save(self, df, name))[1])
    docs = spark.createDataFrame([(k, f"some words {k} and  more words, some ÅÅ {'x' * k}") for k in range(40)], "doc_id long, text string")
    model = queries.tokenizer_file("piece_bpe_32k.model")
    got = {r.doc_id: (list(r.ids), r.decoded) for r in sc.encode_and_decode(docs, model, block_words=50).collect()}
    lib = sc.encoder(model).lib
    assert saved == ["blocks"] and got == {r.doc_id: (lib.encode(r.text), lib.decode(lib.encode(r.text))) for r in docs.collect()}
    codec = sc.encoder(model)
    (_, plain, _), (_, odd, _) = codec.segment(["words", "\u4e00\U0001f9ff"])
    assert codec.spelt("words", codec.cuts("words", plain)) == plain and codec.cuts("\u4e00\U0001f9ff", odd) is None
    rng = random.Random(7)
    words = sorted({"".join(rng.choices("abcdefgh", k=7)) for _ in range(20_000)}, key=lambda w: w[::-1])
    counts = np.ones(len(words), np.int64)
    counts[:3] = 900, 5, 4
    order = sc.arranged_words(words, counts).tolist()
    assert order[0] == 0 and set(order[1:3]) == {1, 2} and [words[k] for k in order[3:]] == sorted(words[3:])
