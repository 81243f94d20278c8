"""Captions and segments without word rows, hints, and event texts joined in one step."""

import re

import pytest
from pyspark.sql import functions as F

from captionloom.functions import text as tx
from captionloom.plans import adapters as ad
from captionloom.plans import registry


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    sf = str(tmp_path_factory.mktemp("runs"))
    texts = ["a", " ".join(f"w{k}{'.' if k % 5 == 0 else ',' if k % 7 == 0 else ''}" for k in range(43)), " x\ty! ", "", None, "é… .  b  c", " ".join("ab" for _ in range(14))]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{sf}/documents.parquet")
    return sf


def test_runs_are_the_grouped_words(spark, folder):
    words = ad.words(spark, folder)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word_index", "word"))), lambda x: x["word"]), " ").alias("text")
    for kept, size, name, runs in ((F.lit(True), 20, "segment_id", ad.segments), (F.expr("word_index % 13 <> 12"), 7, "event_index", ad.captions)):
        more = 500 if size == 7 else 0
        want = words.where(kept).groupBy("video_id", F.floor(F.col("word_index") / size).alias(name)).agg(F.min("start_ms"), F.max("end_ms") + more, joined)
        found = runs(spark, folder).select("video_id", name, "start_ms", "end_ms", "text")
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))


def test_runs_sort_no_words(spark, folder):
    # one sort, of runs, and no aggregation of word rows
    for df in (ad.segments(spark, folder), ad.captions(spark, folder)):
        assert "Aggregate" not in plan(df)
    assert plan(registry.bucket_pairs(spark, folder)).count("SortAggregate") + plan(registry.bucket_pairs(spark, folder)).count("ObjectHashAggregate") <= 4


def test_hints_by_plain_models(spark):
    rows = ["the the", "The, the", "a - a", "a a", "x.x xx", "a A!", "..", "", "it's its", "ba bc bd be", "ba bc bd be x", "ba bc xx bd be", "ab ac ad a e ae", "ba bc bd xx yy bg", "đa đb đc xx đd", "12 13 14 15 ba"]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    found = {r.t: (r.a, r.b) for r in df.select("t", tx.repeated_token(F.col("t")).alias("a"), tx.crowded_initials(F.col("t")).alias("b")).collect()}
    marks = re.escape("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~…")
    for r in rows:
        ws = [re.sub(f"^[{marks}]+|[{marks}]+$", "", w) for w in r.lower().split()]
        h = [t[0] for t in re.findall("[0-9A-Za-zÀ-ỹĐđ]+", r.lower()) if len(t) > 1]
        crowd = any(max(h[i : i + 5].count(c) for c in h[i : i + 5]) >= 4 for i in range(len(h) - 4))
        assert found[r] == (any(a and a == b for a, b in zip(ws, ws[1:])), crowd), r
    assert df.limit(1).select(tx.repeated_token(F.lit(None).cast("string")), tx.crowded_initials(F.lit(None).cast("string"))).first() == (False, False)


def test_event_texts_are_joined_once(spark):
    rows = [["a", "b"], ["", "a", "", ",b"], ["a ", "b"], ["a\n", "b", ""], ["a", "", "b"], [], ["a", None], ["a  ", "b"]]
    found = [r.x for r in spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, p array<string>").orderBy("k").select(tx.join_events(F.col("p")).alias("x")).collect()]
    assert found == ["a b", "a,b", "a b", "a\nb", "a b", "", None, "a   b"]


def test_pieces_keep_their_offsets(spark):
    rows = ["A b.  C d!  E", "  x. y  ", "one", "a.\n\nb? …c… d"]
    for t, p in spark.createDataFrame([(r,) for r in rows], "t string").select("t", tx.split_pieces(F.col("t"))).collect():
        assert all(t[x.char_start : x.char_end] == x.piece == x.piece.strip() for x in p)
        assert "".join(x.piece for x in p) == re.sub(r"\s", "", t) or " " in "".join(x.piece for x in p)


def test_parts_of_the_stream_have_files_in_proportion():
    assert registry.files_a_part([20_000] * 5) == 1
    assert registry.files_a_part([7_200_000] * 5) == 8
    # where one part could not fill its files, a batch of them would reach into the next part
    assert registry.files_a_part([7_200_000, 500, 0, 0, 0]) == 1 and registry.files_a_part([7_200_000] * 4 + [3000]) == 3
