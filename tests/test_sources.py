"""Readers, sinks, resumable stages and streams on small files."""

import json

import pytest
from pyspark.sql import functions as F

from captionloom import schemas
from captionloom.plans import runstate
from captionloom.sources import readers, sinks
from captionloom.streaming import streams
from captionloom.work import Work


def test_caption_events(spark, tmp_path):
    doc = {"events": [{"tStartMs": 500, "dDurationMs": 1500, "segs": [{"utf8": "Hi "}, {"utf8": "you."}]}, {"tStartMs": 1}, {"segs": [{"utf8": "late"}, {}]}]}
    (tmp_path / "abc.vi.json3").write_text(json.dumps(doc))
    (tmp_path / "bad.json3").write_text("no json")
    rows = readers.caption_events(readers.caption_documents(spark, str(tmp_path))).orderBy("event_index").collect()
    assert [(r.video_id, r.event_index, r.start_sec, r.end_sec, r.text, r.ends_terminal_punctuation) for r in rows] == [
        ("abc", 0, 0.5, 2.0, "Hi you.", True),
        ("abc", 2, 0.0, 0.0, "late", False),
    ]


def test_broken_caption_documents(spark):
    events = [
        {"tStartMs": 500, "dDurationMs": 1500, "segs": [{"utf8": "Hi "}, {"utf8": "you."}]}, {"tStartMs": 1}, {"tStartMs": "x", "segs": []}, 7, None,
        {"tStartMs": None, "segs": [{"utf8": "n"}, {}, 3, None, {"utf8": 5}]}, {"segs": "s"}, {"tStartMs": True}, {"dDurationMs": {}, "segs": []},
    ]
    docs = [("a", json.dumps({"events": events})), ("b", "no json"), ("c", '{"x":1}'), ("d", '{"events":{}}'), ("e", None), ("f", "[1]"), ("g", '{"events":[]}')]
    good, bad = readers.caption_events_rescued(spark.createDataFrame(docs, "video_id string, content string"))
    assert [(r.video_id, r.event_index, r.start_sec, r.end_sec, r.text) for r in good.orderBy("event_index").collect()] == [("a", 0, 0.5, 2.0, "Hi you."), ("a", 5, 0.0, 0.0, "n5")]
    found = {(r.video_id, r.event_index): (r.reason, r.rescued) for r in bad.collect()}
    assert {k: v[0] for k, v in found.items()} == {
        ("a", 2): "BAD_START", ("a", 3): "NOT_OBJECT", ("a", 4): "NOT_OBJECT", ("a", 6): "BAD_SEGMENTS", ("a", 7): "BAD_START", ("a", 8): "BAD_DURATION",
        ("b", None): "NOT_JSON", ("c", None): "NO_EVENTS", ("d", None): "NO_EVENTS", ("e", None): "NOT_JSON", ("f", None): "NO_EVENTS",
    }
    assert found["a", 6][1] == '{"segs":"s"}' and found["b", None][1] == "no json"


def test_broken_records(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id,name,x\n1,"a ""q"", b",1.5\n2,b,\nx,c,2.5\n3,d\n4,e,1,2\n5,"open,3\n6,,7\n')
    good, bad = readers.csv_rescued(spark, str(tmp_path), "id long, name string, x double", Work(spark, "t"))
    assert {(r.id, r.name, r.x) for r in good.collect()} == {(1, 'a "q", b', 1.5), (2, "b", None), (6, None, 7.0)}
    assert {r.rescued for r in bad.collect()} == {"x,c,2.5", "3,d", "4,e,1,2", '5,"open,3'} and (good.count(), bad.count()) == (3, 4)


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 'say "x", \n twice', 1.5), ("NA", None, None)], "id string, text string, x double")
    sinks.write_csv(df.coalesce(1), str(tmp_path / "c"))
    back = readers.csv_table(spark, str(tmp_path / "c"), "id string, text string, x double").collect()
    assert {(r.id, r.text, r.x) for r in back} == {("a", 'say "x", \n twice', 1.5), ("NA", None, None)}


def test_numbers_have_no_nan(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("NaN",), (None,)], "v string")
    assert [r.v for r in schemas.numbers(df, "v").collect()] == [1.5, None, None, None]
    with pytest.raises(ValueError, match="missing"):
        schemas.require_columns(df, "v", "w")


def test_failures_are_kept_apart(spark):
    df = spark.createDataFrame([("a", (True, None, None)), ("b", (False, "E", "why"))], "id string, result struct<ok:boolean,error_type:string,error:string>")
    good, bad = sinks.split_failures(df)
    assert [r.id for r in good.collect()] == ["a"]
    assert [tuple(r) for r in bad.collect()] == [("b", "E", "why")]


def test_review_texts(spark):
    df = spark.createDataFrame([("v", 1, 1, "a"), ("v", 1, 2, "b"), ("v", 2, 3, "c")], "video_id string, pack_no int, n int, t string")
    rows = {r.pack_no: r.body for r in sinks.review_texts(df, ["n"], "t", context=1).collect()}
    assert rows == {1: "# v part 1\n0001  a\n0002  b", 2: "# v part 2\n~ b\n0001  c"}


def test_stage_resumes(spark, tmp_path):
    seen = []

    def compute(sources):
        seen.append(sorted(r.video_id for r in sources.collect()))
        return sources.select("video_id", F.length("video_id").alias("n"))

    root = str(tmp_path)
    runstate.run_stage(spark, root, "s", {"a": 1}, readers.source_list(spark, ["x", "yy"]), compute)
    out = runstate.run_stage(spark, root, "s", {"a": 1}, readers.source_list(spark, ["x", "yy", "zzz"]), compute)
    assert seen == [["x", "yy"], ["zzz"]]
    assert out.count() == 3
    with pytest.raises(ValueError, match="another configuration"):
        runstate.run_stage(spark, root, "s", {"a": 2}, readers.source_list(spark, ["x"]), compute)


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    found = []
    stream = streams.unseen(streams.read_new_files(spark, str(tmp_path / "in"), events.schema, 1), "event_id", "ts", "400 days")
    q = streams.run_available(stream, str(tmp_path / "ck"), lambda df, _: found.extend(r.event_id for r in df.collect()))
    q.awaitTermination()
    assert sorted(found) == sorted(r.event_id for r in events.collect())
    assert streams.bucket_counts(events, "ts").agg(F.sum("events")).first()[0] == events.count()
