"""The pipeline on the smallest tables, stage by stage, against what the stages' operators say."""

import random
import re
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from captionloom.llm import simhash_dedup as sh
from captionloom.llm.exact_dedup import exact_dedup
from captionloom.llm.simhash_dedup import simhash_dedup

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs.count()]
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        assert out.join(docs, "doc_id", "left_anti").count() == 0
        docs = out
        kept.append(docs.count())
    assert kept == sorted(kept, reverse=True) and kept[-1] > 0
    assert exact_dedup(docs).where("not kept").count() == 0
    assert simhash_dedup(docs).where("doc_id <> component_id").count() == 0
    packed = cp.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == kept[-1]
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0


def test_exact_stage_with_repeated_ids(spark):
    docs = spark.createDataFrame([(1, "a b", "s"), (1, "a b", "s"), (1, "other", "s"), (None, "ab", "s"), (2, None, "s"), (3, "", "s")], "doc_id long, text string, source string")
    got = sorted((str(r.doc_id), str(r.text)) for r in cp.exact(spark, docs, SF).collect())
    assert got == [("1", "a b"), ("1", "other"), ("2", "None")]


def test_near_stage_with_repeated_ids(spark):
    long, clean = " ".join(f"word{k}" for k in range(300)), " ".join(f"other{k}" for k in range(300))
    rows = [(1, long, "s"), (7, long, "s"), (7, clean, "s"), (None, long, "s"), (8, long, "s"), (8, long, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert sorted((r.doc_id, r.text) for r in cp.near(spark, docs, SF).collect()) == [(1, long), (7, clean)]


CLASHING = "doc_id long, text string, _id int, _sha string, _kept string, _n int, _row int, _group int, component_id int, score double, row string, held_out int, predicted int"


@pytest.fixture(scope="module")
def labelled(tmp_path_factory):
    """Labels for the documents below: of bad quality are those of marks, toxic those with a few words of their own."""
    root = tmp_path_factory.mktemp("labels")
    pq.write_table(pa.table({"doc_id": range(400), "quality": [int(k % 4 != 1) for k in range(400)], "toxic": [int(k % 4 == 2) for k in range(400)]}), root / "labels.parquet")
    return str(root)


def mixed():
    rng = random.Random(6)
    words = [a + b for a in ("th", "an", "er", "on", "re", "st") for b in ("ing", "the", "ou", "al", "is", "at")]
    rows = []
    for k in range(400):
        line = rng.choices(words, k=60)
        if k % 4 == 1:
            line = [w + "***" for w in line]
        if k % 4 == 2:
            line[5::9] = [rng.choice(["zzgrumble", "qqbother", "xxvex"]) for _ in line[5::9]]
        rows.append((k, " ".join(line[:30]) + ".\n" + " ".join(line[30:]) + "."))
    return rows


@pytest.mark.parametrize("name", ["quality", "toxicity", "exact_dedup", "near_dedup"])
def test_stage_on_awkward_rows(spark, labelled, name):
    stage, rows = dict(cp.STAGES)[name], mixed()
    odd = [(None, rows[0][1]), (0, rows[0][1]), (401, None), (402, ""), (403, " \n"), (404, "word " * 20_000), (None, "one of its own kind of text, with no copy anywhere")]
    docs = spark.createDataFrame([(i, t, *[1, "x", "x", 1, 1, 1, 1, 0.5, "r", 1, 1]) for i, t in rows + odd], CLASHING)
    got = stage(spark, docs, labelled)
    assert got.columns == docs.columns
    left = [(r.doc_id, r.text) for r in got.collect()]
    assert not Counter(left) - Counter(rows + odd)
    if name == "quality":
        bad = sum(i is not None and i < 400 and i % 4 == 1 for i, _ in left)
        assert bad == 0 and len(left) >= 300
        assert left.count(rows[0]) == 2 and (None, rows[0][1]) in left
    if name == "toxicity":
        assert sum(i is not None and i < 400 and i % 4 == 2 for i, _ in left) <= 5 and len(left) >= 295
    if name == "exact_dedup":
        assert Counter(left) == Counter([*rows, (403, " \n"), odd[5], odd[6]])
    if name == "near_dedup":
        # rows of other fingerprints, of each group the smallest id
        want = {}
        fps = [(sh.fingerprint(sh.shingle_hashes(t or "")), i, t) for i, t in rows + odd]
        root = list(range(len(fps)))
        for a in range(len(fps)):
            for b in range(a):
                if (fps[a][0] ^ fps[b][0]).bit_count() <= 4 and root[a] != root[b]:
                    old, new = max(root[a], root[b]), min(root[a], root[b])
                    root = [new if r == old else r for r in root]
        for r, (_, i, t) in zip(root, fps, strict=True):
            want.setdefault(r, []).append((i is None, i or 0, -len(t or ""), t or ""))
        least = sorted(min(x)[:2] for x in want.values())
        assert sorted((i is None, i or 0) for i, _ in left) == least
    assert stage(spark, docs.where("false"), labelled).count() == 0


def test_stages_drop_what_their_operators_reject(spark, labelled):
    docs = spark.createDataFrame(mixed(), "doc_id long, text string")
    labels = spark.read.parquet(f"{labelled}/labels.parquet")
    for stage, score, wanted in ((cp.quality, cp.score_quality, 1), (cp.toxicity, cp.score_toxicity, 0)):
        kept = {r.doc_id for r in stage(spark, docs, labelled).collect()}
        assert kept == {r.doc_id for r in score(docs, labels).where(f"predicted = {wanted}").collect()}


def test_packing_of_no_documents(spark):
    assert cp.packing(spark, spark.createDataFrame([], "doc_id long, text string"), SF).count() == 0


def test_run(spark, tmp_path):
    """The whole run gives what the stages give one by one, each judged against its operator on its own input: every document that
    its classifiers keep, one of equal texts and one of each group of near copies, packed without gaps."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given = docs
    for name, stage in cp.STAGES:
        out = stage(spark, given, SF)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        last, given = given, spark.read.parquet(f"{tmp_path}/{name}")
        if name == "exact_dedup":
            bare = lambda df: {re.sub("[ \\t-\\r]", "", r.text or "") for r in df.collect()}
            assert given.count() == len(bare(given)) == len(bare(last)) and bare(given) == bare(last)
        if name == "near_dedup":
            groups = simhash_dedup(last)
            assert sorted(r.doc_id for r in given.collect()) == sorted(r.doc_id for r in groups.where("doc_id = component_id").collect())
    rows = sorted(tuple(r) for r in given.select(sorted(given.columns)).collect())
    whole = cp.run(spark, SF)
    assert len(rows) > 0 and sorted(tuple(r) for r in whole.select(sorted(whole.columns)).collect()) == rows
    kept = spark.read.parquet(f"{tmp_path}/near_dedup")
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in given.collect()}
    spans: dict = {}
    for r in given.collect():
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in spans.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
