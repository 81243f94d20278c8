"""Isolated failures and versioned state: what is kept, what is counted, who loses."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from captionloom.plans import attempts as at
from captionloom.plans import runstate as rs
from captionloom.work import Work


def step():
    """A function of its own scope, which workers get by value."""

    def halve(row):
        if row["n"] == 7:
            raise KeyError("seven")
        if row["n"] == 8:
            return {"half": "not a number"}
        return {"half": 100 // (row["n"] % 5), "name": f"n{row['n']}"}

    return halve


def numbers(spark):
    return spark.range(20).select(F.col("id").alias("n"), F.array(F.col("id"), F.lit(None).cast("long")).alias("other")).repartition(4)


def test_failures_are_isolated_and_fail_the_run(spark, tmp_path):
    path = str(tmp_path / "out")
    with pytest.raises(at.FailedRows) as failed:
        at.run_isolated(numbers(spark), step(), ["n"], "half long, name string", path, allowed=5)
    e = failed.value
    assert (e.attempted, e.succeeded, e.failed, e.written) == (20, 14, 6, 20) and "6 of 20" in str(e)
    good, bad = at.outcomes(numbers(spark), "half long, name string", path)
    assert good.columns == ["n", "other", "half", "name"] and bad.columns == ["n", "other", "error_type", "error"]
    kept = {r.n: (r.half, r.name, r.other) for r in good.collect()}
    assert kept == {n: (100 // (n % 5), f"n{n}", [n, None]) for n in range(20) if n % 5 and n not in (7, 8)}
    why = {r.n: (r.error_type, r.error) for r in bad.collect()}
    assert why.keys() == {0, 5, 10, 15, 7, 8} and why[7] == ("KeyError", "'seven'") and why[0][0] == "ZeroDivisionError" and why[8][0].startswith("Arrow")


def test_allowed_failures(spark, tmp_path):
    good, bad = at.run_isolated(numbers(spark), step(), ["n"], "half long, name string", str(tmp_path / "out"), allowed=6)
    assert (good.count(), bad.count()) == (14, 6)
    none = at.run_isolated(numbers(spark).limit(0), step(), ["n"], "half long, name string", str(tmp_path / "none"))
    assert [x.count() for x in none] == [0, 0]
    with pytest.raises(Exception, match="(?i)already exists"):
        at.run_isolated(numbers(spark), step(), ["n"], "half long, name string", str(tmp_path / "none"))


def ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "video_id string")


def sized(todo):
    return todo.select("video_id", F.length("video_id").alias("n"))


def test_of_two_writers_one_loses(spark, tmp_path):
    one, two = rs.VersionedState(spark, str(tmp_path)), rs.VersionedState(spark, str(tmp_path))
    base = one.latest()
    assert (base, two.latest(), one.rows("s")) == (0, 0, None)
    assert one.commit(base, "s", {"a": 1}, ids(spark, "x"), sized(ids(spark, "x"))) == 1
    with pytest.raises(rs.Conflict):
        two.commit(base, "s", {"a": 1}, ids(spark, "y"), sized(ids(spark, "y")))
    assert [(r.video_id, r.n, r.version) for r in two.rows("s").collect()] == [("x", 1, 1)]
    # nothing of the loser is left
    assert len(list((tmp_path / "data").iterdir())) == 1 and not [p for p in (tmp_path / "staged").iterdir() if not p.name.startswith(".")]
    assert two.commit(two.latest(), "s", {"a": 1}, ids(spark, "y"), sized(ids(spark, "y"))) == 2
    assert sorted(r.video_id for r in one.done("s").collect()) == ["x", "y"]


def test_a_broken_run_goes_on(spark, tmp_path):
    state, calls = rs.VersionedState(spark, str(tmp_path)), []

    def compute(todo):
        calls.append(sorted(r.video_id for r in todo.collect()))
        if calls[-1] == ["b"] and len(calls) == 2:
            raise RuntimeError("broken off")
        return sized(todo)

    batches = [ids(spark, "a"), ids(spark, "b"), ids(spark, "a", "cc")]
    with pytest.raises(RuntimeError, match="broken"):
        rs.run_versioned(state, "s", {"a": 1}, batches, compute)
    assert state.latest() == 1
    out = rs.run_versioned(state, "s", {"a": 1}, batches, compute)
    assert calls == [["a"], ["b"], ["b"], ["cc"]]
    assert {(r.video_id, r.n, r.version) for r in out.collect()} == {("a", 1, 1), ("b", 1, 2), ("cc", 2, 3)}
    with pytest.raises(ValueError, match="another configuration"):
        rs.run_versioned(state, "s", {"a": 2}, batches, compute)
    # a stray file and a staged folder are no versions
    (tmp_path / "versions" / "notes.txt").write_text("x")
    (tmp_path / "staged" / "old").mkdir()
    assert [v.number for v in state.versions()] == [1, 2, 3] and json.loads(state.versions()[0].config) == {"a": 1}


def test_work_folders_are_deleted_at_the_end(spark, monkeypatch):
    monkeypatch.setattr(Work, "made", [])
    one = Work(spark, "a")
    there = lambda: Path(one.path.removeprefix("file:")).exists()
    assert one.save(spark.range(3), "t").count() == 3 and there()
    Work(spark, "b")
    Work.clear()
    assert not there() and not Work.made
