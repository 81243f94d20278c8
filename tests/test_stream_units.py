"""Units of sources from a stream against the same rule over all events, with batches that break off and are repeated."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from captionloom.streaming import streams, units

PAUSE = 60_000
START = dt.datetime(2024, 1, 1)
SCHEMA = "source string, event_id long, time timestamp, amount long, ends boolean"


def events():
    rng, out, ms = random.Random(9), [], 0
    for k in range(300):
        ms += rng.choice([0, 500, 5_000, 40_000, 130_000 if k % 40 == 0 else 1])
        out.append((rng.choice("abc"), k, START + dt.timedelta(milliseconds=ms), rng.randint(1, 9), rng.random() < 0.2))
    # one that falls silent early, closed by a timer and not by a next event
    out.append(("silent", 1000, START, 5, False))
    return out


def expected(rows):
    end, out = max(r[2] for r in rows), set()
    for source in {r[0] for r in rows}:
        n, open_ = 0, []

        def close(by):
            nonlocal n, open_
            n += 1
            out.add((source, n, open_[0][1], open_[-1][1], len(open_), sum(r[3] for r in open_), by))  # noqa: B023
            open_ = []

        for r in sorted((r for r in rows if r[0] == source), key=lambda r: (r[2], r[1])):
            if open_ and (r[2] - open_[-1][2]).total_seconds() * 1000 > PAUSE:
                close("pause")
            open_.append(r)
            if r[4]:
                close("end")
        if open_ and (end - open_[-1][2]).total_seconds() * 1000 > PAUSE:
            close("pause")
    return out


def test_units_survive_a_broken_batch(spark, tmp_path):
    rows, path = events(), str(tmp_path / "units")
    source, write, tries = str(tmp_path / "events"), units.write_batch(path), []

    def breaks(df, number):
        write(df, number)
        tries.append(number)
        if number == 1 and tries.count(1) == 1:
            raise RuntimeError("after the write, before the commit")

    def run():
        stream = streams.read_new_files(spark, source, spark.createDataFrame([], SCHEMA).schema, 1)
        return units.run_units(units.streamed_units(stream, PAUSE), path, str(tmp_path / "checkpoint"), breaks)

    every = sorted(rows, key=lambda r: r[2])
    for k in range(3):
        spark.createDataFrame(every[k * 101 : (k + 1) * 101], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    with pytest.raises(Exception, match="before the commit"):
        run().awaitTermination()
    run().awaitTermination()
    assert tries.count(1) == 2
    found = spark.read.parquet(path).select("source", "unit_no", "first_event", "last_event", "n_events", "amount", "closed_by")
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == expected(rows)
    assert ("silent", 1, 1000, 1000, 1, 5, "pause") in got
    assert found.where(F.col("unit_no") < 1).isEmpty()
