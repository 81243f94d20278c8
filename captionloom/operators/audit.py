"""Audit routing, validation of labelled results, key checks and run compatibility."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captionloom.functions import text as tx
from captionloom.params import LABELS


def one_to_one(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Left join that fails if either side repeats a key or the right side lacks one."""
    unique = lambda df: df.groupBy(on).agg(F.count(F.lit(1)).alias("_n"))
    counts = unique(left).withColumnRenamed("_n", "_l").join(unique(right).withColumnRenamed("_n", "_r"), on, "left")
    checked = counts.select(on, F.assert_true((F.col("_l") == 1) & (F.col("_r") == 1), F.lit("the join is not one to one")).alias("_ok"))
    return left.join(checked, on).where(F.col("_ok").isNull()).drop("_ok").join(right, on, "left")


def key_difference(expected: DataFrame, found: DataFrame, on: str) -> DataFrame:
    """Keys of one side alone: (key, side 'missing' or 'extra')."""
    a, b = expected.select(on).distinct().withColumn("_e", F.lit(1)), found.select(on).distinct().withColumn("_f", F.lit(1))
    both = a.join(b, on, "full_outer").where("_e is null or _f is null")
    return both.select(on, F.when(F.col("_f").isNull(), "missing").otherwise("extra").alias("side"))


def aligned_union(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; columns that one lacks are null; columns in alphabetical order."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out.select(*sorted(out.columns))


def mapped(value: Column, table: dict[str, str]) -> Column:
    """Value by table; fails for a value that the table lacks."""
    known = F.create_map(*(F.lit(x) for pair in table.items() for x in pair))
    found = F.try_element_at(known, value)
    return F.when(found.isNotNull(), found).otherwise(F.raise_error(F.concat(F.lit("unmapped value: "), F.coalesce(value, F.lit("null")))))


def keep_audit(clips: DataFrame, aligned: DataFrame) -> DataFrame:
    """Route and audit decision of each kept clip. Clips without caption trust never take caption text."""
    trusted = one_to_one(clips.where("decision = 'KEEP_AUTO'"), aligned, "clip_id")
    decision = mapped(F.col("alignment_decision"), {"ACCEPT_CAPTION": "ACCEPT_CAPTION_CANDIDATE", "REVIEW_ALIGNMENT": "REVIEW_ALIGNMENT"})
    trusted = trusted.select("*", F.lit("TRUSTED_CAPTION_ALIGNMENT").alias("audit_route"), decision.alias("audit_decision"))
    other = clips.where("decision = 'KEEP_WHISPER_PRIMARY'").select(
        "*",
        F.lit("WHISPER_PRIMARY_LOW_CAPTION_TRUST").alias("audit_route"),
        F.lit("REVIEW_WHISPER_PRIMARY").alias("audit_decision"),
        F.lit("").alias("alignment_decision"),
        F.lit("caption_reference_low_trust").alias("alignment_reason"),
        F.lit("").alias("proposal_text"),
    )
    return aligned_union(trusted, other)


def validate_results(blocks: DataFrame, results: DataFrame) -> DataFrame:
    """blocks(block_id, source_text), results(block_id, result_no, segments array<struct<text_exact, label>>) ->
    block_id, errors (joined by semicolons, '' for none), segment_count. Of repeated results the last counts."""
    last = results.groupBy("block_id").agg(F.max_by("segments", "result_no").alias("segments"))
    rows = blocks.select("block_id", "source_text", F.lit(True).alias("_b")).join(last.withColumn("_r", F.lit(True)), "block_id", "full_outer")
    bad = F.filter(
        F.transform("segments", lambda s, i: F.when(~F.coalesce(s["label"], F.lit("")).isin(*LABELS), F.concat(F.lit("INVALID_LABEL:"), i.cast("string"), F.lit(":"), F.coalesce(s["label"], F.lit(""))))),
        lambda e: e.isNotNull(),
    )
    back = F.array_join(F.transform("segments", lambda s: F.coalesce(s["text_exact"], F.lit(""))), " ")
    covered = tx.squeeze(back) == tx.squeeze(F.col("source_text"))
    errors = (
        F.when(F.col("_b").isNull(), F.array(F.lit("EXTRA_RESULT_BLOCK")))
        .when(F.col("_r").isNull(), F.array(F.lit("MISSING_RESULT_BLOCK")))
        .otherwise(F.concat(bad, F.when(covered, F.array().cast("array<string>")).otherwise(F.array(F.lit("TEXT_COVERAGE_MISMATCH")))))
    )
    return rows.select("block_id", F.array_join(errors, ";").alias("errors"), F.coalesce(F.size("segments"), F.lit(0)).alias("segment_count"))


def validate_items(items: DataFrame, results: DataFrame) -> DataFrame:
    """items(pilot_id, source_text), results(pilot_id, result_id, segments) -> pilot_id, errors (joined by semicolons), and
    feedback: what a next attempt is to be told, null where there are no errors. result_id is the id that the result itself
    names; a null segment is no object."""
    rows = items.select("pilot_id", "source_text").join(results.select("pilot_id", "result_id", "segments"), "pilot_id", "left")
    text = lambda s: F.coalesce(s["text_exact"], F.lit(""))
    label = lambda s: F.coalesce(s["label"], F.lit(""))
    name = lambda i, what: F.concat(F.lit("SEGMENT_"), i.cast("string"), F.lit(what))
    each = F.transform(
        "segments",
        lambda s, i: F.when(s.isNull(), F.array(name(i, "_NOT_OBJECT"))).otherwise(
            F.array_compact(
                F.array(
                    F.when(text(s) == "", name(i, "_EMPTY_TEXT")),
                    F.when(~label(s).isin(*LABELS), F.concat(name(i, "_INVALID_LABEL:"), label(s))),
                )
            )
        ),
    )
    back = F.array_join(F.transform(F.filter("segments", lambda s: s.isNotNull()), text), " ")
    other = F.when(~F.coalesce(F.col("result_id") == F.col("pilot_id"), F.lit(False)), "PILOT_ID_MISMATCH")
    none = F.coalesce(F.size("segments") <= 0, F.lit(True))
    uncovered = F.when(tx.squeeze(back) != tx.squeeze(F.col("source_text")), "TEXT_COVERAGE_MISMATCH")
    errors = F.when(none, F.array_compact(F.array(other, F.lit("NO_SEGMENTS")))).otherwise(
        F.concat(F.array_compact(F.array(other)), F.flatten(each), F.array_compact(F.array(uncovered)))
    )
    told = F.concat(F.lit("Correct these errors: "), F.array_join(errors, ", "))
    return rows.select("pilot_id", F.array_join(errors, ";").alias("errors"), F.when(F.size(errors) > 0, told).alias("feedback"))


def display_text(rows: DataFrame, accepted: str = "ACCEPT_CAPTION_CANDIDATE") -> DataFrame:
    """Adds display_text: the caption text in the accepted group, the recognised text in the others."""
    caption, own = F.coalesce("proposal_text", F.lit("")), F.coalesce("text", F.lit(""))
    return rows.withColumn("display_text", F.when(F.col("audit_group") == accepted, caption).otherwise(own))


def reviewed_only(rows: DataFrame, verdict: str = "verdict") -> DataFrame:
    return rows.where(F.length(F.trim(verdict)) > 0)


def join_with_suffixes(left: DataFrame, right: DataFrame, on: str, suffixes: tuple[str, str], how: str = "left") -> DataFrame:
    """Join on one key; other names that both sides have get the suffixes."""
    both = (set(left.columns) & set(right.columns)) - {on}
    named = lambda df, end: df.select(*(F.col(c).alias(c + end if c in both else c) for c in df.columns))
    return named(left, suffixes[0]).join(named(right, suffixes[1]), on, how)


def allowed_flags(flags: Column, allowed: list[str]) -> Column:
    """Flags that are allowed, sorted."""
    return F.array_sort(F.array_intersect(flags, F.array(*map(F.lit, allowed))))


def source_audit(captured: DataFrame) -> DataFrame:
    """captured(video_id, info json, error) -> one row per source: status, title, duration_sec, availability class, error.
    A source whose metadata are missing or no JSON gets a failure row."""
    kinds = "title string, duration double, subtitles map<string,string>, automatic_captions map<string,string>"
    rows = captured.withColumn("i", F.from_json("info", kinds))
    failed = F.col("error").isNotNull() | F.col("info").isNull() | (F.coalesce(F.size("i.subtitles"), F.lit(-1)) < 0) & F.col("i.title").isNull()
    ok = lambda c: F.when(~failed, c)
    return rows.select(
        "video_id",
        F.when(failed, "EXTRACT_FAIL").otherwise("OK").alias("status"),
        ok(F.coalesce("i.title", F.lit(""))).alias("title"),
        ok(F.col("i.duration")).alias("duration_sec"),
        ok(source_class(F.col("i.subtitles"), F.col("i.automatic_captions"))).alias("candidate"),
        F.when(failed, F.coalesce("error", F.lit("no metadata"))).alias("error"),
    )


def stamped(rows: DataFrame, name: str = "created_at") -> DataFrame:
    """Adds the instant of the run in UTC, as ISO text."""
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
    return rows.withColumn(name, F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")))


def readiness(validated: DataFrame) -> DataFrame:
    """One row: blocks, blocks with errors, and whether results are there and none has an error."""
    bad = F.count_if(F.col("errors") != "")
    return validated.agg(F.count(F.lit(1)).alias("blocks"), bad.alias("bad_blocks"), ((F.count(F.lit(1)) > 0) & (bad == 0)).alias("ready"))


def verdict_stats(rows: DataFrame, value: str) -> DataFrame:
    """Count, mean and quantiles of a value by verdict, and how many are below .85."""
    q = lambda p: F.round(F.percentile(value, p), 6)
    return rows.groupBy("verdict").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(value), 6).alias("mean"), q(0.1).alias("p10"), q(0.5).alias("p50"), q(0.9).alias("p90"),
        F.count_if(F.col(value) < 0.85).alias("below_85"),
    )


def source_class(manual: Column, automatic: Column) -> Column:
    """MANUAL_VI, AUTO_VI or NEED_ASR, by the keys of two caption maps."""
    own = lambda m: F.exists(F.map_keys(m), lambda k: (k == "vi") | k.startswith("vi-") | k.startswith("vi."))
    return F.when(F.coalesce(own(manual), F.lit(False)), "MANUAL_VI").when(F.coalesce(own(automatic), F.lit(False)), "AUTO_VI").otherwise("NEED_ASR")
