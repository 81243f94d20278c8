"""Structural checks of a cut manifest and flags on its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from captionloom.params import KEEP

DECISIONS = (*KEEP, "REVIEW", "DROP")


def suspicious_keep(clips: DataFrame) -> DataFrame:
    """Kept clips that miss one of seven limits. A null metric misses none."""
    dur = F.col("raw_end_ms") - F.col("raw_start_ms")
    # fixed values: limits
    odd = (
        (dur < 3000)
        | (dur > 14000)
        | (F.col("word_count") < 3)
        | (F.col("mean_word_probability") < 0.78)
        | (F.col("word_probability_p10") < 0.45)
        | (F.col("max_segment_no_speech_prob") > 0.35)
        | (F.col("median_segment_avg_logprob") < -0.90)
    )
    return clips.where(F.col("decision").isin(*KEEP) & F.coalesce(odd, F.lit(False)))


def invalid_interval(start: str = "raw_start_ms", end: str = "raw_end_ms", cut_start: str = "cut_start_ms", cut_end: str = "cut_end_ms") -> Column:
    null = F.col(start).isNull() | F.col(end).isNull() | F.col(cut_start).isNull() | F.col(cut_end).isNull()
    return null | (F.col(end) <= F.col(start)) | (F.col(cut_end) <= F.col(cut_start)) | (F.col(cut_start) < -0.001)


def duration_mismatch(duration: Column, start: Column, end: Column, tolerance: float = 20.0) -> Column:
    return F.abs(duration - (end - start)) > tolerance


def output_ok(requested_sec: Column, actual_sec: Column, rate: Column, channels: Column) -> Column:
    """Whether a produced file has the requested length, rate and channel."""
    return (F.abs(actual_sec - requested_sec) <= 0.35) & (rate == 22_050) & (channels == 1)


def duplicates(df: DataFrame, ident: str) -> DataFrame:
    """All rows whose id occurs more than once. Ids are counted before they meet their rows, so an id that a third of them has is
    one row of the counts and no group of its own."""
    often = df.groupBy(ident).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col(ident).alias("_id"))
    return df.join(often, F.col(ident).eqNullSafe(F.col("_id")), "left_semi")


def structural_qc(clips: DataFrame, sources: DataFrame, key: str = "video_id") -> DataFrame:
    """One row: counts of each defect, the error codes that follow, and qc_pass. Sources: the expected keys.

    Every defect is first counted by source, where clips, their overlaps and the expected keys meet; one total is taken
    of those counts. An id that is there more than once counts once, with the first of its sources.
    """
    again = clips.where("clip_id is not null").groupBy("clip_id").agg(F.min(key).alias("_again"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    again = again.groupBy("_again").agg(F.count(F.lit(1)).alias("duplicate_ids"))
    w = Window.partitionBy(key).orderBy("raw_start_ms", "raw_end_ms", "clip_id")
    over = F.lag("raw_end_ms").over(w) - F.col("raw_start_ms")
    rows = clips.withColumn("_over", over)
    by_source = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("decision").isin(*DECISIONS)).alias("unknown_decisions"),
        F.count_if(invalid_interval() & (F.col("decision") != "DROP")).alias("invalid_active"),
        F.count_if(invalid_interval() & (F.col("decision") == "DROP")).alias("invalid_drop"),
        F.count_if(F.length(F.trim("text")) == 0).alias("empty_text"),
        F.count_if(F.col("_over") > 50).alias("overlaps"),
        F.count_if(F.col("_over") > 250).alias("severe_overlaps"),
    )
    expected = sources.select(F.col(key).alias("_expected")).distinct()
    by_source = by_source.join(again, F.col(key).eqNullSafe(F.col("_again")), "left").drop("_again")
    both = by_source.join(expected, by_source[key] == expected["_expected"], "full_outer")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    row = both.agg(
        *map(total, ("rows", "duplicate_ids", "unknown_decisions", "invalid_active", "invalid_drop", "empty_text", "overlaps", "severe_overlaps")),
        F.count_if(F.col("rows").isNull()).alias("missing_sources"),
        F.count_if(F.col("_expected").isNull() & F.col(key).isNotNull()).alias("extra_sources"),
    )
    checks = ("duplicate_ids", "unknown_decisions", "invalid_active", "empty_text", "missing_sources", "extra_sources", "severe_overlaps")
    errors = F.array_compact(F.array(*(F.when(F.col(c) > 0, F.upper(F.lit(c))) for c in checks)))
    return row.withColumn("errors", F.array_join(errors, ";")).withColumn("qc_pass", F.size(errors) == 0)


def hours(ms: Column) -> Column:
    """Hours of a number of milliseconds that has halves at most, to six digits, halves up. The rounding is done in whole
    numbers: sums often lie halfway between two last digits, where doubles go either way."""
    n = (2 * ms).cast("long") * 1_000_000 + 3_600_000
    return (n - F.pmod(n, F.lit(7_200_000))) / F.lit(7_200_000) / F.lit(1_000_000)


def source_qc(clips: DataFrame, key: str = "video_id") -> DataFrame:
    """Counts by decision, kept hours and quality quantiles of each source."""
    kept = F.col("decision").isin(*KEEP)
    cut = F.col("cut_end_ms") - F.col("cut_start_ms")
    counts = [F.count_if(F.col("decision") == d).alias(d.lower()) for d in DECISIONS]
    return clips.groupBy(key).agg(
        F.count(F.lit(1)).alias("candidates"),
        *counts,
        hours(F.coalesce(F.sum(F.when(kept, cut)), F.lit(0.0))).alias("keep_hours"),
        F.round(F.percentile(F.when(kept, F.col("quality_score")), 0.1), 6).alias("keep_quality_p10"),
        F.round(F.percentile(F.when(kept, F.col("quality_score")), 0.5), 6).alias("keep_quality_p50"),
    )


def density_flags(rows: DataFrame, seconds: Column, words: Column, segment_tokens: Column, word_tokens: Column) -> DataFrame:
    """Adds tokens_per_sec, token_ratio, low_density and high_ratio. A zero or missing divisor gives null and no flag."""
    rows = rows.withColumn("tokens_per_sec", F.try_divide(words, seconds)).withColumn("token_ratio", F.try_divide(segment_tokens, word_tokens))
    # fixed values: limits
    low, high = F.col("tokens_per_sec") < 0.8, F.col("token_ratio") > 1.8
    return rows.withColumn("low_density", F.coalesce(low, F.lit(False))).withColumn("high_ratio", F.coalesce(high, F.lit(False)))


def acceptance(rows: DataFrame, accepted: Column, key: str = "video_id") -> DataFrame:
    """By source and over all ('(all)'): rows, accepted, and their rate, zero where there are no rows."""
    n, yes = F.count(F.lit(1)), F.coalesce(F.count_if(accepted), F.lit(0))
    out = rows.rollup(key).agg(n.alias("rows"), yes.alias("accepted"))
    rate = F.when(F.col("rows") == 0, 0.0).otherwise(F.round(F.col("accepted") / F.col("rows"), 6))
    return out.select(F.coalesce(key, F.lit("(all)")).alias(key), "rows", "accepted", rate.alias("acceptance_rate"))


def balanced(rows: DataFrame, key: str, each: int, groups: int) -> DataFrame:
    """The counts by key; fails unless there are `groups` keys of `each` rows."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    right = counts.agg((F.count(F.lit(1)) == groups) & (F.coalesce(F.count_if(F.col("rows") != each), F.lit(0)) == 0)).first()[0]
    if not right:
        raise ValueError(f"expected {each} rows for each of {groups} values of {key}")
    return counts


def first_values(rows: DataFrame, columns: list[str], order: str, key: str = "video_id") -> DataFrame:
    """Of each source the first value of each column, in the order, that is not null."""
    return rows.groupBy(key).agg(*(F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns))


def boundary_overlaps(clips: DataFrame, key: str = "video_id", report: float = 50, severe: float = 250) -> DataFrame:
    """Neighbouring clips whose spoken or cut intervals overlap by more than `report`: both overlaps, and which are severe."""
    w = Window.partitionBy(key).orderBy("raw_start_ms", "raw_end_ms", "clip_id")
    raw, cut = F.lag("raw_end_ms").over(w) - F.col("raw_start_ms"), F.lag("cut_end_ms").over(w) - F.col("cut_start_ms")
    out = clips.select(key, F.lag("clip_id").over(w).alias("prev_clip_id"), "clip_id", raw.alias("raw_overlap_ms"), cut.alias("cut_overlap_ms"))
    out = out.where((F.col("raw_overlap_ms") > report) | (F.col("cut_overlap_ms") > report))
    return out.withColumn("severe_raw", F.col("raw_overlap_ms") > severe).withColumn("severe_cut", F.col("cut_overlap_ms") > severe)
