"""Named queries over the standard tables, one for each operator or small plan."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from captionloom import params as P
from captionloom import schemas
from captionloom.functions import text as tx
from captionloom.operators import alignment as al
from captionloom.operators import audit as au
from captionloom.operators import captions as cp
from captionloom.operators import chains as ch
from captionloom.operators import dyadic as dy
from captionloom.operators import merkle as mk
from captionloom.operators import quantiles as qu
from captionloom.operators import qc
from captionloom.operators import sampling as sm
from captionloom.operators import segmentation as sg
from captionloom.operators import timeline as tl
from captionloom.plans import adapters as ad
from captionloom.plans import attempts as at
from captionloom.plans import runstate as rs
from captionloom.work import Work, numbered
from captionloom.sources import readers as rd
from captionloom.sources import sinks as sk
from captionloom.streaming import streams as st
from captionloom.streaming import units as su

Query = Callable[[SparkSession, str], DataFrame]
_found: dict[str, Query] = {}


def query(f: Query) -> Query:
    _found[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_found)


# ---- views


@query
def v_words(spark, sf):
    return ad.words(spark, sf).drop("doc_id")


@query
def v_segments(spark, sf):
    return ad.segments(spark, sf).drop("doc_id")


@query
def v_captions(spark, sf):
    return ad.captions(spark, sf)


# ---- text and predicates


@query
def clean_text(spark, sf):
    t = ad.table(spark, sf, "documents")
    t = t.select("doc_id", tx.clean(F.col("text")).alias("c"))
    return t.select("doc_id", F.md5(F.col("c").cast("binary")).alias("clean_md5"), F.length("c").alias("clean_chars"))


@query
def unescaped_pages(spark, sf):
    p = ad.table(spark, sf, "pages").select("page_id", tx.clean(F.col("html")).alias("c"))
    return p.select("page_id", F.md5(F.col("c").cast("binary")).alias("clean_md5"), F.length("c").alias("clean_chars"))


@query
def lexical_tokens(spark, sf):
    t = ad.table(spark, sf, "conversations").withColumn("form", tx.lexical(F.col("text")))
    return t.select("conv_id", "turn", "form", F.size(tx.lexical_tokens(F.col("text"))).alias("n_tokens"), F.size(tx.tokens(F.col("text"))).alias("n_found"))


@query
def entity_forms(spark, sf):
    """Normal forms of turns that are written with named, decimal and hexadecimal references: those of the turns themselves."""
    t = F.col("text")
    for char, reference in (("&", "&amp;"), (" ", "&nbsp;"), ("'", "&#x27;"), (".", "&#46;"), ("é", "&eacute;"), ("ü", "&uuml"), (",", "&comma;")):
        t = F.replace(t, F.lit(char), F.lit(reference))
    return ad.table(spark, sf, "conversations").select("conv_id", "turn", tx.lexical(t).alias("form"))


@query
def parsed_numbers(spark, sf):
    """Values of events as text, some of which are no numbers, and what is left of them as numbers."""
    k = F.col("event_id")
    v = F.when(k % 7 == 0, "n/a").when(k % 11 == 0, "NaN").when(k % 13 == 0, "").when(k % 17 == 0, " 12.5 ").when(k % 19 == 0, "1e3").otherwise(F.col("value").cast("string"))
    e = schemas.numbers(schemas.require_columns(ad.table(spark, sf, "events"), "event_id", "event_type", "value").withColumn("value", v), "value")
    return e.groupBy("event_type").agg(F.count("value").alias("numbers"), F.count_if(F.col("value").isNull()).alias("none"), F.round(F.sum("value"), 4).alias("total"))


@query
def terminal_flags(spark, sf):
    w = ad.words(spark, sf)
    return w.groupBy("video_id").agg(F.count_if(tx.is_terminal(F.col("word"))).alias("terminal"), F.count_if(tx.is_clause(F.col("word"))).alias("clause"), F.count(F.lit(1)).alias("words"))


@query
def piece_hints(spark, sf):
    p = ad.pieces(spark, sf)
    rep, crowd = tx.repeated_token(F.col("text_exact")), tx.crowded_initials(F.col("text_exact"))
    return p.select("piece_id", "needs_split_hint", "tiny_hint", rep.alias("repeat_hint"), crowd.alias("crowding_hint"))


@query
def hms_labels(spark, sf):
    s = ad.segments(spark, sf)
    return s.select("video_id", "segment_id", tx.hms(F.col("start_ms") / 1000.0).alias("start_label"), tx.hms(F.col("end_ms") / 1000.0).alias("end_label"))


@query
def mojibake_report(spark, sf):
    d = ad.table(spark, sf, "documents")
    return d.groupBy("lang").agg(F.sum(tx.mojibake_count(F.col("text"))).alias("markers"), F.count_if(F.col("text").rlike("[ăâđêôơư]")).alias("native"))


@query
def output_verification(spark, sf):
    """Line items as produced files: requested and actual seconds, and by rule some files of another rate or with two channels."""
    x = ad.table(spark, sf, "lineitem")
    rate, channels = F.when(F.col("l_linenumber") % 4 == 0, 44_100).otherwise(22_050), F.when(F.col("l_partkey") % 5 == 0, 2).otherwise(1)
    ok = qc.output_ok(F.col("l_quantity"), F.col("l_quantity") + F.col("l_discount") * 5, rate, channels)
    return x.groupBy("l_returnflag").agg(F.count_if(ok).alias("verified"), F.count_if(~ok).alias("failed"))


@query
def task_estimates(spark, sf):
    """Units of captions in which each tenth event is blank: such events have gone, but stand between the others' indices."""
    text = F.when(F.col("event_index") % 10 == 9, " \n").otherwise(F.col("text"))
    u = cp.sentence_units(ad.captions(spark, sf).withColumn("text", text).where("trim(text, ' \n') <> ''"))
    n = F.greatest(F.lit(1), F.bround((F.col("end_ms") - F.col("start_ms")) / 8000.0, 0).cast("int"))
    return u.select(
        "video_id", "unit_no", F.round((F.col("end_ms") - F.col("start_ms")) / 1000.0, 3).alias("unit_duration_sec"),
        (F.col("last_event_index") - F.col("first_event_index") + 1).alias("events_in_unit"), "n_events", n.alias("target_segments"),
    )


# ---- windows and interval features


@query
def word_gaps(spark, sf):
    w = tl.word_gaps(ad.words(spark, sf))
    return w.select("video_id", "word_index", "gap_before_ms", "gap_after_ms", "gap_global_ms", "segment_boundary", "cross_segment")


@query
def pause_percent_rank(spark, sf):
    w = tl.percent_rank_average(tl.word_gaps(ad.words(spark, sf)), "gap_global_ms", "video_id")
    return w.select("video_id", "word_index", F.round("gap_global_ms_percentile", 9).alias("pause_percentile"))


@query
def event_gaps(spark, sf):
    w = Window.partitionBy("video_id").orderBy("start_ms", "event_index")
    return ad.captions(spark, sf).select("video_id", "event_index", (F.lead("start_ms").over(w) - F.col("end_ms")).alias("gap_after_ms"))


@query
def gap_histogram(spark, sf):
    e = event_gaps(spark, sf)
    # fixed values: thresholds in milliseconds
    return e.agg(*(F.count_if(F.col("gap_after_ms") >= t).alias(f"ge_{t}") for t in (-450, -300, 0, 200, 300, 400, 500, 700, 1000, 1500)))


@query
def overlap_audit(spark, sf):
    return tl.adjacent_overlaps(ad.captions(spark, sf), "video_id", "event_index", "start_ms", "end_ms", 50, 250)


@query
def user_overlaps(spark, sf):
    return tl.adjacent_overlaps(ad.intervals(spark, sf), "user_id", "event_id", "start_ms", "end_ms", 50, 250)


def _repeats(rows, key, order):
    """By source: rows whose normal form is that of the row before, and the share of different forms."""
    w = Window.partitionBy(key).orderBy(order)
    rows = rows.withColumn("norm", tx.lexical(F.col("text"))).withColumn("dup", F.coalesce(F.col("norm") == F.lag("norm").over(w), F.lit(False)))
    return rows.groupBy(key).agg(F.count_if("dup").alias("consecutive"), F.round(F.countDistinct("norm") / F.count(F.lit(1)), 9).alias("unique_ratio"))


@query
def consecutive_dups(spark, sf):
    return _repeats(ad.table(spark, sf, "conversations"), "conv_id", "turn")


@query
def caption_repeats(spark, sf):
    return _repeats(ad.captions(spark, sf), "video_id", "event_index")


@query
def long_pauses(spark, sf):
    w = tl.word_gaps(ad.words(spark, sf)).where("gap_after_ms >= 300")
    return w.select("video_id", "word_index", "gap_after_ms").orderBy(F.desc("gap_after_ms"), "video_id", "word_index")


@query
def interval_overlaps(spark, sf):
    """Intervals of users as clips with padding."""
    i = ad.intervals(spark, sf)
    i = i.select("user_id", F.col("event_id").alias("clip_id"), F.col("start_ms").alias("raw_start_ms"), F.col("end_ms").alias("raw_end_ms"))
    i = i.withColumn("cut_start_ms", F.col("raw_start_ms") - 120).withColumn("cut_end_ms", F.col("raw_end_ms") + 150)
    return qc.boundary_overlaps(i, "user_id")


# ---- units and pieces


@query
def sentence_units(spark, sf):
    return ad.units(spark, sf)


@query
def lossless_pieces(spark, sf):
    return ad.pieces(spark, sf)


@query
def coverage_check(spark, sf):
    u = ad.units(spark, sf)
    return cp.coverage(u, cp.pieces(u)).groupBy("video_id").agg(F.count(F.lit(1)).alias("parents"), F.count_if("covered").alias("covered"))


@query
def caption_qc_summary(spark, sf):
    work = Work(spark, "caption_qc")
    u = ad.units(spark, sf).select("video_id", "terminated", (F.col("end_ms") - F.col("start_ms")).alias("dur"), F.length("text").alias("chars"))
    u = work.save(u, "units")
    # fixed values: percents and thresholds
    percents = (50, 75, 90, 95, 99)
    found = qu.exact_quantiles(u, ["dur", "chars"], [p / 100 for p in percents], work)
    q = lambda c: [F.round(F.lit(v).cast("double"), 6).alias(f"{c}_p{p}") for p, v in zip(percents, found[c], strict=True)]
    return u.agg(
        F.count(F.lit(1)).alias("units"), F.countDistinct("video_id").alias("sources"), F.count_if(~F.col("terminated")).alias("open_tails"), *q("dur"), *q("chars"),
        *(F.count_if(F.col("chars") > t).alias(f"chars_gt_{t}") for t in (300, 500, 800, 1200)),
        *(F.count_if(F.col("dur") > 1000 * t).alias(f"dur_gt_{t}") for t in (15, 25, 40)),
    )


@query
def lineitem_quantiles(spark, sf):
    """Quantiles of columns with few and with many different values."""
    columns, shares = ["l_quantity", "l_extendedprice", "l_orderkey"], (0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0)
    found = qu.exact_quantiles(ad.table(spark, sf, "lineitem"), columns, shares, Work(spark, "quantiles"))
    rows = [(c, p, v) for c in columns for p, v in zip(shares, found[c], strict=True)]
    return spark.createDataFrame(rows, "name string, share double, v double").select("name", "share", F.round("v", 6).alias("value"))


@query
def top_long_units(spark, sf):
    u = ad.units(spark, sf).select("video_id", "unit_no", F.length("text").alias("chars"), (F.col("end_ms") - F.col("start_ms")).alias("dur_ms"))
    return u.orderBy(F.desc("chars"), F.desc("dur_ms"), "video_id", "unit_no").limit(200)


# ---- joins


def _events(spark, sf):
    c = ad.captions(spark, sf)
    return c.select("video_id", F.col("event_index").alias("event_index"), F.col("start_ms").alias("event_start"), F.col("end_ms").alias("event_end"), F.col("text").alias("event_text"))


@query
def near_events(spark, sf):
    sf = ad.timed(spark, sf)
    s = ad.segments(spark, sf).select("video_id", "segment_id", "start_ms", "end_ms")
    near = tl.dealt_interval_join(s, _events(spark, sf), "video_id", ("start_ms", "end_ms"), ("event_start", "event_end"), 3000, True)
    return near.groupBy("video_id", "segment_id").agg(F.count(F.lit(1)).alias("events"), F.min("event_index").alias("first_event"), F.max("event_index").alias("last_event"))


@query
def long_interval_join(spark, sf):
    """Events as intervals of a user, each 97th of them some days long, and the events that begin or end within or span them."""
    i = ad.intervals(spark, sf)
    end = F.when(F.col("event_id") % 97 == 0, F.col("start_ms") + (F.col("end_ms") - F.col("start_ms")) * 10_000).otherwise(F.col("end_ms"))
    long = i.select("user_id", "event_id", F.col("start_ms").alias("from_ms"), end.alias("to_ms"))
    short = i.select("user_id", F.col("event_id").alias("other_id"), "start_ms", "end_ms")
    near = dy.dyadic_join(long, short, "user_id", ("from_ms", "to_ms"), ("start_ms", "end_ms"), 3000, True)
    return near.groupBy("user_id", "event_id").agg(F.count(F.lit(1)).alias("events"), F.min("other_id").alias("first_event"), F.max("other_id").alias("last_event"))


@query
def overlap_text(spark, sf):
    return _overlap_text(spark, ad.timed(spark, sf))


def _overlap_text(spark, sf):
    s = ad.segments(spark, sf).select("video_id", "segment_id", "start_ms", "end_ms")
    over = tl.dealt_interval_join(s, _events(spark, sf), "video_id", ("start_ms", "end_ms"), ("event_start", "event_end"))
    ordered = F.array_sort(F.collect_list(F.struct("event_start", "event_index", "event_text")))
    return over.groupBy("video_id", "segment_id").agg(F.array_join(F.transform(ordered, lambda x: x["event_text"]), " ").alias("caption_text"))


@query
def overlap_weighted_mean(spark, sf):
    sf = ad.timed(spark, sf)
    units = ad.units(spark, sf).select("video_id", F.concat_ws("_", "video_id", F.col("unit_no").cast("string")).alias("unit_id"), "start_ms", "end_ms")
    out = tl.overlap_mean(units, ad.consensus(spark, sf), "video_id", "unit_id", "token_similarity")
    return out.select("unit_id", F.round("mean", 6).alias("consensus"))


@query
def segment_quality(spark, sf):
    sf = ad.timed(spark, sf)
    w = ad.words(spark, sf).withColumn("clip_id", F.concat_ws("_", "video_id", F.floor(F.col("word_index") / 33).cast("string")))
    return sg.segment_quality(w, ad.segments(spark, sf), "video_id", "clip_id")


@query
def missing_extra_keys(spark, sf):
    return au.key_difference(ad.table(spark, sf, "documents"), ad.table(spark, sf, "labels"), "doc_id")


@query
def one_to_one_audit(spark, sf):
    o = ad.table(spark, sf, "nation").select("n_nationkey", "n_name")
    r = ad.table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers")).withColumnRenamed("c_nationkey", "n_nationkey")
    return au.one_to_one(r, o, "n_nationkey")


@query
def aligned_union(spark, sf):
    a = ad.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    b = ad.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return au.aligned_union(a, b)


# ---- consensus


@query
def bucket_pairs(spark, sf):
    sf = ad.timed(spark, sf)
    return tl.bucket_pairs(ad.segments(spark, sf), ad.captions(spark, sf))


@query
def quick_ratio_buckets(spark, sf):
    c = ad.consensus(spark, sf, exact=False)
    return c.select("video_id", "bucket", F.round("token_similarity", 9).alias("similarity"), tl.match_band(F.col("token_similarity")).alias("match_band"))


@query
def bucket_consensus(spark, sf):
    c = ad.consensus(spark, sf)
    return c.select("video_id", "bucket", "token_similarity", tl.match_band(F.col("token_similarity")).alias("match_band"))


@query
def lowest_20_buckets(spark, sf):
    c = ad.consensus(spark, sf).select("video_id", "bucket", F.round("token_similarity", 9).alias("similarity"))
    return c.orderBy("similarity", "video_id", "bucket").limit(20)


@query
def highest_20_buckets(spark, sf):
    c = ad.consensus(spark, sf).select("video_id", "bucket", F.round("token_similarity", 9).alias("similarity"))
    return c.orderBy(F.desc("similarity"), "video_id", "bucket").limit(20)


@query
def segment_overlap_consensus(spark, sf):
    sf = ad.timed(spark, sf)
    return al.overlap_consensus(ad.segments(spark, sf), _events(spark, sf))


@query
def density_flags(spark, sf):
    sf = ad.timed(spark, sf)
    s = tl.grouped_left_join(ad.segments(spark, sf), _overlap_text(spark, sf), ["video_id", "segment_id"])
    n = lambda c: F.size(tx.tokens(F.coalesce(c, F.lit(""))))
    rows = qc.density_flags(s, (F.col("end_ms") - F.col("start_ms")) / 1000.0, n("text"), n("caption_text"), n("text"))
    return rows.select("video_id", "segment_id", F.round("tokens_per_sec", 6).alias("tokens_per_sec"), F.round("token_ratio", 6).alias("token_ratio"), "low_density", "high_ratio")


@query
def source_trust(spark, sf):
    c = ad.consensus(spark, sf).groupBy("video_id").agg(F.round(F.avg("token_similarity"), 6).alias("mean_similarity"))
    return c.withColumn("trusted", F.col("mean_similarity") >= P.CLIPS.source_trust)


# ---- segmentation


@query
def boundary_scores(spark, sf):
    return ad.scored(spark, sf).select("video_id", "word_no", "boundary_score", "boundary_basis")


@query
def best_end(spark, sf):
    return sg.best_ends(ad.scored(spark, sf))


@query
def clip_spans(spark, sf):
    return sg.clip_spans(ad.scored(spark, sf))


@query
def clip_spans_linked(spark, sf):
    """The clips of clip_spans for sources of any length: those of more words than a block has are linked by block, with pointer
    jumping between blocks; a shorter one is a block of its own, which no chain leaves, and stays where it is."""
    return _linked_spans(spark, ad.timed(spark, sf), Work(spark, "linked"))


def _linked_spans(spark, sf, work, block=ch.BLOCK):
    long = F.size("ws") > block
    linked = ch.clip_spans_linked(ad.scored(spark, sf, long), work)
    return sg.clip_spans(ad.scored(spark, sf, ~long)).unionByName(linked)


@query
def clip_candidates(spark, sf):
    m = ad.manifest(spark, sf)
    r = lambda c: F.round(c, 6).alias(c)
    return m.select(
        "clip_id", "raw_start_ms", "raw_end_ms", "cut_start_ms", "cut_end_ms", "word_count", "text", "boundary_basis", "boundary_score", "gap_before_ms", "gap_after_ms",
        r("mean_word_probability"), r("word_probability_p10"), r("median_segment_avg_logprob"), r("max_segment_no_speech_prob"), r("clip_consensus_mean"), "decision", "decision_reason",
        F.round(F.col("quality_score") + 1e-7, 4).alias("quality_score"),
    )


@query
def decision_summary(spark, sf):
    m = ad.manifest(spark, sf)
    hours = qc.hours(F.sum(F.col("cut_end_ms") - F.col("cut_start_ms")))
    return m.groupBy("video_id", "decision").agg(F.count(F.lit(1)).alias("clips"), hours.alias("hours"), F.sum("word_count").alias("words"))


# ---- checks and samples


@query
def suspicious_keep(spark, sf):
    """Clips whose probabilities were measured anew after the decision, some of them lower: kept ones that miss a limit now."""
    m = ad.manifest(spark, sf)
    again = F.when(F.substring("clip_id", -1, 1).isin("3", "7"), F.col("mean_word_probability") - 0.3).otherwise(F.col("mean_word_probability"))
    return qc.suspicious_keep(m.withColumn("mean_word_probability", again)).select("clip_id", "decision", "word_count", "raw_start_ms", "raw_end_ms")


@query
def structural_qc(spark, sf):
    sources = ad.table(spark, sf, "documents").select(F.concat(F.lit("d"), F.col("doc_id")).alias("video_id"))
    return qc.structural_qc(ad.manifest(spark, sf), sources)


@query
def invalid_intervals(spark, sf):
    i = ad.intervals(spark, sf).withColumn("bad", F.col("end_ms") <= F.col("start_ms"))
    off = qc.duration_mismatch(F.col("value") * 1000, F.col("start_ms"), F.col("end_ms"), 0.5)
    return i.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"), F.count_if("bad").alias("invalid"), F.count_if(off).alias("mismatched"))


@query
def duplicate_texts(spark, sf):
    d = ad.table(spark, sf, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))
    return qc.duplicates(d, "digest")


@query
def source_qc_quantiles(spark, sf):
    return qc.source_qc(ad.manifest(spark, sf))


@query
def balanced_pilot(spark, sf):
    return sm.balanced_pilot(_graded(spark, sf)).select("video_id", "clip_id", "pilot_reason", "place")


@query
def quota_pilot(spark, sf):
    work = Work(spark, "quota")
    return sm.quota_pilot(work.save(_graded(spark, sf), "graded"), 160, work).select("video_id", "clip_id", "pilot_reason", "place")


@query
def listening_queue(spark, sf):
    return sm.listening_queue(sm.balanced_pilot(_graded(spark, sf)), Work(spark, "listening")).select("queue_no", "review_priority", "clip_id", "pilot_reason")


@query
def review_queue(spark, sf):
    return sm.review_queue(_graded(spark, sf), Work(spark, "review")).select("queue_no", "clip_id", "quality_score")


@query
def queue_page(spark, sf):
    return sm.page(review_queue(spark, sf), 20, 50)


@query
def balanced_counts(spark, sf):
    """Fails unless every region has five nations."""
    return qc.balanced(ad.table(spark, sf, "nation"), "n_regionkey", 5, 5)


@query
def first_values(spark, sf):
    u = ad.units(spark, sf).select(
        "video_id", "unit_no", F.when(F.col("unit_no") % 3 == 0, F.col("n_events")).alias("n_events"), F.when(F.col("terminated"), F.col("end_ms")).alias("end_ms")
    )
    return qc.first_values(u, ["n_events", "end_ms"], "unit_no")


def _graded(spark, sf):
    """Units as graded clips, by rules on their numbers: the sampling operators need all classes."""
    u = ad.units(spark, sf)
    n, k = F.col("unit_no"), F.substring("video_id", 2, 18).cast("long")
    grade = F.pmod(n * 7 + k, F.lit(5))
    return u.select(
        "video_id", F.concat_ws("_", "video_id", n.cast("string")).alias("clip_id"), n.alias("clip_no"), F.col("start_ms").alias("raw_start_ms"),
        F.col("start_ms").alias("cut_start_ms"), F.col("end_ms").alias("cut_end_ms"), (F.pmod(n * 31 + k * 7, F.lit(97)) / 100.0).alias("quality_score"),
        F.pmod(n * 13, F.lit(9)).alias("boundary_score"),
        F.when(grade < 2, "KEEP_AUTO").when(grade == 2, "KEEP_WHISPER_PRIMARY").when(grade == 3, "REVIEW").otherwise("DROP").alias("decision"),
    )


@query
def middle_pick(spark, sf):
    return sm.middle_of(_graded(spark, sf), ["quality_score", "raw_start_ms", "clip_no"]).select("video_id", "clip_id")


@query
def group_sample(spark, sf):
    work = Work(spark, "group_sample")
    audited = work.save(_audited(spark, sf), "audited")
    return sm.group_sample(audited, 5, work).select("audit_group", "sample_order", "video_id", "clip_id")


@query
def keep_auto_queue(spark, sf):
    """Trusted clips of a pilot in the order in which they are heard."""
    work = Work(spark, "keep_auto")
    picked = sm.quota_pilot(work.save(_graded(spark, sf), "graded"), 160, work)
    return sm.keep_auto_queue(picked, work).select("queue_no", "review_priority", "clip_id", "pilot_reason")


@query
def semantic_pilot(spark, sf):
    p = ad.pieces(spark, sf).withColumn("risk_hint", tx.repeated_token(F.col("text_exact")) | tx.crowded_initials(F.col("text_exact")))
    # fixed values: seed, and pieces of each bucket per source
    quota = {"LONG_SPLIT": 4, "TINY_FRAGMENT": 4, "REPEAT_OR_CROWDING": 2, "NORMAL_CONTROL": 4}
    return sm.semantic_pilot(p, 260103, quota, ["unit_no", "piece_no"]).select("piece_id", "bucket", "bucket_place", "prev_text", "next_text")


# ---- packs


def _pack_items(spark, sf):
    """Pieces to be packed. A source is fifty documents in a row, as one alone fills no pack."""
    doc = F.substring("video_id", 2, 18).cast("long")
    return ad.pieces(spark, sf).select(
        F.concat(F.lit("g"), F.floor(doc / 50).cast("string")).alias("video_id"), doc.alias("doc_no"), "unit_no", "piece_no", "piece_id", "text_exact", "char_count"
    )


def _packed(spark, sf, budget: P.Budget):
    return cp.pack_by_budget(Work(spark, "packs").save(_pack_items(spark, sf), "items"), budget, ["doc_no", "unit_no", "piece_no"], "char_count")


@query
def review_packs_linked(spark, sf):
    """The packs of review_packs without a walk over a source of more items than a block."""
    work = Work(spark, "packs_linked")
    # the order of items deals them by ranges, for which they are looked at twice
    items = work.save(_pack_items(spark, sf).select("video_id", "doc_no", "unit_no", "piece_no", "piece_id", "char_count"), "items")
    packed = ch.pack_by_length(items, P.REVIEW_PACKS, ["doc_no", "unit_no", "piece_no"], "char_count", work)
    return packed.select("video_id", "piece_id", "pack_no")


@query
def review_parts(spark, sf):
    return _packed(spark, sf, P.REVIEW_PARTS).select("video_id", "piece_id", "pack_no")


@query
def semantic_tasks(spark, sf):
    return _packed(spark, sf, P.TASKS_V2).select("video_id", "piece_id", "pack_no")


@query
def semantic_tasks_v1(spark, sf):
    return _packed(spark, sf, P.TASKS_V1).select("video_id", "piece_id", "pack_no")


@query
def review_packs(spark, sf):
    return _packed(spark, sf, P.REVIEW_PACKS).select("video_id", "piece_id", "pack_no")


@query
def pack_index(spark, sf):
    return cp.pack_index(_packed(spark, sf, P.REVIEW_PACKS), "piece_id", ["doc_no", "unit_no", "piece_no"], "char_count", Work(spark, "pack_index"))


@query
def review_bodies(spark, sf):
    b = sk.review_texts(_packed(spark, sf, P.REVIEW_PARTS), ["doc_no", "unit_no", "piece_no"], "text_exact")
    return b.select("video_id", "pack_no", F.length("body").alias("chars"), F.md5(F.col("body").cast("binary")).alias("digest"))


@query
def context_windows(spark, sf):
    p = cp.context_windows(ad.pieces(spark, sf).select("video_id", "unit_no", "piece_no", "piece_id", "text_exact"), ["unit_no", "piece_no"], "piece_id", "text_exact")
    ids = lambda c: F.array_join(F.transform(c, lambda x: x["id"]), ",").alias(c)
    return p.select("piece_id", ids("prev_context"), ids("next_context"))


# ---- alignment and audit


def _clips(spark, sf):
    """Segments as clips of their own text."""
    s = ad.segments(spark, sf)
    return s.select("video_id", F.concat_ws("_", "video_id", F.col("segment_id").cast("string")).alias("clip_id"), F.col("start_ms").alias("raw_start_ms"), F.col("end_ms").alias("raw_end_ms"), "text")


def _ordered_events(spark, sf):
    return _events(spark, sf).select("video_id", "event_start", "event_end", "event_index", "event_text")


@query
def sentence_alignment(spark, sf):
    sf = ad.timed(spark, sf)
    near = tl.dealt_interval_lists(_clips(spark, sf), _ordered_events(spark, sf), "video_id", "clip_id", ("raw_start_ms", "raw_end_ms"), ("event_start", "event_end"), "events", 6000, True)
    return al.sentence_alignment(near.withColumn("window_text", F.array_join("events.event_text", " ")))


@query
def token_subsequence(spark, sf):
    sf = ad.timed(spark, sf)
    c = ad.caption_windows(_clips(spark, sf), ad.captions(spark, sf), 4000)
    c = c.select("clip_id", tx.tokens(F.col("text")).alias("w"), tx.tokens(F.coalesce("window_text", F.lit(""))).alias("c"))
    return al.token_subsequence_by_clip(c)


@query
def event_run_match(spark, sf):
    sf = ad.timed(spark, sf)
    clips = _clips(spark, sf).withColumn("form", tx.lexical(F.col("text"))).drop("text")
    events = _ordered_events(spark, sf).withColumn("event_form", tx.lexical(F.col("event_text")))
    near = tl.dealt_interval_lists(clips, events, "video_id", "clip_id", ("raw_start_ms", "raw_end_ms"), ("event_start", "event_end"), "events", 3000, True)
    return al.event_run_match_by_clip(near)


def _verdicts(spark, sf):
    q, t = F.col("quality") == 1, F.col("toxic") == 1
    v = F.when(q & ~t, "GOOD").when(~q & ~t, "BAD_TEXT").when(q & t, "BAD_BOUNDARY").otherwise("BAD_BOTH")
    return ad.table(spark, sf, "labels").select("doc_id", v.alias("verdict"))


@query
def reviewed_verdicts(spark, sf):
    d = ad.table(spark, sf, "documents").select("doc_id").join(_verdicts(spark, sf), "doc_id", "left")
    done = au.reviewed_only(d.withColumn("verdict", F.coalesce("verdict", F.lit(" "))))
    return done.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


@query
def suffix_join(spark, sf):
    d, p = ad.table(spark, sf, "documents"), _verdicts(spark, sf)
    left = d.select("doc_id", F.col("n_chars").alias("size"), "lang")
    right = p.select("doc_id", F.length("verdict").alias("size"), "verdict")
    return au.join_with_suffixes(left, right, "doc_id", ("_text", "_verdict"))


@query
def verdict_flags(spark, sf):
    """Flags of a document by rules on its numbers, those that are allowed, sorted."""
    n = F.col("n_chars")
    flags = F.array_compact(
        F.array(F.when(n % 2 == 0, "noise_or_music"), F.when(n % 3 == 0, "clipped_start"), F.when(n % 5 == 0, "other"), F.when(n % 7 == 0, "clipped_end"))
    )
    allowed = ["clipped_start", "clipped_end", "mid_phrase_cut", "too_much_silence", "noise_or_music", "speaker_issue"]
    return ad.table(spark, sf, "documents").select("doc_id", F.array_join(au.allowed_flags(flags, allowed), ",").alias("flags"))


@query
def verdict_stats(spark, sf):
    d = ad.table(spark, sf, "documents").select("doc_id", ((F.col("n_chars") % 100) / 100.0).alias("similarity"))
    return au.verdict_stats(_verdicts(spark, sf).join(d, "doc_id"), "similarity")


@query
def progress_rollup(spark, sf):
    d = ad.table(spark, sf, "documents").select("doc_id", "lang").join(_verdicts(spark, sf), "doc_id", "left")
    out = d.rollup("lang").agg(
        F.count(F.lit(1)).alias("total"), F.count("verdict").alias("reviewed"), *(F.count_if(F.col("verdict") == v).alias(v.lower()) for v in ("GOOD", "BAD_TEXT", "BAD_BOUNDARY", "BAD_BOTH"))
    )
    return out.withColumn("remaining", F.col("total") - F.col("reviewed")).withColumn("lang", F.coalesce("lang", F.lit("(all)")))


def _audited(spark, sf):
    g = _graded(spark, sf)
    # a rule in place of a listener's or the aligner's decision
    a = g.where("decision = 'KEEP_AUTO'").select(
        "clip_id", F.when(F.col("clip_no") % 3 == 0, "ACCEPT_CAPTION").otherwise("REVIEW_ALIGNMENT").alias("alignment_decision"),
        F.lit("rule").alias("alignment_reason"), F.lit("").alias("proposal_text"), (F.col("clip_no") % 10 / 10.0).alias("proposal_similarity"),
    )
    return au.keep_audit(g, a)


@query
def keep_audit(spark, sf):
    return _audited(spark, sf).select("clip_id", "audit_route", "audit_decision", "alignment_decision", "proposal_similarity")


@query
def acceptance_rate(spark, sf):
    return qc.acceptance(_audited(spark, sf).where("decision = 'KEEP_AUTO'"), F.col("audit_decision") == "ACCEPT_CAPTION_CANDIDATE")


@query
def display_text(spark, sf):
    u = ad.units(spark, sf)
    group = F.when(F.col("unit_no") % 2 == 0, "ACCEPT_CAPTION_CANDIDATE").otherwise("REVIEW_ALIGNMENT")
    u = u.select("video_id", "unit_no", "text", F.when(F.col("unit_no") % 6 != 0, F.reverse("text")).alias("proposal_text"), group.alias("audit_group"))
    return au.display_text(u).select("video_id", "unit_no", "display_text")


@query
def source_audit(spark, sf):
    """Captured metadata of documents, by rules: caption maps of three kinds, and some that failed."""
    d, k = ad.table(spark, sf, "documents"), F.col("doc_id") % 5
    one = lambda key: F.create_map(F.lit(key), F.lit("x"))
    none = F.create_map().cast("map<string,string>")
    info = F.struct(
        F.col("source").alias("title"),
        (F.col("n_chars") / 2).alias("duration"),
        F.when(k == 0, one("vi")).when(k == 1, one("vi-VN")).otherwise(none).alias("subtitles"),
        F.when(k == 2, one("vi.orig")).when(k == 3, one("video")).otherwise(none).alias("automatic_captions"),
    )
    failed = F.col("doc_id") % 7 == 3
    return au.source_audit(d.select(F.concat(F.lit("d"), "doc_id").alias("video_id"), F.when(~failed, F.to_json(info)).alias("info"), F.when(failed, "timed out").alias("error")))


@query
def audit_rollup(spark, sf):
    return _audited(spark, sf).groupBy("video_id", "decision", "audit_route", "audit_decision").agg(F.count(F.lit(1)).alias("clips"))


def _validated(spark, sf):
    """Units as blocks; results from their pieces, some spoiled by rule: wrong labels, lost text, missing and extra blocks."""
    u = ad.units(spark, sf).select("video_id", "unit_no", F.concat_ws("_", "video_id", F.col("unit_no").cast("string")).alias("block_id"), F.col("text").alias("source_text"))
    p = cp.pieces(ad.units(spark, sf)).withColumn("block_id", F.concat_ws("_", "video_id", F.col("unit_no").cast("string")))
    label = F.when((F.col("unit_no") % 11 == 0) & (F.col("piece_no") == 1), "NOT_A_LABEL").otherwise("KEEP_CANDIDATE")
    kept = p.where("not (unit_no % 7 = 0 and piece_no = 1)")
    parts = F.array_sort(F.collect_list(F.struct("piece_no", F.col("text_exact"), label.alias("label"))))
    r = kept.groupBy("block_id", "unit_no").agg(F.transform(parts, lambda x: F.struct(x["text_exact"], x["label"])).alias("segments"))
    r = r.where("unit_no % 13 <> 0").select(F.when(F.col("unit_no") % 17 == 0, F.concat("block_id", F.lit("_x"))).otherwise(F.col("block_id")).alias("block_id"), F.lit(1).alias("result_no"), "segments")
    return au.validate_results(u.select("block_id", "source_text"), r)


@query
def validate_results(spark, sf):
    return _validated(spark, sf)


@query
def readiness(spark, sf):
    return au.readiness(_validated(spark, sf))


@query
def item_validation(spark, sf):
    """Units as items, their pieces as results, some spoiled by rule."""
    u = ad.units(spark, sf)
    ident = F.concat_ws("_", "video_id", F.col("unit_no").cast("string"))
    items = u.where("unit_no % 19 <> 0").select(ident.alias("pilot_id"), F.col("text").alias("source_text"))
    n, k = F.col("unit_no"), F.col("piece_no")
    text = F.when((n % 5 == 0) & (k == 1), "").otherwise(F.col("text_exact"))
    label = F.when((n % 11 == 0) & (k == 1), "NOT_A_LABEL").otherwise("KEEP_CANDIDATE")
    one = F.when((n % 7 == 0) & (k == 2), F.lit(None)).otherwise(F.struct(text.alias("text_exact"), label.alias("label")))
    p = cp.pieces(u).where("unit_no % 13 <> 0").select(ident.alias("pilot_id"), "unit_no", F.struct("piece_no", one.alias("s")).alias("s"))
    r = p.groupBy("pilot_id", "unit_no").agg(F.transform(F.array_sort(F.collect_list("s")), lambda x: x["s"]).alias("segments"))
    return au.validate_items(items, r.withColumn("result_id", F.when(n % 17 != 0, F.col("pilot_id")).otherwise(F.lit("other"))))


# ---- sources and sinks


@query
def caption_scan(spark, sf):
    """Captions as JSON3 documents, with an event without text before each caption, parsed again."""
    c = ad.captions(spark, sf)
    seg = lambda t: F.struct(t.alias("utf8"))
    event = F.struct(
        F.col("start_ms").cast("double").alias("tStartMs"),
        (F.col("end_ms") - F.col("start_ms")).cast("double").alias("dDurationMs"),
        F.array(seg(F.substring("text", 1, 3)), seg(F.expr("substring(text, 4)"))).alias("segs"),
    )
    blank = F.struct(F.col("start_ms").cast("double").alias("tStartMs"), F.lit(0.0).alias("dDurationMs"), F.array(seg(F.lit(" \n"))).alias("segs"))
    ordered = F.array_sort(F.collect_list(F.struct("event_index", blank.alias("a"), event.alias("b"))))
    docs = c.groupBy("video_id").agg(F.to_json(F.struct(F.flatten(F.transform(ordered, lambda x: F.array(x["a"], x["b"]))).alias("events"))).alias("content"))
    e = rd.caption_events(docs)
    return e.select("video_id", "event_index", "start_sec", "end_sec", F.round("duration_sec", 3).alias("duration_sec"), "text", "ends_terminal_punctuation")


@query
def csv_round_trip(spark, sf):
    d, path = ad.table(spark, sf, "documents").select("doc_id", "lang", "text"), f"{Work(spark, 'csv').path}/documents"
    sk.write_csv(d, path)
    back = rd.csv_table(spark, path, "doc_id long, lang string, text string")
    return back.select("doc_id", "lang", F.md5(F.col("text").cast("binary")).alias("digest"))


@query
def csv_rescue(spark, sf):
    """Documents as CSV records, some with a wrong id, a field too many or too few: the rows, and the records that are none."""
    work = Work(spark, "csv_rescue")
    n = F.col("doc_id")
    ident = F.when(n % 17 == 0, F.concat(F.lit("x"), n.cast("string"))).otherwise(n.cast("string"))
    line = F.when(n % 23 == 5, ident).otherwise(F.concat_ws(",", ident, "lang", F.col("n_chars").cast("string"), F.when(n % 19 == 3, "more")))
    # a separator that no line has: the lines are written as they are
    ad.table(spark, sf, "documents").select(line.alias("doc_id,lang,n_chars")).write.csv(f"{work.path}/lines", header=True, sep="\u0001")
    good, bad = rd.csv_rescued(spark, f"{work.path}/lines", "doc_id long, lang string, n_chars long", work)
    return good.withColumn("rescued", F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True)


@query
def caption_rescue(spark, sf):
    """Captions as JSON3 documents, some cut off or without events, some events with a start that is no number or segments that are
    no list: the events, and what is wrong with the others."""
    c = ad.captions(spark, sf)
    start = F.when(F.col("event_index") % 9 == 4, F.lit('"late"')).otherwise(F.col("start_ms").cast("string"))
    segs = F.when(F.col("event_index") % 10 == 6, F.lit('"none"')).otherwise(F.to_json(F.array(F.struct(F.col("text").alias("utf8")))))
    event = F.concat(F.lit('{"tStartMs":'), start, F.lit(',"dDurationMs":'), (F.col("end_ms") - F.col("start_ms")).cast("string"), F.lit(',"segs":'), segs, F.lit("}"))
    ordered = F.array_sort(F.collect_list(F.struct("event_index", event.alias("e"))))
    n = F.substring("video_id", 2, 18).cast("long")
    name, tail = F.when(n % 13 == 2, "event").otherwise("events"), F.when(n % 11 == 1, "]").otherwise("]}")
    docs = c.groupBy("video_id").agg(F.array_join(F.transform(ordered, lambda x: x["e"]), ",").alias("events"))
    docs = docs.select("video_id", F.concat(F.lit('{"'), name, F.lit('":['), "events", tail).alias("content"))
    good, bad = rd.caption_events_rescued(Work(spark, "caption_rescue").save(docs, "documents"))
    rows = good.select("video_id", "event_index", F.lit("").alias("reason"), "start_sec", "text")
    return rows.unionByName(bad.select("video_id", "event_index", "reason"), allowMissingColumns=True)


@query
def json_round_trip(spark, sf):
    n, path = ad.table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("task_id"), "n_name", "n_regionkey"), f"{Work(spark, 'json').path}/tasks"
    sk.write_tasks(n, path)
    return rd.json_table(spark, path, "task_id string, n_name string, n_regionkey long")


@query
def first_file_scan(spark, sf):
    """Nations written by region beside a text of the same folder; of each folder the first media file."""
    n, path = ad.table(spark, sf, "nation"), f"{Work(spark, 'files').path}/nations"
    n.repartition(2).write.partitionBy("n_regionkey").parquet(path)
    n.select("n_regionkey", F.col("n_name").alias("value")).write.mode("append").partitionBy("n_regionkey").text(path)
    f = rd.first_files(spark, path, "part-*", media_only=True)
    return f.select("folder", F.regexp_extract("file_path", "(\\.[^./]+)$", 1).alias("suffix"))


@query
def by_source_sink(spark, sf):
    path = f"{Work(spark, 'by_source').path}/units"
    sk.write_by_source(ad.units(spark, sf).select("video_id", "unit_no", "start_ms", "end_ms", "text"), path)
    return sk.read_by_source(spark, path)


@query
def summary_sink(spark, sf):
    path = f"{Work(spark, 'summary').path}/gaps"
    sk.write_summary(gap_histogram(spark, sf), path)
    return spark.read.schema(", ".join(f"ge_{t} long" for t in (-450, -300, 0, 200, 300, 400, 500, 700, 1000, 1500)).replace("ge_-450", "`ge_-450`").replace("ge_-300", "`ge_-300`")).json(path)


def _book(row: dict) -> dict:
    if row["c_acctbal"] < 0:
        raise ValueError(f"negative balance of customer {row['c_custkey']}")
    return {"cents": round(row["c_acctbal"] * 100)}


@query
def failure_isolation(spark, sf):
    """Customers whose balance can be booked, and the failures with their errors. The step raises; the run fails when all is written."""
    c, path = ad.table(spark, sf, "customer").select("c_custkey", "c_acctbal"), f"{Work(spark, 'booking').path}/booked"
    gives = "cents long"
    try:
        good, bad = at.run_isolated(c, _book, ["c_custkey", "c_acctbal"], gives, path)
    except at.FailedRows:
        good, bad = at.outcomes(c, gives, path)
    return good.select("c_custkey", F.lit("").alias("error")).unionByName(bad.select("c_custkey", "error"))


def _rate(row: dict) -> dict:
    k = json.loads(row["props"])["k"]
    if row["event_type"] == "error" and k > 90:
        raise LookupError(f"no rate for {k}")
    return {"rate": round(row["value"] * 100) // (k % 20)}


@query
def failed_run_counts(spark, sf):
    """Events by outcome, and the run's own counts, in a row of its own. Some rows divide by zero, some are refused."""
    e, path = ad.table(spark, sf, "events").select("event_id", "event_type", "value", "props"), f"{Work(spark, 'rates').path}/rates"
    gives = "rate long"
    try:
        good, bad = at.run_isolated(e, _rate, ["event_type", "value", "props"], gives, path)
        run = (0, "", "")
    except at.FailedRows as failed:
        good, bad = at.outcomes(e, gives, path)
        run = (failed.failed, "FailedRows", f"{failed.failed} of {failed.attempted}")
    rows = good.agg(F.count(F.lit(1)).alias("n"), F.sum("rate").alias("total")).select(F.lit("").alias("error_type"), F.lit("").alias("error"), "n", "total")
    rows = rows.unionByName(bad.groupBy("error_type", F.when(F.col("error_type") == "LookupError", F.col("error")).otherwise("").alias("error")).agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("total")))
    return rows.unionByName(spark.createDataFrame([(run[1], run[2], run[0], 0)], "error_type string, error string, n long, total long"))


@query
def resumed_stage(spark, sf):
    """Units of all sources in three versions, by a run that breaks off in the second and one that goes on; a writer that comes late
    to a version is refused and leaves nothing."""
    work = Work(spark, "resumed")
    u = work.save(ad.units(spark, sf).select("video_id", "unit_no", F.length("text").alias("chars")), "units")
    sources = work.save(u.select("video_id").distinct(), "sources")
    batch = lambda k: sources.where(F.pmod(F.substring("video_id", 2, 18).cast("long"), F.lit(3)) == k)
    state, config = rs.VersionedState(spark, f"{work.path}/state"), {"budget": 1}
    count = lambda todo: u.join(todo, "video_id").groupBy("video_id").agg(F.count(F.lit(1)).alias("units"), F.sum("chars").alias("chars"))

    def breaks(todo):
        bad = F.when(F.pmod(F.substring("video_id", 2, 18).cast("long"), F.lit(3)) == 1, F.raise_error(F.lit("broken off"))).otherwise(F.col("units"))
        return count(todo).withColumn("units", bad.cast("long"))

    batches = [batch(k) for k in range(3)]
    try:
        rs.run_versioned(state, "units", config, batches, breaks)
        raise AssertionError("the first run was to break off")
    except rs.Conflict:
        raise
    except Exception as e:
        if "broken off" not in str(e):
            raise
    try:
        state.commit(0, "units", config, batches[2], count(batches[2]))
        raise AssertionError("a late writer was not refused")
    except rs.Conflict:
        pass
    return rs.run_versioned(state, "units", config, batches, count)


@query
def manifest_digest(spark, sf):
    """A digest of each source's units and their number; equal tables have equal digests in any row order."""
    u = ad.units(spark, sf)
    row = F.md5(F.concat_ws("|", F.col("unit_no").cast("string"), F.col("start_ms").cast("string"), F.col("end_ms").cast("string"), "text").cast("binary"))
    ordered = F.array_sort(F.collect_list(F.struct("unit_no", row.alias("d"))))
    return u.groupBy("video_id").agg(F.md5(F.array_join(F.transform(ordered, lambda x: x["d"]), "").cast("binary")).alias("digest"), F.count(F.lit(1)).alias("rows"))


def _line_digest():
    cents = lambda c: F.round(F.col(c) * 100).cast("long")
    return mk.row_digest([F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), cents("l_extendedprice"), cents("l_quantity"), F.col("l_returnflag")])


@query
def table_digest(spark, sf):
    """One digest of all line items, whatever their order and partitions."""
    return mk.root(mk.tree(ad.table(spark, sf, "lineitem"), "l_orderkey", _line_digest(), Work(spark, "digest")))


@query
def changed_ranges(spark, sf):
    """Line items against a copy in which some prices are raised, some lines are lost and some are there twice: the ranges of keys
    that differ."""
    x, work = ad.table(spark, sf, "lineitem"), Work(spark, "changes")
    k = F.col("l_orderkey")
    raised = F.when((k % 5003 == 7) & (F.col("l_linenumber") == 1), F.col("l_extendedprice") + 1).otherwise(F.col("l_extendedprice"))
    times = F.when(k % 7001 == 11, 0).when(k % 9001 == 13, 2).otherwise(1)
    y = x.withColumn("l_extendedprice", raised).withColumn("_n", F.explode(F.array_repeat(F.lit(0), times))).drop("_n")
    one, two = (mk.tree(t, "l_orderkey", _line_digest(), work, name) for t, name in ((x, "one"), (y.repartition(3), "two")))
    return mk.difference(one, two, work)


# ---- streams


#: Events of a part's file, and the least of them in the smallest part: a part then has all of its files.
EVENTS_A_FILE, LEAST_A_FILE = 1_000_000, 1000


def files_a_part(counts: list[int]) -> int:
    """The number of files of each of the parts: one number for all, so that a batch of so many is a part. A part of few events has
    only one, and so have then all."""
    return max(1, min(-(-max(counts) // EVENTS_A_FILE), min(counts) // LEAST_A_FILE))


@query
def streamed_units(spark, sf):
    """Units of users' events, replayed as a stream of five parts in two runs; each batch is written twice, as after a failure.
    A purchase ends a unit, and so does an hour without events. A part has a file for each million events, and a batch
    reads a part."""
    work = Work(spark, "streamed")
    e = ad.table(spark, sf, "events")
    time = F.col("ts").cast("timestamp")
    rows = e.select(F.col("user_id").alias("source"), "event_id", time.alias("time"), F.round(F.col("value") * 100).cast("long").alias("amount"), (F.col("event_type") == "purchase").alias("ends"))
    first, last = rows.agg(F.min(F.unix_millis("time")), F.max(F.unix_millis("time"))).first()
    part = F.floor((F.unix_millis("time") - first) * 5 / (last - first + 1))
    write = su.write_batch(f"{work.path}/units")

    def twice(df, number):
        # held, so that the batch's state is worked off once for both
        df.persist()
        write(df, number)
        write(df, number)
        df.unpersist()

    counts = {r.part: r["count"] for r in rows.groupBy(part.alias("part")).count().collect()}
    files = files_a_part([counts.get(k, 0) for k in range(5)])
    for k in range(5):
        rows.where(part == k).repartition(files).write.mode("append").parquet(f"{work.path}/events")
        if k in (2, 4):
            stream = st.read_new_files(spark, f"{work.path}/events", rows.schema, files)
            su.run_units(su.streamed_units(stream, 3_600_000), f"{work.path}/units", f"{work.path}/checkpoint", twice).awaitTermination()
    return spark.read.parquet(f"{work.path}/units").drop("batch")
