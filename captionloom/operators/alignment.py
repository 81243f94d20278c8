"""Alignment of clip texts with caption texts near them."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from captionloom.functions import text as tx
from captionloom.functions.similarity import char_similarity, matched, spelt, token_similarity
from captionloom.operators.timeline import dealt_interval_lists, match_band
from captionloom.work import Work

# fixed values: acceptance, length limits and penalties
MIN_ACCEPT, RATIO_DEVIATION, SPAN_PENALTY, MAX_SENTENCES = 0.90, 0.35, 0.04, 6
SUBSEQUENCE_PENALTY, MAX_EVENTS = 0.03, 12
#: Past every place of a token.
AWAY = 1 << 30
#: Tokens of runs that are counted at a time.
COUNTED = 20_000


def parted(text: str) -> list[str]:
    """Tokens that were joined with spaces; other white space may be part of one."""
    return text.split(" ") if text else []


def first_best(bounds: list[tuple], score: Callable[[tuple], float]) -> tuple[float, tuple] | None:
    """(score, run) of the run (bound, place ..., ...) with the best score, of equals the one at the first place; places differ. No score
    exceeds its bound, so runs are scored by falling bounds for as long as a bound can win."""
    best = None
    for bound, *run in sorted((-x[0], *x[1:]) for x in bounds):
        if best and (bound, *run) >= best:
            break
        found = (-score(run), *run)
        best = min(best, found) if best else found
    return best and (-best[0], best[1:])


def best_sentences(w: list[str], said: list[list[str]]) -> tuple[float, int, int, int] | None:
    """(similarity, first sentence from 1, sentences, tokens) of sentence_alignment() for one clip, or None without a run of a suitable length."""
    m, bounds = len(w), []
    if not m:
        return None
    own, all_ = spelt(w, [t for s in said for t in s])
    ends = list(accumulate(map(len, said)))
    held = Counter(own)
    penalty = lambda size: SPAN_PENALTY * abs(size - m) / m
    for i, sentence in enumerate(said):
        begin, left, common = ends[i] - len(sentence), dict(held), 0
        at = begin
        for k, end in enumerate(ends[i : i + MAX_SENTENCES]):
            for c in all_[at:end]:
                if n := left.get(c):
                    left[c], common = n - 1, common + 1
            at, size = end, end - begin
            if size / m > 1 + RATIO_DEVIATION:
                break
            if size and size / m >= 1 - RATIO_DEVIATION:
                bounds.append((2.0 * common / (m + size) - penalty(size), i + 1, k + 1, begin, end))
    similarity: dict[tuple, float] = {}

    def score(run: list) -> float:
        begin, end = run[2:]
        similarity[tuple(run)] = 2.0 * matched(own, all_[begin:end]) / (m + end - begin)
        return similarity[tuple(run)] - penalty(end - begin)

    best = first_best(bounds, score)
    return best and (similarity[best[1]], *best[1][:2], best[1][3] - best[1][2])


@F.pandas_udf(T.StructType().add("sim", "double").add("i", "integer").add("k", "integer").add("size", "integer"))
def sentence_runs(w: pd.Series, said: pd.Series) -> pd.DataFrame:
    rows = [best_sentences(list(x), [parted(s) for s in y]) for x, y in zip(w, said, strict=True)]
    return pd.DataFrame([r or (None, None, None, None) for r in rows], columns=["sim", "i", "k", "size"]).astype({"sim": "float64", "i": "Int32", "k": "Int32", "size": "Int32"})


def sentence_alignment(clips: DataFrame) -> DataFrame:
    """clips(clip_id, text, window_text) -> the best run of complete caption sentences of each clip.

    A sentence is split into tokens once: no token and no letter's case reaches past a space, so a run's tokens are those of its
    sentences. A clip is a row throughout; its runs of compatible length are bounded by what they have in common, and matched by
    falling bounds. The best score, similarity less a penalty for the difference in length, wins; of equals the first run.
    """
    rows = clips.select("clip_id", tx.tokens(F.coalesce("text", F.lit(""))).alias("w"), tx.complete_sentences(F.coalesce("window_text", F.lit(""))).alias("s"))
    rows = rows.select("clip_id", F.size("w").alias("m"), "s", sentence_runs("w", F.transform("s", lambda x: F.array_join(tx.tokens(x), " "))).alias("b"))
    accept = F.col("b.sim") >= MIN_ACCEPT
    return rows.select(
        "clip_id",
        F.coalesce(F.array_join(F.slice("s", F.col("b.i"), F.col("b.k")), " "), F.lit("")).alias("proposal_text"),
        F.coalesce("b.sim", F.lit(0.0)).alias("proposal_similarity"),
        (F.col("b.size") / F.col("m")).alias("proposal_token_ratio"),
        F.coalesce("b.k", F.lit(0)).alias("proposal_sentence_count"),
        F.when(accept, "ACCEPT_CAPTION").otherwise("REVIEW_ALIGNMENT").alias("alignment_decision"),
        F.when((F.size("s") == 0) | (F.col("m") == 0), "no_complete_caption_sentence")
        .when(F.col("b.sim").isNull(), "no_length_compatible_complete_sentence_span")
        .when(accept, "caption_sentence_alignment_pass")
        .otherwise("caption_sentence_similarity_low")
        .alias("alignment_reason"),
    )


def overlap_consensus(segments: DataFrame, events: DataFrame, key: str = "video_id") -> DataFrame:
    """segments(key, segment_id, start_ms, end_ms, text), events(key, event_start, event_end, event_index, event_text) ->
    key, segment_id, overlap_text, lexical_similarity (by characters), match_band. A segment without events has empty text."""
    spans, said = segments.select(key, "segment_id", "start_ms", "end_ms", "text"), events.select(key, "event_start", "event_index", "event_text", "event_end")
    rows = dealt_interval_lists(spans, said, key, "segment_id", ("start_ms", "end_ms"), ("event_start", "event_end"), "events")
    rows = rows.withColumn("overlap_text", F.array_join("events.event_text", " "))
    rows = rows.withColumn("overlap_text", tx.clean(F.col("overlap_text")))
    rows = rows.withColumn("lexical_similarity", char_similarity(tx.lexical(F.col("text")), tx.lexical(F.col("overlap_text"))))
    return rows.select(key, "segment_id", "overlap_text", "lexical_similarity", match_band(F.col("lexical_similarity")).alias("match_band"))


def run_bounds(pairs: DataFrame, key: str = "clip_id") -> DataFrame:
    """pairs(key, w, c: arrays of tokens) -> key, m, size, at, common: for each run of c of a length that suits w, how many tokens
    it has in common with w as multisets.

    A token of c counts in a run unless as many before it in the run as w has of it are the same token, so it counts from just
    after the place of that earliest one on. Sliding a run by one place then changes the number by three yes-or-no terms:
    the token that leaves, the one that enters, and the one that now counts as the leaving one made room. A running sum
    of these over the places gives all runs of a length, a row each, without looking into any run.
    """
    rows = pairs.where((F.size("w") > 0) & (F.size("c") > 0))
    own = rows.select(key, F.explode("w").alias("t")).groupBy(key, "t").agg(F.count(F.lit(1)).cast("int").alias("cap"))
    said = rows.select(key, F.posexplode("c").alias("j", "t")).join(own, [key, "t"], "left")
    w = Window.partitionBy(key, "t").orderBy("j")
    # the place after which a token counts: -1 from the start, AWAY never; and the token that counts once this one has left
    earlier = F.collect_list("j").over(w.rowsBetween(Window.unboundedPreceding, -1))
    later = F.collect_list("j").over(w.rowsBetween(1, Window.unboundedFollowing))
    after = F.when(F.col("cap").isNull(), AWAY).otherwise(F.coalesce(F.try_element_at(earlier, -F.col("cap")), F.lit(-1)))
    freed = F.when(F.col("cap").isNull(), AWAY).otherwise(F.coalesce(F.try_element_at(later, F.col("cap")), F.lit(AWAY)))
    said = said.select(key, "j", after.alias("after"), freed.alias("freed"))
    ordered = F.array_sort(F.collect_list(F.struct("j", "after", "freed")))
    places = said.groupBy(key).agg(ordered.alias("x"))
    places = places.select(key, F.transform("x", lambda x: x["after"]).alias("after"), F.transform("x", lambda x: x["freed"]).alias("freed"))
    m = F.size("w")
    # fixed values: how much shorter or longer a run may be
    low = F.greatest(F.lit(1), m - F.greatest(F.lit(4), F.floor(m / 4).cast("int")))
    high = F.least(F.size("c"), m + F.greatest(F.lit(6), F.floor(m * F.lit(0.35)).cast("int")))
    sizes = rows.select(key, m.alias("m"), low.alias("low"), high.alias("high")).where("low <= high").join(places, key)
    runs = sizes.select(key, "m", "after", "freed", F.explode(F.sequence("low", "high")).alias("size"))
    runs = runs.select("*", F.explode(F.sequence(F.lit(0), F.size("after") - F.col("size"))).alias("at"))
    left, entered = F.get("after", F.col("at") - 1), F.get("after", F.col("at") + F.col("size") - 1)
    room = F.get("freed", F.col("at") - 1)
    one = lambda c: c.cast("int")
    slid = one(entered <= F.col("at") - 1) + one(room < F.col("at") + F.col("size") - 1) - one(left < AWAY)
    first = F.size(F.filter(F.slice("after", F.lit(1), F.col("size")), lambda p: p < 0))
    step = F.when(F.col("at") == 0, first).otherwise(slid)
    return runs.select(key, "m", "size", "at", step.alias("step")).select(
        key, "m", "size", "at", F.sum("step").over(Window.partitionBy(key, "size").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("int").alias("common")
    )


def token_subsequence(pairs: DataFrame, work: Work, key: str = "clip_id") -> DataFrame:
    """pairs(key, w, c) -> key, similarity, matched: the run of c with the best ratio to w less a penalty for its length; of equals
    the shortest, then the first. Without a run of a suitable length: 0 and nothing.

    The run with the best bound is matched first. Only runs whose bound exceeds what that one got, or equals it and comes
    earlier, can win; they are matched, and the others never leave their row of numbers."""
    pairs = work.save(pairs.select(key, "w", "c"), "pairs")
    penalty = F.lit(SUBSEQUENCE_PENALTY) * F.abs(F.col("size") - F.col("m")) / F.col("m")
    bounds = work.save(run_bounds(pairs, key).withColumn("bound", F.lit(2.0) * F.col("common") / (F.col("m") + F.col("size")) - penalty), "bounds")

    def matched(runs: DataFrame) -> DataFrame:
        said = runs.join(pairs, key).withColumn("run", F.slice("c", F.col("at") + 1, F.col("size")))
        said = said.withColumn("similarity", token_similarity("w", "run"))
        return said.select(key, "size", "at", "similarity", (F.col("similarity") - penalty).alias("score"), F.array_join("run", " ").alias("matched"))

    order = F.struct(-F.col("size"), -F.col("at"))
    top = bounds.groupBy(key).agg(F.max_by(F.struct("m", "size", "at"), F.struct("bound", order)).alias("r")).select(key, "r.*")
    top = work.save(matched(top), "top")
    limit = top.select(F.col(key).alias("_k"), F.col("score").alias("_score"), F.struct("size", "at").alias("_place"))
    could = (F.col("bound") > F.col("_score")) | ((F.col("bound") == F.col("_score")) & (F.struct("size", "at") < F.col("_place")))
    rest = work.save(bounds.join(limit, F.col(key) == F.col("_k")).where(could).select(key, "m", "size", "at"), "rest")
    best = top.unionByName(matched(rest)).groupBy(key).agg(F.max_by(F.struct("similarity", "matched"), F.struct("score", order)).alias("b"))
    return pairs.select(key).join(best, key, "left").select(key, F.coalesce("b.similarity", F.lit(0.0)).alias("similarity"), F.coalesce("b.matched", F.lit("")).alias("matched"))


def best_run(w: list[str], c: list[str]) -> tuple[float, str]:
    """(similarity, run) of token_subsequence() for one pair. Runs are counted by the places that begin them, COUNTED tokens at a time,
    and matched by falling bounds for as long as a bound can win."""
    m, n = len(w), len(c)
    # fixed values: how much shorter or longer a run may be
    low, high = max(1, m - max(4, m // 4)), min(n, m + max(6, int(m * 0.35)))
    if not m or low > high:
        return 0.0, ""
    own, said = spelt(w, c)
    cap, places, counts = Counter(own), defaultdict(list), [AWAY] * (n + high)
    for j, t in enumerate(said):
        if t in cap:
            held = places[t]
            counts[j] = held[-cap[t]] if len(held) >= cap[t] else -1
            held.append(j)
    after, sizes = np.array(counts), np.arange(low, high + 1)[:, None]
    penalty = SUBSEQUENCE_PENALTY * np.abs(sizes - m) / m
    best, similarity = (-np.inf, 0, 0), 0.0
    step = max(1, COUNTED // high)
    for first in range(0, n - low + 1, step):
        at = np.arange(first, min(first + step, n - low + 1))
        common = np.cumsum(after[at + np.arange(high)[:, None]] < at, axis=0)[low - 1 :]
        bound = 2.0 * common / (m + sizes) - penalty
        bound[at + sizes > n] = -np.inf
        while True:
            # the greatest bound, of equals that of the shortest run and then the first: what comes after one that cannot win cannot either
            k, i = divmod(int(bound.argmax()), len(at))
            place = (-low - k, -first - i)
            if (bound[k, i], *place) <= best or bound[k, i] == -np.inf:
                break
            bound[k, i] = -np.inf
            found = 2.0 * matched(own, said[-place[1] : -place[1] - place[0]]) / (m - place[0])
            best, similarity = max((best, similarity), ((float(found - penalty[k, 0]), *place), found))
    return similarity, " ".join(c[-best[2] : -best[2] - best[1]])


@F.pandas_udf(T.StructType().add("similarity", "double").add("matched", "string"))
def best_runs(w: pd.Series, c: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([best_run(list(x), list(y)) for x, y in zip(w, c, strict=True)], columns=["similarity", "matched"])


def token_subsequence_by_clip(pairs: DataFrame, key: str = "clip_id") -> DataFrame:
    """token_subsequence() of many clips with short windows: a clip is a row throughout, its runs are never rows."""
    return pairs.select(key, best_runs("w", "c").alias("b")).select(key, "b.similarity", "b.matched")


def event_run_match(pairs: DataFrame) -> DataFrame:
    """pairs(clip_id, text, event_start, event_end, event_index, event_text) -> the most similar run of up to
    MAX_EVENTS neighbouring events of each clip; of equals the first."""
    w = Window.partitionBy("clip_id").orderBy("event_start", "event_end", "event_index")
    # no reference and no letter's case reaches past a space, so a run's tokens are those of its events; each text is split once
    event = F.when(F.col("event_text").isNotNull(), F.struct(F.col("event_text").alias("t"), F.col("_said").alias("l")))
    rows = pairs.select("clip_id", "text", "event_start", "event_end", "event_index", "event_text", tx.lexical_tokens(F.col("event_text")).alias("_said"))
    rows = rows.withColumn("_i", F.row_number().over(w)).withColumn("_next", F.collect_list(event).over(w.rowsBetween(0, MAX_EVENTS - 1)))
    rows = rows.select("clip_id", tx.lexical_tokens(F.col("text")).alias("_own"), "_i", "_next")
    runs = rows.select("clip_id", "_own", "_i", "_next", F.explode(F.sequence(F.lit(1), F.size("_next"))).alias("events"))
    runs = runs.withColumn("_run", F.slice("_next", F.lit(1), F.col("events")))
    runs = runs.select("clip_id", "_i", "events", "_own", F.trim(F.array_join(F.col("_run.t"), " ")).alias("matched"), F.flatten(F.col("_run.l")).alias("_tokens"))
    runs = runs.withColumn("similarity", token_similarity("_own", "_tokens")).drop("_own", "_tokens")
    return runs.groupBy("clip_id").agg(F.max_by(F.struct("similarity", "matched", "events"), F.struct("similarity", -F.col("_i"), -F.col("events"))).alias("b")).select(
        "clip_id", "b.similarity", "b.matched", "b.events"
    )


def best_events(w: list[str], said: list[list[str] | None]) -> tuple[float, int, int]:
    """(similarity, first event from 0, events) of event_run_match() for one clip; events without text are in no run, but take a place."""
    own, all_ = spelt(w, [t for e in said for t in e or ()])
    begins = [0, *accumulate(len(e or ()) for e in said)]
    m, held, bounds = len(w), Counter(own), []
    for i, event in enumerate(said):
        if event is not None:
            left, common, k = dict(held), 0, 0
            for j in range(i, min(i + MAX_EVENTS, len(said))):
                if said[j] is not None:
                    for c in all_[begins[j] : begins[j + 1]]:
                        if n := left.get(c):
                            left[c], common = n - 1, common + 1
                    k, total = k + 1, m + begins[j + 1] - begins[i]
                    bounds.append((2.0 * common / total if total else 1.0, i, k, begins[i], begins[j + 1]))
    best = first_best(bounds, lambda run: 2.0 * matched(own, all_[run[2] : run[3]]) / (m + run[3] - run[2]) if m + run[3] - run[2] else 1.0)
    return (best[0], *best[1][:2]) if best else (float(not m), 0, 0)


@F.pandas_udf(T.StructType().add("similarity", "double").add("first", "integer").add("events", "integer"))
def event_runs(form: pd.Series, said: pd.Series) -> pd.DataFrame:
    rows = [best_events(parted(x), [e if e is None else parted(e) for e in y]) for x, y in zip(form, said, strict=True)]
    return pd.DataFrame(rows, columns=["similarity", "first", "events"])


def event_run_match_by_clip(clips: DataFrame, key: str = "clip_id") -> DataFrame:
    """event_run_match() of clips(key, form, events): the normal form of a clip's text, and its events in order, structs with event_text and
    event_form. A clip is a row throughout, its runs are never rows. Clips without events have no row."""
    rows = clips.where(F.size("events") > 0).select(key, "events.event_text", event_runs(F.coalesce("form", F.lit("")), F.col("events.event_form")).alias("b"))
    run = F.slice(F.array_compact(F.slice("event_text", F.col("b.first") + 1, F.lit(MAX_EVENTS))), F.lit(1), F.col("b.events"))
    return rows.select(key, "b.similarity", F.trim(F.array_join(run, " ")).alias("matched"), "b.events")
