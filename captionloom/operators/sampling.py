"""Balanced, deterministic samples for review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from captionloom.functions.text import seeded_order
from captionloom.params import KEEP
from captionloom.work import Work, numbered


def even_pick(i: Column, n: Column, k: Column) -> Column:
    """Whether rank i of n is one of k evenly spaced ranks (half-even rounding); all ranks are where there are no more."""
    # a rank is picked if some j in 0..k-1 rounds to it; only the nearest j can
    near = F.floor(i * (k - 1) / F.greatest(F.lit(1), n - 1))
    hit = lambda j: (j >= 0) & (j < k) & (F.bround(j * (n - 1) / (k - 1), 0) == i)
    spread = hit(near - 1) | hit(near) | hit(near + 1) | hit(near + 2)
    return F.when(k <= 0, False).when(n <= k, True).when(k == 1, i == F.floor(n / 2)).otherwise(spread)


def pilot(clips: DataFrame, quota: Column, spread: Column, review: int, key: str = "video_id") -> DataFrame:
    """For each source: evenly spread kept and review clips, the extremes, then the lowest quality up to the quota.

    Of several reasons the first counts. One exchange by source serves all ranks and extremes, which are windows over
    the same rows. Ids are unique. Returns key, clip_id, clip_no, quality_score, raw_start_ms, decision, pilot_reason, priority, place.
    """
    order = ["quality_score", "raw_start_ms", "clip_no"]
    kept = F.col("decision").isin(*KEEP)
    rows = clips.where(kept | (F.col("decision") == "REVIEW")).repartition(key).withColumn("_kept", kept)
    w = Window.partitionBy(key, "_kept")
    cut = F.col("cut_end_ms") - F.col("cut_start_ms")
    best = lambda first, *rest: F.min(F.struct(first, *rest)).over(w) == F.struct(first, *rest)
    rows = rows.select(
        key,
        "clip_id",
        "clip_no",
        "quality_score",
        "raw_start_ms",
        "decision",
        "_kept",
        even_pick(F.row_number().over(w.orderBy(*order)) - 1, F.count(F.lit(1)).over(w), F.when(F.col("_kept"), spread).otherwise(review)).alias("_even"),
        best(cut, F.col("quality_score"), F.col("clip_no")).alias("_shortest"),
        best(-cut, F.col("quality_score"), F.col("clip_no")).alias("_longest"),
        best(F.col("boundary_score"), F.col("quality_score"), F.col("raw_start_ms"), F.col("clip_no")).alias("_weakest"),
    )
    reasons = [
        ("keep_quality_spread", F.col("_kept") & F.col("_even")),
        ("review_quality_spread", ~F.col("_kept") & F.col("_even")),
        ("keep_shortest", F.col("_kept") & F.col("_shortest")),
        ("keep_longest", F.col("_kept") & F.col("_longest")),
        ("keep_weakest_boundary", F.col("_kept") & F.col("_weakest")),
        ("fill_source_quota", F.lit(True)),
    ]
    priority = F.coalesce(*(F.when(test, n) for n, (_, test) in enumerate(reasons)))
    reason = F.get(F.array(*(F.lit(name) for name, _ in reasons)), F.col("priority"))
    rows = rows.withColumn("priority", priority).withColumn("pilot_reason", reason)
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy("priority", *order)))
    return rows.where(F.col("place") <= quota).drop("_kept", "_even", "_shortest", "_longest", "_weakest")


def balanced_pilot(clips: DataFrame, per_source: int = 10, key: str = "video_id") -> DataFrame:
    return pilot(clips, F.lit(per_source), F.lit(5), 2, key)


def quota_pilot(clips: DataFrame, total: int, work: Work, key: str = "video_id") -> DataFrame:
    """KEEP_AUTO clips, total spread over their sources; the first sources take the remainder. clips is a written table."""
    clips = clips.where("decision = 'KEEP_AUTO'")
    sources = numbered(clips.select(key).distinct(), [key], "_no", work)
    n = sources.count()
    quota = sources.select(key, (F.lit(total // max(n, 1)) + (F.col("_no") < total % max(n, 1)).cast("int")).alias("_quota")).where("_quota > 0")
    picked = pilot(clips, F.lit(2**31 - 1), F.lit(total), 0, key)  # ranks below; the quota differs by source
    return picked.join(quota, key).where("place <= _quota").drop("_quota")


def listening_queue(picked: DataFrame, work: Work, key: str = "video_id") -> DataFrame:
    """Picked clips in the order in which they are heard, with queue_no from 0: those on review first, then the weakest
    boundary, the shortest and the longest, clips without caption trust, and the rest; each in the order of the pilot."""
    # fixed values: order of the reasons
    priority = (
        F.when(F.col("decision") == "REVIEW", 0)
        .when(F.col("pilot_reason") == "keep_weakest_boundary", 1)
        .when(F.col("pilot_reason") == "keep_shortest", 2)
        .when(F.col("pilot_reason") == "keep_longest", 3)
        .when(F.col("decision") == "KEEP_WHISPER_PRIMARY", 4)
        .otherwise(5)
    )
    return numbered(picked.withColumn("review_priority", priority), ["review_priority", key, "place"], "queue_no", work)


def review_queue(clips: DataFrame, work: Work) -> DataFrame:
    """All clips on review, lowest quality first, with queue_no from 0."""
    return numbered(clips.where("decision = 'REVIEW'"), ["quality_score", "raw_start_ms", "clip_id"], "queue_no", work)


def page(queue: DataFrame, offset: int, limit: int) -> DataFrame:
    """`limit` rows of a numbered queue from `offset` on; all of the rest for a limit of zero."""
    rows = queue.where(F.col("queue_no") >= offset)
    return rows.where(F.col("queue_no") < offset + limit) if limit > 0 else rows


def middle_of(rows: DataFrame, order: list[str], key: str = "video_id") -> DataFrame:
    """The row at rank n // 2 of each source."""
    w = Window.partitionBy(key)
    ranked = rows.withColumn("_i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count(F.lit(1)).over(w))
    return ranked.where("_i = floor(_n / 2)").drop("_i", "_n")


def even_picks(rows: DataFrame, picks: Column, order: list[str], key: str = "video_id") -> DataFrame:
    """Rows of each source at `picks` evenly spaced ranks; all rows where there are no more."""
    w = Window.partitionBy(key)
    pick = even_pick(F.row_number().over(w.orderBy(*order)) - 1, F.count(F.lit(1)).over(w), picks)
    return rows.withColumn("_pick", pick).where("_pick").drop("_pick")


def spread_targets(n: int, count: int) -> list[int]:
    """Evenly spaced ranks (half-even rounding)."""
    if n < count:
        raise ValueError(f"not enough rows to sample: {n} of {count}")
    return [0] if count == 1 else [round(k * (n - 1) / (count - 1)) for k in range(count)]


def spread_picks(candidates: list[tuple[int, str]], targets: list[int]) -> list[int]:
    """Of (rank, source), for each target the nearest rank not taken, of a source not used before where there is one."""
    chosen: dict[int, str] = {}
    for target in targets:
        free = sorted((abs(rank - target), rank, source) for rank, source in candidates if rank not in chosen)
        used = set(chosen.values())
        _, rank, source = next((x for x in free if x[2] not in used), free[0])
        chosen[rank] = source
    return list(chosen)


def spread_indices(sources: list[str], count: int) -> list[int]:
    """Ranks picked of rows in order, given their sources."""
    return spread_picks(list(enumerate(sources)), spread_targets(len(sources), count))


def spread_sample(rows: DataFrame, count: int, score: str, work: Work, name: str, key: str = "video_id") -> DataFrame:
    """`count` rows spread over the score, from different sources where there are so many; sample_order from 1.

    Ranks are numbered by ranges. For a target, the pick is among the nearest ranks of `count` sources, or the nearest
    `count` ranks of all: so few rows for each target reach the driver.
    """
    median = rows.agg(F.median(score)).first()[0]
    ranked = rows.withColumn("_score", F.coalesce(F.col(score), F.lit(0.0 if median is None else float(median))))
    ranked = numbered(ranked, ["_score", key, "raw_start_ms", "clip_id"], f"{name}_rank", work).withColumnRenamed(f"{name}_rank", "_rank")
    targets = spread_targets(ranked.count(), count)
    found: dict[int, str] = {}
    for target in dict.fromkeys(targets):
        away = F.struct(F.abs(F.col("_rank") - target).alias("d"), F.col("_rank").alias("r"))
        own = ranked.groupBy(key).agg(F.min(away).alias("a")).orderBy("a").limit(count).select(F.col("a.r").alias("r"), key)
        near = ranked.where(F.col("_rank").between(target - count, target + count)).select(F.col("_rank").alias("r"), key)
        found.update((r.r, r[key]) for r in own.unionByName(near).collect())
    picks = spread_picks(sorted(found.items()), targets)
    order = F.broadcast(rows.sparkSession.createDataFrame([(r, n) for n, r in enumerate(picks, 1)], "_rank long, sample_order int"))
    return ranked.join(order, "_rank").drop("_rank", "_score")


def keep_auto_queue(picked: DataFrame, work: Work, key: str = "video_id") -> DataFrame:
    """Picked trusted clips in the order in which they are heard, with queue_no from 0: quality spread, weakest boundary,
    shortest, longest, the rest; each in the order of the pilot."""
    # fixed values: order of the reasons
    reasons = ("keep_quality_spread", "keep_weakest_boundary", "keep_shortest", "keep_longest")
    priority = F.coalesce(*(F.when(F.col("pilot_reason") == r, n) for n, r in enumerate(reasons)), F.lit(len(reasons)))
    return numbered(picked.withColumn("review_priority", priority), ["review_priority", key, "place"], "queue_no", work)


def group_sample(audited: DataFrame, each: int, work: Work, key: str = "video_id") -> DataFrame:
    """`each` clips of the three audit groups, with audit_group and sample_order from 1 over all: accepted and doubtful ones spread
    over their similarity, from different sources where there are so many, and of those without caption trust the middle one by
    quality of each of the first sources. Fails unless every group has its number and no clip is in two. audited is a written table."""
    accept, align, whisper = "ACCEPT_CAPTION_CANDIDATE", "REVIEW_ALIGNMENT", "REVIEW_WHISPER_PRIMARY"
    of = lambda g: audited.where(F.col("audit_decision") == g)
    spread = [spread_sample(of(g), each, "proposal_similarity", work, g.lower(), key).withColumn("audit_group", F.lit(g)) for g in (accept, align)]
    sources = of(whisper).select(key).distinct().orderBy(key).limit(each)
    middle = middle_of(of(whisper).join(F.broadcast(sources), key), ["quality_score", "raw_start_ms", "clip_no"], key)
    order = F.row_number().over(Window.orderBy(key)).cast("int")
    parts = [*spread, middle.withColumn("sample_order", order).withColumn("audit_group", F.lit(whisper))]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part.select(out.columns))
    first = F.when(F.col("audit_group") == align, each).when(F.col("audit_group") == whisper, 2 * each).otherwise(0)
    out = work.save(out.withColumn("sample_order", F.col("sample_order") + first), "group_sample")
    found = out.agg(*(F.count_if(F.col("audit_group") == g) for g in (accept, align, whisper)), F.countDistinct("clip_id")).first()
    if tuple(found) != (each, each, each, 3 * each):
        raise ValueError(f"expected {each} different clips of each group, found {tuple(found)}")
    return out


def semantic_pilot(pieces: DataFrame, seed: int, quota: dict[str, int], order: list[str], key: str = "video_id") -> DataFrame:
    """Pieces of each source by bucket (first that fits: LONG_SPLIT, TINY_FRAGMENT, REPEAT_OR_CROWDING,
    NORMAL_CONTROL), in a seeded order up to the bucket's quota, with the texts before and after."""
    w = Window.partitionBy(key).orderBy(*order)
    control = F.col("word_count").between(6, 28) & F.col("char_count").between(25, 160)
    bucket = (
        F.when(F.col("needs_split_hint"), "LONG_SPLIT").when(F.col("tiny_hint"), "TINY_FRAGMENT").when(F.col("risk_hint"), "REPEAT_OR_CROWDING").when(control, "NORMAL_CONTROL")
    )
    rows = pieces.select("*", F.lag("text_exact").over(w).alias("prev_text"), F.lead("text_exact").over(w).alias("next_text"), bucket.alias("bucket"))
    n = F.row_number().over(Window.partitionBy(key, "bucket").orderBy(seeded_order(F.col("piece_id"), seed), "piece_id"))
    limit = F.create_map(*(x for k, v in quota.items() for x in (F.lit(k), F.lit(v))))
    return rows.where("bucket is not null").withColumn("bucket_place", n).where(F.col("bucket_place") <= limit[F.col("bucket")])
