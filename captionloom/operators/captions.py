"""From timed caption events to sentence units, pieces and packs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from captionloom.functions import text as tx
from captionloom.params import Budget
from captionloom.work import Work, numbered


def sentence_units(events: DataFrame, key: str = "video_id") -> DataFrame:
    """Runs of events up to one that ends a sentence; the open rest of a source is one unit, marked so.

    Whether accumulated text ends a sentence depends on its last event alone, so the run number is the count of
    terminal events before: a window sum instead of a loop. Returns key, unit_no (from 1), start_ms, end_ms,
    first_event_index, last_event_index, n_events, text, terminated.
    """
    w = Window.partitionBy(key).orderBy("event_index")
    ends = tx.is_terminal(F.trim("text")).cast("int")
    rows = events.withColumn("_ends", ends)
    rows = rows.withColumn("_run", F.coalesce(F.sum("_ends").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    parts = F.sort_array(F.collect_list(F.struct("event_index", "text")))
    units = rows.groupBy(key, "_run").agg(
        F.min("start_ms").alias("start_ms"),
        F.max("end_ms").alias("end_ms"),
        F.min("event_index").alias("first_event_index"),
        F.max("event_index").alias("last_event_index"),
        F.count(F.lit(1)).alias("n_events"),
        tx.join_events(F.transform(parts, lambda p: p["text"])).alias("text"),
        (F.max("_ends") == 1).alias("terminated"),
    )
    # cleaned in a step of its own: it names its text more than once
    return units.withColumn("text", tx.clean(F.col("text"))).withColumnRenamed("_run", "unit_no").withColumn("unit_no", F.col("unit_no") + 1)


def numbered_id(source: Column, letter: str, n: Column, width: int) -> Column:
    return F.concat(source, F.lit(letter), F.lpad(n.cast("string"), width, "0"))


def pieces(units: DataFrame, key: str = "video_id") -> DataFrame:
    """Lossless split of unit texts at inner sentence marks, with offsets and proportional time hints."""
    rows = units.withColumn("sentence_id", numbered_id(F.col(key), "_S", F.col("unit_no"), 6))
    rows = rows.withColumn("_p", tx.split_pieces(F.col("text")))
    rows = rows.select(key, "sentence_id", "unit_no", "start_ms", "end_ms", F.length("text").alias("_n"), F.size("_p").alias("_k"), F.posexplode("_p").alias("pos", "p"))
    at = lambda c: F.col("start_ms") + (F.col("end_ms") - F.col("start_ms")) * F.col(c) / F.greatest(F.lit(1), F.col("_n"))
    rows = rows.select("*", "p.*").withColumn("word_count", F.size(F.split(tx.squeeze(F.col("piece")), " ")))
    chars = F.length("piece")
    return rows.select(
        key,
        F.col("sentence_id").alias("parent_block_id"),
        numbered_id(F.col("sentence_id"), "_P", F.col("pos") + 1, 3).alias("piece_id"),
        "unit_no",
        (F.col("pos") + 1).alias("piece_no"),
        "char_start",
        "char_end",
        F.col("piece").alias("text_exact"),
        chars.alias("char_count"),
        "word_count",
        F.round(at("char_start"), 3).alias("approx_start_ms"),
        F.round(at("char_end"), 3).alias("approx_end_ms"),
        needs_split("word_count", chars).alias("needs_split_hint"),
        tiny("word_count", chars).alias("tiny_hint"),
        F.when(F.col("_k") > 1, "internal_terminal_punctuation").otherwise("parent_block_unsplit").alias("split_basis"),
    )


def needs_split(words: str, chars: Column) -> Column:
    return (F.col(words) > 42) | (chars > 240)


def tiny(words: str, chars: Column) -> Column:
    return (F.col(words) <= 2) | (chars <= 12)


def coverage(units: DataFrame, parts: DataFrame, key: str = "video_id") -> DataFrame:
    """Per parent, whether its pieces in order give its text back but for white space."""
    ordered = F.array_sort(F.collect_list(F.struct("piece_no", "text_exact")))
    back = parts.groupBy(key, "unit_no").agg(F.array_join(F.transform(ordered, lambda p: p["text_exact"]), " ").alias("back"))
    joined = units.select(key, "unit_no", "text").join(back, [key, "unit_no"], "left")
    return joined.select(key, "unit_no", (tx.squeeze(F.col("text")) == tx.squeeze(F.coalesce("back", F.lit("")))).alias("covered"))


def pack_numbers(sizes: list[int], budget: Budget) -> list[int]:
    """Number (from 1) of the pack that each item goes to. Items are never split."""
    out, pack, held, count = [], 1, 0, 0
    for size in sizes:
        cost = size + budget.item_cost
        full = count and (held >= budget.hard_max or (held >= budget.target and held + cost > budget.soft_max))
        if full:
            pack, held, count = pack + 1, 0, 0
        out.append(pack)
        held, count = held + cost, count + 1
    return out


def pack_by_budget(items: DataFrame, budget: Budget, order: list[str], size: str, key: str = "video_id") -> DataFrame:
    """Adds pack_no, from 1 in each source. The chain is greedy and sequential, so a grouped function walks a source;
    it sees the ordinals and sizes alone, and everything else is joined or aggregated outside of it."""
    ids = [F.col(c) for c in order]
    schema = ", ".join([f"{key} {dict(items.dtypes)[key]}", *(f"{c} {dict(items.dtypes)[c]}" for c in order), "pack_no int"])

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order, kind="stable")
        return rows.assign(pack_no=pack_numbers(rows.pop("_size").tolist(), budget)).astype({"pack_no": "int32"})

    packed = items.select(key, *ids, F.col(size).cast("int").alias("_size")).groupBy(key).applyInPandas(walk, schema)
    return items.join(packed, [key, *order])


def pack_index(packed: DataFrame, ident: str, order: list[str], size: str, work: Work, key: str = "video_id", prefix: str = "review_pack_", width: int = 4) -> DataFrame:
    """One row per pack with its first and last item; ids are numbered over the sources."""
    place = F.struct(*order)
    index = packed.groupBy(key, "pack_no").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum(size).cast("long").alias("source_text_chars"),
        F.min_by(ident, place).alias("first_item_id"),
        F.max_by(ident, place).alias("last_item_id"),
    )
    index = numbered(index, [key, "pack_no"], "_no", work)
    digits = (F.col("_no") + 1).cast("string")
    return index.withColumn("pack_id", F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), "0"))).drop("_no")


def context_windows(rows: DataFrame, order: list[str], ident: str, text: str, around: int = 2, key: str = "video_id") -> DataFrame:
    """Adds prev_context and next_context: up to `around` neighbours of the same source, as arrays of (id, text)."""
    w = Window.partitionBy(key).orderBy(*order)
    entry = F.struct(F.col(ident).alias("id"), F.col(text).alias("text"))
    return rows.select(
        "*",
        F.collect_list(entry).over(w.rowsBetween(-around, -1)).alias("prev_context"),
        F.collect_list(entry).over(w.rowsBetween(1, around)).alias("next_context"),
    )
