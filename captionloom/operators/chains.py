"""Greedy chains over sources of any length: spans and packs where each begins after the last, without walking a source.

Where a span that begins at a row would end depends on that row alone, so every row has a next row. Rows are numbered over
all sources in order and cut into blocks of equal size, whoever they belong to. A block follows its own next rows up to the
first row outside (its exit). The rows that are exits or firsts of a source form a much smaller list, on which pointer
jumping finds those that the chain visits and their rank in log(blocks) rounds; each block then marks its own rows from there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captionloom.operators.captions import pack_numbers
from captionloom.operators.segmentation import UNIT, Kernel, by_source, span_kernel
from captionloom.params import CLIPS, Budget, ClipRules
from captionloom.work import Work, numbered

BLOCK, HALO = 4096, 256


def pack_kernel(budget: Budget) -> Kernel:
    """The last item of a pack from each item: the costs held are differences of running sums, which never fall, so each limit is
    first met at a place that a search finds."""

    def kernel(c: dict[str, np.ndarray], source: np.ndarray, closed: bool):
        cost = c["size"].astype(np.int64) + budget.item_cost
        n = len(cost)
        at, before = np.arange(n), np.concatenate([[0], np.cumsum(cost)])
        met = lambda limit: np.searchsorted(before, before[:-1] + limit)
        over = np.searchsorted(before[1:], before[:-1] + budget.soft_max, "right")
        full = np.maximum(at + 1, np.minimum(met(budget.hard_max), np.maximum(met(budget.target), over)))
        ends = np.append(np.flatnonzero(source[1:] != source[:-1]) + 1, n)
        stop = np.minimum(full, ends[np.searchsorted(ends, at, "right")]) if n else at
        return stop - 1, np.zeros(n, np.int64), np.zeros(n, bool), np.zeros(n, bool) if closed else stop >= n

    return kernel


def linked(rows: DataFrame, key: str, kernel: Kernel, work: Work, block: int = BLOCK, halo: int = HALO) -> DataFrame:
    """rows(key, at, ...) -> key, at, block, last, score, forced, next (the row after last, null at a source's end), exit (the first row
    outside the block on the chain from at) and hops to it. Where a block's halo was too short, all are done again with twice of it."""
    kind = dict(rows.dtypes)[key]
    names = [c for c in rows.columns if c not in (key, "at")]
    total = rows.count()
    while True:
        high, low = F.floor(F.col("at") / block), F.floor((F.col("at") - halo) / block)
        copies = F.explode(F.sequence(F.greatest(F.lit(0), low), high)).alias("block")

        def link(table: pa.Table) -> pa.Table:
            table = table.combine_chunks().sort_by("at")
            at, number = table["at"].to_numpy(), table["block"][0].as_py()
            source = table[key].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
            own = int(np.searchsorted(at, (number + 1) * block))
            last, score, forced, open_ = kernel({c: table[c].to_numpy() for c in names}, source, bool(at[-1] == total - 1))
            follows = np.minimum(last + 1, len(at) - 1)
            # without a row after it in sight, the span ends its source: it is the table's last, or open
            goes = (last + 1 < len(at)) & (source[follows] == source)
            exit_, hops = np.full(own, -1), np.zeros(own, np.int64)
            for k in range(own - 1, -1, -1):
                if goes[k]:
                    to = last[k] + 1
                    exit_[k], hops[k] = (to, 1) if to >= own else (exit_[to], hops[to] + 1)
            place = lambda x, ok: pa.array(np.where(ok, at[0] + x, 0), pa.int64(), mask=~ok)
            head = table.slice(0, own)
            columns = [head[key], head["at"], head["block"], pa.array(at[0] + last[:own]), pa.array(score[:own]), pa.array(forced[:own])]
            columns += [place(last[:own] + 1, goes[:own]), place(exit_, exit_ >= 0), pa.array(hops), pa.array(open_[:own])]
            return pa.Table.from_arrays(columns, [c.split(" ")[0] for c in schema.split(", ")])

        schema = f"{key} {kind}, at long, block long, last long, score long, forced boolean, next long, exit long, hops long, open boolean"
        out = work.save(rows.select(key, "at", *names, copies).groupBy("block").applyInArrow(link, schema), f"linked_{halo}")
        if out.where("open").isEmpty():
            return out.drop("open")
        halo *= 2


def visited(links: DataFrame, key: str, work: Work, block: int = BLOCK) -> DataFrame:
    """The links on the chain from each source's first row, with rank (from 1), by pointer jumping over exits and firsts."""
    first = links.groupBy(key).agg(F.min("at").alias("at")).select("at")
    entries = work.save(first.union(links.where("exit is not null").select(F.col("exit").alias("at")).distinct()).distinct(), "entries")
    jump = work.save(entries.join(links, "at").where("exit is not null").select("at", "exit", "hops"), "jump_0")
    found = work.save(first.select("at", F.lit(1).cast("long").alias("rank")), "found_0")
    reached, k = found, 0
    while True:
        # after round k the first 2^k entries of every chain are known, and jump leads 2^k entries on
        new = work.save(reached.join(jump, "at").select(F.col("exit").alias("at"), (F.col("rank") + F.col("hops")).alias("rank")), f"found_{k + 1}")
        if new.isEmpty():
            break
        k, reached = k + 1, reached.unionByName(new)
        on = jump.select(F.col("at").alias("exit"), F.col("exit").alias("to"), F.col("hops").alias("more"))
        jump = work.save(jump.join(on, "exit").select("at", F.col("to").alias("exit"), (F.col("hops") + F.col("more")).alias("hops")), f"jump_{k}")
    kind = dict(links.dtypes)[key]
    # the few reached rows are dealt with the links by block, in rows of their own that have no last
    rows = links.select(key, "at", "block", "last", "score", "forced", "next", F.lit(None).cast("long").alias("rank"))
    rows = rows.unionByName(reached.select("at", F.floor(F.col("at") / block).alias("block"), "rank"), allowMissingColumns=True)

    def mark(table: pa.Table) -> pa.Table:
        known = table.filter(pc.is_null(table["last"]))
        table = table.filter(pc.is_valid(table["last"])).combine_chunks().sort_by("at")
        first_at, n = table["at"][0].as_py(), table.num_rows
        rank = np.zeros(n, np.int64)
        rank[known["at"].to_numpy() - first_at] = known["rank"].to_numpy()
        following = table["next"].fill_null(-1).to_numpy() - first_at
        for i in range(n):
            if rank[i] and 0 <= following[i] < n:
                rank[following[i]] = rank[i] + 1
        return table.set_column(table.schema.get_field_index("rank"), "rank", pa.array(rank)).filter(pa.array(rank > 0))

    return rows.groupBy("block").applyInArrow(mark, f"{key} {kind}, at long, block long, last long, score long, forced boolean, next long, rank long").drop("block")


def clip_spans_linked(scored: DataFrame, work: Work, key: str = "video_id", rules: ClipRules = CLIPS, block: int = BLOCK, halo: int = HALO) -> DataFrame:
    """clip_spans() for sources of any length: key, clip_no, first_no, last_no, score, basis_no, forced, merged."""
    words = numbered(scored.select(key, "word_no", "start_ms", "end_ms", (F.col("boundary_score") * UNIT).cast("long").alias("points")), [key, "word_no"], "at", work)
    words = work.save(words.select(key, "at", "word_no", "start_ms", "end_ms", "points"), "words_at")
    links = linked(words.drop("word_no"), key, span_kernel(rules), work, block, halo)
    spans = work.save(visited(links, key, work, block), "visited")
    # the last two spans of a source, of which the second may be too short
    ends = spans.groupBy(key).agg(F.max("rank").alias("m"), F.min("at").alias("base"))
    spans = spans.join(ends, key).withColumn("left", F.col("m") - F.col("rank"))
    times = words.select("at", "start_ms", "end_ms")
    two = spans.where("left <= 1").join(times.select("at", "start_ms"), "at").join(times.select(F.col("at").alias("last"), "end_ms"), "last")
    of = lambda c, k: F.max(F.when(F.col("left") == k, F.col(c)))
    tail = two.groupBy(key).agg(of("start_ms", 1).alias("s1"), of("start_ms", 0).alias("s0"), of("end_ms", 0).alias("e0"), of("last", 0).alias("tail_last"), of("score", 0).alias("tail_score"))
    short = (F.col("e0") - F.col("s0") < rules.min_ms) & (F.col("e0") - F.col("s1") <= rules.abs_max_ms)
    tail = tail.select(key, F.coalesce(short, F.lit(False)).alias("takes"), "tail_last", "tail_score")
    spans = spans.join(tail, key).where(~(F.col("takes") & (F.col("left") == 0)))
    merged = F.col("takes") & (F.col("left") == 1)
    no = lambda c: (c - F.col("base")).cast("int")
    return spans.select(
        key,
        F.col("rank").cast("int").alias("clip_no"),
        no(F.col("at")).alias("first_no"),
        no(F.when(merged, F.col("tail_last")).otherwise(F.col("last"))).alias("last_no"),
        F.when(merged, F.greatest("score", "tail_score")).otherwise(F.col("score")).alias("score"),
        "forced",
        merged.alias("merged"),
        no(F.col("last")).alias("basis_no"),
    )


def pack_linked(items: DataFrame, budget: Budget, order: list[str], size: str, work: Work, key: str = "video_id", block: int = BLOCK, halo: int = HALO) -> DataFrame:
    """pack_by_budget() for sources of any length: the items with pack_no, from 1 in each source."""
    rows = numbered(items, [key, *order], "at", work)
    rows = work.save(rows, "items_at")
    links = linked(rows.select(key, "at", F.col(size).cast("long").alias("size")), key, pack_kernel(budget), work, block, halo)
    packs = visited(links, key, work, block)
    held = packs.select(F.explode(F.sequence("at", "last")).alias("at"), F.col("rank").cast("int").alias("pack_no"))
    return rows.join(held, "at").drop("at")


def pack_short(items: DataFrame, budget: Budget, order: list[str], size: str, key: str = "video_id") -> DataFrame:
    """pack_by_budget() of many short sources: the items with pack_no, from Arrow columns of whole sources. Items stay in one pass."""
    kinds = dict(items.dtypes)

    def walk(table: pa.Table, source: np.ndarray) -> pa.Table:
        numbers = [pack_numbers(sizes.tolist(), budget) for sizes in np.split(table[size].to_numpy(), np.flatnonzero(source[1:] != source[:-1]) + 1)]
        return table.append_column("pack_no", pa.array([n for x in numbers for n in x], pa.int32()))

    return by_source(items, key, order, walk, ", ".join([*(f"{c} {kinds[c]}" for c in items.columns), "pack_no int"]))


def pack_by_length(items: DataFrame, budget: Budget, order: list[str], size: str, work: Work, key: str = "video_id", block: int = BLOCK) -> DataFrame:
    """pack_linked(), which deals only sources of more items than a block has; a shorter one is a block of its own, which no chain
    leaves. items are read more than once and should be a written table."""
    long = items.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block).select(F.col(key).alias("_key"))
    long = work.save(long, "long")
    if long.isEmpty():
        return pack_short(items, budget, order, size, key)
    own = F.col(key).eqNullSafe(F.col("_key"))
    short = pack_short(items.join(long, own, "left_anti"), budget, order, size, key)
    return short.unionByName(pack_linked(items.join(long, own, "left_semi"), budget, order, size, work, key, block, halo=block))
