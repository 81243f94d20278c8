"""SimHash near-deduplication with the generalised pigeonhole principle.

Each text has a 64-bit fingerprint: the majority bits of the XXH64 values of its word shingles. All pairs of
fingerprints at a Hamming distance of at most `distance` are linked. To find them, the 64 bits are grouped into
m partitions, correlated bits together, and partition k gets a threshold t_k >= -1 with sum(t_k) = distance - m + 1:
of any two fingerprints within the distance, some partition differs in at most t_k bits (-1: the partition is
not used). Number of partitions and thresholds come from a dynamic program over the estimated number of
candidate pairs plus the rows that probing makes, from bit statistics over all fingerprints and the pairs of a
sample of them, as bits of a partition are not independent.

Copies share a fingerprint, so only distinct fingerprints are compared. A fingerprint is dealt to one bucket for
each way to leave out t_k bits of partition k; two that agree in the other bits meet there. Buckets are sorted
runs in a stream: small ones are compared with numpy all at once; larger ones by a search that removes what it
has reached, so that a dense bucket costs about its size and gives a spanning tree, never all pairs. Buckets
over BLOCK_ROWS fingerprints are cut into blocks of bounded size, and every two blocks meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Work, pieces, texts
from .graph import components

SHINGLE, DISTANCE, SEED = 4, 4, 42
BITS = 64
#: Buckets up to this many rows are compared pair by pair.
SMALL = 32
#: Fingerprints of one bucket, or of one block of a larger bucket, that a task holds.
BLOCK_ROWS = 50_000
#: Relative cost of a probe row (it is shuffled and sorted) and of a candidate pair (one exclusive or).
PROBE_COST, PAIR_COST = 60.0, 1.0
MASKED = 2  # bits left out of a partition at most: more makes too many rows
#: Fingerprints whose pairs are counted to estimate candidates, and how many pairs make an estimate. Estimates decide
#: how the bits are grouped, and no result.
SAMPLE, SEEN_PAIRS = 2048, 10


def shingle_hashes(text: str, size: int = SHINGLE) -> np.ndarray:
    """XXH64 (seed 42) of the word shingles, repeats included; fewer words than size are one shingle."""
    words = text.encode().lower().split()  # bytes: lower() changes A-Z alone, split() takes \\x20 and \\x09-\\x0D
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    size = min(size, len(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *(ends[: len(words) - size]).tolist()]
    stops = (ends[size - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit k is 1 if it is set in over half of the hashes; 0 for none."""
    counts = np.zeros(BITS, np.int64)
    for start in range(0, hashes.size, 8192):
        part = hashes[start : start + 8192]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > hashes.size, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            fps = [fingerprint(shingle_hashes(t, shingle)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return texts(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def bit_statistics(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and in how many bits i and j are both set; one 64 x 64 table per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            fps = batch.column(0).to_numpy()
            bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            n, both = n + len(fps), both + (bits.T @ bits).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(range(BITS * BITS + 1), pa.int32()), pa.array([n, *both.ravel().tolist()], pa.int64())], ["cell", "n"])

    rows = nodes.select("fp").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(BITS * BITS + 1, np.int64)
    for cell, n in rows:
        flat[cell] = n
    return int(flat[0]), flat[1:].reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """m partitions of equal size; each takes an open bit and then those most correlated with its bits."""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    linked = np.abs(both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(linked, 0)
    left, out = list(range(BITS)), []
    for k in range(m):
        size = BITS // m + (k < BITS % m)
        first = max(left, key=lambda b: (linked[b, left].max(), -b))
        group = [first]
        left.remove(first)
        while len(group) < size:
            best = max(left, key=lambda b: (linked[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        out.append(sorted(group))
    return out


def within(share: np.ndarray, most: int) -> np.ndarray:
    """Chance that two fingerprints differ in exactly 0, 1, ... most of the bits, if bits are independent, from the share
    of ones of each."""
    odds = np.zeros(most + 1)
    odds[0] = 1
    for p in 2 * share * (1 - share):
        odds[1:] = odds[1:] * (1 - p) + odds[:-1] * p
        odds[0] *= 1 - p
    return odds


def differing(group: list[int], share: np.ndarray, sample: np.ndarray, most: int) -> np.ndarray:
    """Estimated share of the pairs of fingerprints that differ in exactly 0, 1, ... most bits of a group: as counted over all
    pairs of a sample where it has SEEN_PAIRS of them, and no less than independent bits would give."""
    odds = within(share[group], most)
    if sample.size < 2:
        return odds
    mask = np.uint64(sum(1 << b for b in group))
    seen = np.zeros(BITS + 1, np.int64)
    for k in range(1, sample.size):
        seen += np.bincount(np.bitwise_count((sample[k:] ^ sample[:-k]) & mask), minlength=BITS + 1)
    seen = seen[: most + 1]
    return np.where(seen >= SEEN_PAIRS, np.maximum(odds, seen / (sample.size * (sample.size - 1) / 2)), odds)


def allocate(n: int, both: np.ndarray, groups: list[list[int]], distance: int, sample: np.ndarray) -> tuple[float, list[int]]:
    """Least estimated cost, and the thresholds of the partitions, by dynamic programming over their sum."""
    share, m = np.diag(both) / max(n, 1), len(groups)
    best = {0: (0.0, [])}  # by sum of (threshold + 1)
    for group in groups:
        odds, size = differing(group, share, sample, MASKED), len(group)
        step = {}
        for done, (cost, chosen) in best.items():
            for t in range(-1, min(MASKED, size) + 1):
                own = 0.0
                if t >= 0:
                    # a pair that differs in d bits meets in each bucket that leaves these and t - d others out
                    meetings = sum(float(odds[d]) * comb(size - d, t - d) for d in range(t + 1))
                    own = PROBE_COST * n * comb(size, t) + PAIR_COST * n * n / 2 * meetings
                total = done + t + 1
                if total <= distance + 1 and (total not in step or cost + own < step[total][0]):
                    step[total] = (cost + own, [*chosen, t])
        best = step
    return best.get(distance + 1, (float("inf"), [-1] * m))


def make_plan(n: int, both: np.ndarray, distance: int, sample: np.ndarray | None = None) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition that is used."""
    sample = np.empty(0, np.uint64) if sample is None else sample
    found = []
    for m in range(2, distance + 2):
        groups = group_bits(n, both, m)
        cost, thresholds = allocate(n, both, groups, distance, sample)
        found.append((cost, m, [(g, t) for g, t in zip(groups, thresholds, strict=True) if t >= 0]))
    return min(found, key=lambda x: x[:2])[2]


def bucket_masks(plan: list[tuple[list[int], int]]) -> np.ndarray:
    """For each kind of bucket the bits in which its fingerprints agree."""
    masks = []
    for bits, t in plan:
        for left_out in combinations(bits, t):
            masks.append(sum(1 << b for b in bits if b not in left_out))
    return np.array(masks, np.uint64)


def bucket_rows(nodes: DataFrame, masks: np.ndarray) -> DataFrame:
    """(kind int, value long, fp long): every bucket of every fingerprint. value has the bits that count in place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = np.arange(len(masks), dtype=np.int32)
        for batch in pieces(batches, 4096):
            fps = batch.column(0).to_numpy().view(np.uint64)
            values = (fps[:, None] & masks[None, :]).ravel().view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(kinds, len(fps))), pa.array(values), pa.array(np.repeat(fps, len(masks)).view(np.int64))],
                ["kind", "value", "fp"],
            )

    return nodes.select("fp").mapInArrow(run, "kind int, value long, fp long")


def near(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= distance


def spanning(fps: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect what links within the distance connect. Each search step removes what it reaches."""
    left, edges = fps, []
    while left.size > 1:
        front, left = [left[0]], left[1:]
        while front and left.size:
            at = front.pop()
            hit = near(left, at, distance)
            if hit.any():
                reached = left[hit]
                edges.append((np.full(reached.size, at), reached))
                front.extend(reached)
                left = left[~hit]
    return edges


def link_buckets(rows: DataFrame, by: list[str], distance: int, most: int | None) -> DataFrame:
    """rows(*by, fp), dealt and sorted here -> (kind, a, b): an edge (kind -1), or a row of a bucket of over `most`
    fingerprints, whose kind, value and fp are handed on as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # the run that may go on in the next batch, with its keys
        over = None  # key of the large bucket that is being handed on

        def out(kind, a, b):
            a, b = (np.ascontiguousarray(x).view(np.int64) for x in (a, b))
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32) if np.isscalar(kind) else kind), pa.array(a), pa.array(b)], ["kind", "a", "b"])

        def compare(keys: list[np.ndarray], fps: np.ndarray):
            """Edges of complete runs."""
            fresh = np.ones(fps.size, bool)
            fresh[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
            number = np.cumsum(fresh) - 1
            starts = np.flatnonzero(fresh)
            sizes = np.diff(np.append(starts, fps.size))
            small = (sizes <= SMALL)[number]
            found = []
            for step in range(1, min(SMALL, int(sizes.max(initial=1)))):
                ok = (number[step:] == number[:-step]) & small[step:]
                at = np.flatnonzero(ok)
                at = at[near(fps[at], fps[at + step], distance)]
                found.append((fps[at], fps[at + step]))
            for start, size in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
                found.extend(spanning(fps[start : start + size], distance))
            if found:
                a, b = (np.concatenate([x[k] for x in found]) for k in (0, 1))
                if a.size:
                    low, high = np.minimum(a, b), np.maximum(a, b)
                    pair = np.unique(np.stack([low, high], axis=1), axis=0)
                    yield out(-1, pair[:, 0], pair[:, 1])

        for batch in batches:
            columns = [batch.column(k).to_numpy() for k in range(len(by) + 1)]
            if held:
                columns = [np.concatenate([x, y]) for x, y in zip(held, columns, strict=True)]
            last = tuple(c[-1] for c in columns[:-1])
            tail = np.logical_and.reduce([c == v for c, v in zip(columns[:-1], last, strict=True)])
            cut = int(tail.argmax())
            if cut:
                done = [c[:cut] for c in columns]
                if over is not None:
                    own = np.logical_and.reduce([c == v for c, v in zip(done[:-1], over, strict=True)])
                    if own.any():
                        yield out(done[0][own], done[1][own], done[-1][own])
                        done = [c[~own] for c in done]
                    over = None
                yield from compare(done[:-1], done[-1].view(np.uint64))
            held = [c[cut:] for c in columns]
            if most is not None and (over == last or held[-1].size > most):
                yield out(held[0], held[1], held[-1])
                over, held = last, []
        if held:
            yield from compare(held[:-1], held[-1].view(np.uint64))

    dealt = rows.repartition(*by).sortWithinPartitions(*by, "fp")
    return dealt.mapInArrow(run, "kind int, a long, b long")


def fingerprint_links(nodes: DataFrame, work: Work, distance: int = DISTANCE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """nodes(fp long), distinct -> edges (a, b) that connect the same fingerprints as all links within distance do."""
    n, both = bit_statistics(nodes)
    some = nodes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    sample = np.array([r.fp for r in some], np.int64).view(np.uint64)
    rows = bucket_rows(nodes, bucket_masks(make_plan(n, both, distance, sample)))
    found = work.save(link_buckets(rows, ["kind", "value"], distance, block_rows), "links")
    links = found.where("kind = -1").select("a", "b")
    large = found.where("kind >= 0").select("kind", F.col("a").alias("value"), F.col("b").alias("fp"))
    sizes = large.groupBy("kind", "value").agg(F.ceil(2 * F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias("blocks"))
    if sizes.isEmpty():
        return links
    # a fingerprint of block i goes to the tasks of (i, j) for all j, so that any two blocks meet in one task
    large = large.join(work.save(sizes, "large"), ["kind", "value"])
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    large = large.select("kind", "value", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    large = large.where("own <> other")  # there are three blocks at least, so a block meets itself anyway
    large = large.select("kind", "value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    more = link_buckets(large, ["kind", "value", "i", "j"], distance, None)
    return links.unionByName(work.save(more.select("a", "b"), "more_links"))


def simhash_dedup(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Groups the rows of docs(doc_id, text) whose SimHash fingerprints are linked, directly or through others.

    Returns one row per input row: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id of the group).

    A null text is empty; texts without words have fingerprint zero and are linked like any others. A null
    doc_id is kept and is never a component_id unless all ids of its group are null. Repeated rows share a
    group. Other columns are ignored. An empty table gives no rows.
    """
    work = Work(docs.sparkSession, "simhash")
    rows = work.save(fingerprints(docs, shingle), "fingerprints")
    nodes = work.save(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(fingerprint_links(nodes, work, distance, block_rows), work)
    rooted = work.save(
        nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")),
        "rooted",
    )
    groups = work.save(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "groups")
    named = work.save(rooted.join(groups, "root").select("fp", "component_id"), "named")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(named, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")
