"""Best-fit packing of tokenised documents into sequences of bounded length.

Token counts are at most `capacity`, so how many pieces there are of each length is a table of bounded size,
whatever the corpus. The packing is planned on that table alone: exact complements (single, pair and triple
lengths that fill the gap of the longest length left, looked up in an index by their sum and consumed as often
as their availability allows), and best fit for a gap that nothing fills. The plan is a bounded list of
(lengths, how many sequences have them). Pieces get a rank within their length, counted in parts of PART_ROWS so
that a common length is spread over as many tasks as it needs, and look up their sequence and offset in the plan
by (length, rank).
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Work, pieces, texts
from .tokenise import WordTokenizer

CAPACITY = 4096
END_ID = 1
#: Pieces of one length that a task ranks.
PART_ROWS = 1_000_000

Plan = list[tuple[tuple[int, ...], int]]


class Complements:
    """Availability of lengths, and an index of what sums to a gap: a length, two (listed by their sum once, for the
    lengths there are at the start), or three (a length, and what the index has for the rest of the gap)."""

    def __init__(self, counts: np.ndarray):
        self.count = counts.astype(np.int64)
        there = np.flatnonzero(self.count)
        there = there[there > 0]
        high, low = (x.ravel() for x in np.meshgrid(there, there, indexing="ij"))
        fits = (high >= low) & (high + low < len(counts))
        high, low = high[fits], low[fits]
        order = np.lexsort((-high, high + low))  # by sum, the most uneven pair first
        self.high, sums = high[order], (high + low)[order]
        self.at = np.searchsorted(sums, np.arange(len(counts) + 1))

    def take(self, lengths: tuple[int, ...], times: int) -> None:
        for x in lengths:
            self.count[x] -= times

    def times(self, lengths: tuple[int, ...]) -> int:
        """How often the lengths can be taken together."""
        return int(min(self.count[x] // n for x, n in Counter(lengths).items()))

    def pair(self, total: int) -> tuple[int, ...]:
        """Two lengths that sum to total, the most uneven that are there."""
        high = self.high[self.at[total] : self.at[total + 1]]
        there = (self.count[high] > 0) & (self.count[total - high] > (2 * high == total))
        at = int(there.argmax()) if high.size else 0
        return (int(high[at]), int(total - high[at])) if high.size and there[at] else ()

    def exact(self, gap: int, most: int = 3) -> tuple[int, ...]:
        """One, else two, else three lengths that fill the gap exactly; at most `most`."""
        if self.count[gap] > 0:
            return (gap,)
        if most >= 2 and (two := self.pair(gap)):
            return two
        if most < 3:
            return ()
        for x in np.flatnonzero(self.count[: max(1, gap - 1)])[::-1].tolist():
            if 3 * x < gap:  # x is to be the longest of the three
                break
            self.count[x] -= 1
            two = self.pair(gap - x)
            self.count[x] += 1
            if two:
                return (x, *two)
        return ()

    def longest(self, gap: int) -> tuple[int, ...]:
        """The longest length that fits."""
        there = np.flatnonzero(self.count[: gap + 1])
        return (int(there[-1]),) if there.size else ()


def plan_packing(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """Patterns of lengths and how many sequences follow each; counts[x] pieces of length x, 1 <= x <= capacity.

    Short pieces that fill one gap exactly may be missed in another, so gaps are filled by up to three, two and one
    lengths at a time, and the plan with the fewest sequences is taken. That of one at a time has as many as first fit
    of the lengths in descending order.
    """
    plans = [plan_with(counts, capacity, most) for most in (3, 2, 1)]
    return min(plans, key=lambda plan: sum(n for _, n in plan))


def plan_with(counts: np.ndarray, capacity: int, most: int) -> Plan:
    """The plan with at most `most` lengths for a gap.

    The longest piece left opens a sequence. What fills its gap exactly is taken; where nothing does, the piece that
    leaves least of the gap, and then what fills the rest. As many sequences follow a pattern as there are pieces for.
    """
    have, plan = Complements(counts), []
    for length in range(capacity, 0, -1):
        while have.count[length] > 0:
            pattern, gap = (length,), capacity - length
            have.take(pattern, 1)
            while gap and (found := have.exact(gap, most) or have.longest(gap)):
                have.take(found, 1)
                pattern, gap = pattern + found, gap - sum(found)
            have.take(pattern, -1)
            n = have.times(pattern)
            have.take(pattern, n)
            plan.append((pattern, n))
    return plan


def slots(plan: Plan) -> dict[int, np.ndarray]:
    """For each length an array of rows (first rank, first sequence, offset), by rank: a rank belongs to the last
    row that does not lie beyond it."""
    out: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    sequence = 0
    for pattern, n in plan:
        offset = 0
        for length in pattern:
            out[length].append((used[length], sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    return {k: np.array(v, np.int64) for k, v in out.items()}


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int, keep_ids: bool) -> DataFrame:
    """Each document's ids, end_id appended, cut into pieces of capacity ids; the last may be shorter."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(path)
        for batch in pieces(batches):
            found = words.ids(batch.column(1).to_pylist())
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), found, strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for n, start in enumerate(range(0, ids.size, capacity)):
                    part = ids[start : start + capacity]
                    rows.append((doc_id, n, start, part.size, zlib.crc32(part.tobytes()), part))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())][: 6 if keep_ids else 5]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = PIECES + ", ids array<int>" * keep_ids
    names = [x.split()[0] for x in schema.split(", ")]
    return texts(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def best_fit_packing(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    keep_ids: bool = True,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Packs docs(doc_id, text) into sequences of at most capacity token ids.

    Returns one row per piece: doc_id, piece (from 0), start (ids of its document before it), length, ids_crc32,
    ids (with keep_ids), sequence_id and offset (its place there). Sequences have no gaps. Only documents of
    more than capacity ids are cut. The number of sequences is not proven least: packing is NP-hard.

    A null text is empty and gives the end id alone. A null doc_id and repeated rows are packed as they are.
    Pieces of one length are taken in the order of their rows. Other columns are ignored. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    work = Work(spark, "packing")
    cut = token_pieces(docs, tokenizer_path, capacity, end_id, keep_ids).withColumn("_row", F.monotonically_increasing_id())
    cut = work.save(cut, "pieces")
    # capacity rows, whatever the corpus
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in cut.groupBy("length").count().collect():
        counts[length] = n
    places = slots(plan_packing(counts, capacity))
    common = [(x, int(n) // part_rows + 1) for x, n in enumerate(counts) if n > part_rows]
    parts = F.broadcast(spark.createDataFrame(common, "length long, _parts long"))
    cut = cut.join(parts, "length", "left").withColumn("_part", F.pmod(F.xxhash64("_row"), F.coalesce("_parts", F.lit(1))))
    # a row per length, and one more for every part_rows pieces
    sizes = cut.groupBy("length", "_part").count().collect()
    before = {x: np.zeros(n + 1, np.int64) for x, n in common}
    for length, part, n in sizes:
        if length in before:
            before[length][part + 1] = n
    before = {x: n.cumsum() for x, n in before.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, part, rank = (batch.column(batch.num_columns - k).to_numpy() for k in (3, 2, 1))
            sequence, offset = np.empty((2, len(length)), np.int64)
            for x in np.unique(length).tolist():
                own = length == x
                r = before[x][part[own]] + rank[own] if x in before else rank[own]
                rows = places[x]
                at = rows[np.searchsorted(rows[:, 0], r, side="right") - 1]
                sequence[own], offset[own] = at[:, 1] + r - at[:, 0], at[:, 2]
            kept = [batch.column(k) for k in range(batch.num_columns - 3)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names)

    within = Window.partitionBy("length", "_part").orderBy("_row")
    kept = [c for c in cut.columns if not c.startswith("_")]
    kept.insert(3, kept.pop(kept.index("length")))
    names = [*kept, "sequence_id", "offset"]
    kinds = dict(cut.dtypes) | {"sequence_id": "long", "offset": "long"}
    ranked = cut.select(*kept, F.col("length").alias("_length"), "_part", (F.row_number().over(within) - 1).cast("long"))
    return ranked.mapInArrow(place, ", ".join(f"`{c}` {kinds[c].replace('bigint', 'long')}" for c in names))
