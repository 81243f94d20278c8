"""Repair of the turn structure of conversations by a shortest path over (row, grammar state).

A conversation's rows are edited at least cost until their role initials read (s?(ua)+)?. The cost to go from a row and a
state of that grammar is computed backwards, and a forward walk takes at each row the ASCII-least edit whose cost is
tight. Every row is a step of a min-plus product of 4 x 4 matrices, so a conversation is cut into blocks of bounded size:
the blocks' products give the cost to go at the end of each, and from there a block is solved alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Work

#: Grammar states: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"
#: Faults of a row, by number.
FAULTS = ("", "blank", "duplicate", "truncated")
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
REROLE, DELETE, INSERT = 2, 3, 2
#: The state after a user or assistant turn that each state lets follow, and that turn's role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = ("user", "user", "assistant", "user")
#: The states in which an initial may be kept, and the state after it.
KEPT = ({START: SYSTEM}, {START: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {})
#: Cost to go after the last row.
END = (0, 2 * INSERT, INSERT, 0)
FAR = 1 << 40
#: Rows of one part of the sorted table that make a block.
BLOCK_BITS = 12
SPACE = "\\x20\\x09-\\x0D"


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with nulls as one space, damaged by crc32 of `conv_id:turn` modulo 20."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn")).cast("binary")), F.lit(20))
    role = F.when(kind == 4, "user").otherwise(or_space("role"))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(or_space("text"), ".!?", "")).otherwise(or_space("text"))
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("_n")).drop("_n")


def backward(codes: Sequence[int], end: Sequence[int]) -> list[tuple[int, int, int, int]]:
    """Cost to go from before each row and after the last, by state. codes: 4 * place of the initial in INITIALS + fault."""
    c0, c1, c2, c3 = end
    out = [(c0, c1, c2, c3)]
    for code in reversed(codes):
        initial, fault = code >> 2, code & 3
        r0, r1, r2, r3 = DELETE + c0, DELETE + c1, DELETE + c2, DELETE + c3
        if fault not in (BLANK, DUPLICATE):
            own = int(fault == TRUNCATED)
            u, a = own + c2, own + c3
            r0, r1, r2, r3 = min(r0, REROLE + u), min(r1, REROLE + u), min(r2, REROLE + a), min(r3, REROLE + u)
            if initial == 0:
                r0 = min(r0, own + c1)
            elif initial == 1:
                r0, r1, r3 = min(r0, u), min(r1, u), min(r3, u)
            elif initial == 2:
                r2 = min(r2, a)
        c2, c3 = min(r2, INSERT + r3), min(r3, INSERT + r2)
        c0, c1 = min(r0, INSERT + c2), min(r1, INSERT + c2)
        out.append((c0, c1, c2, c3))
    return out[::-1]


def transfer(codes: Sequence[int]) -> list[int]:
    """The 16 least costs of a block, from each state before it to each state after it."""
    columns = [backward(codes, [0 if k == end else FAR for k in range(4)])[0] for end in range(4)]
    return [min(FAR, columns[end][state]) for state in range(4) for end in range(4)]


def forward(codes: Sequence[int], costs: Sequence[Sequence[int]], state: int) -> Iterator[tuple[int, str, str | None, int]]:
    """(row, edit, new role or None, state after it) of the ASCII-least of the cheapest edits; row is where an insert goes before."""
    for k, code in enumerate(codes):
        initial, own = code >> 2, int(code & 3 == TRUNCATED)
        while True:
            left, after = costs[k][state], costs[k + 1]
            if DELETE + after[state] == left:
                yield k, "D", None, state
                break
            following = NEXT[state]
            if INSERT + costs[k][following] == left:
                yield k, "I", ROLE[state], following
                state = following
                continue
            kept = KEPT[initial].get(state)
            if kept is not None and own + after[kept] == left:
                state = kept
                yield k, "K", None, state
                break
            role, state = ROLE[state], following
            yield k, "R", role, state
            break


def _coded(rows: DataFrame, work: Work) -> tuple[DataFrame, DataFrame]:
    """The damaged or given rows, sorted, numbered and written; and their blocks with the codes of their rows and the cost
    to go at their ends.

    The sort deals rows by ranges of (conversation, turn, role, digest of the text), so a conversation of any size is
    spread. Which of equal turns came first is a minimum by digest, and blocks meet as one small row for each."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"))
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    rows = rows.select("*", digest.alias("digest"), F.monotonically_increasing_id().alias("_in"))
    blank, cut = ~F.col("text").rlike(f"[^{SPACE}]"), ~F.col("text").rlike(f"[.!?][{SPACE}]*\\z")
    initial = F.substring("role", 1, 1)
    place = F.lit(3)
    for k, letter in enumerate(INITIALS):
        place = F.when(initial == letter, k).otherwise(place)
    rows = rows.select("*", place.alias("initial"), F.when(blank, BLANK).when(cut, TRUNCATED).otherwise(0).alias("fault"))
    rows = rows.orderBy("conv_id", F.col("turn").asc_nulls_first(), "role", "digest", "_in").drop("_in")
    rows = work.save(rows.withColumn("id", F.monotonically_increasing_id()), "rows")
    light = rows.select("conv_id", "id", "role", "digest", "initial", "fault")
    first = light.where(F.col("fault") != BLANK).groupBy("conv_id", "role", "digest").agg(F.min("id").alias("_first")).select("_first")
    light = light.join(first, F.col("id") == F.col("_first"), "left")
    fault = F.when((F.col("fault") != BLANK) & F.col("_first").isNull(), DUPLICATE).otherwise(F.col("fault"))
    light = light.select("conv_id", "id", (F.col("initial") * 4 + fault).cast("byte").alias("code"))
    ordered = F.array_sort(F.collect_list(F.struct("id", "code")))
    blocks = light.groupBy("conv_id", F.shiftright("id", BLOCK_BITS).alias("_b")).agg(F.min("id").alias("id"), F.transform(ordered, lambda x: x["code"]).alias("codes"))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [transfer(codes) for codes in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int64()))], ["conv_id", "id", "codes", "product"])

    kind = rows.schema["conv_id"].dataType.simpleString()
    blocks = blocks.select("conv_id", "id", "codes").mapInArrow(products, f"conv_id {kind}, id long, codes array<byte>, product array<bigint>")
    blocks = work.save(blocks, "blocks")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, costs = [], []
            for chain in batch.column(0).to_pylist():
                cost = list(END)
                for block in reversed(chain):
                    ids.append(block["id"])
                    costs.append(cost)
                    p = block["product"]
                    cost = [min(p[4 * q + e] + cost[e] for e in range(4)) for q in range(4)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(costs, pa.list_(pa.int64()))], ["_id", "end"])

    # most conversations are one block, whose end is that of the conversation
    chains = blocks.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("id", "product"))).alias("chain"))
    chains = chains.where("n > 1").select("chain").mapInArrow(ends, "_id long, end array<bigint>")
    last = F.array(*(F.lit(x).cast("long") for x in END))
    return rows, blocks.join(chains, F.col("id") == F.col("_id"), "left").select("conv_id", "id", "codes", F.coalesce("end", last).alias("end"))


class Walk:
    """One conversation at a time, its blocks and rows in order. Between two rows it holds one block's codes and edits."""

    def __init__(self, conv_id):
        self.conv_id, self.state, self.edits, self.codes, self.k = conv_id, START, [], [], 0
        self.cost: int | None = None
        self.audit: list[str] = []
        self.counts, self.illegal, self.before = [0, 0, 0, 0], 0, None
        self.least = self.most = self.turn = None
        self.turns, self.rows, self.hash, self.hashed = 0, 0, hashlib.sha256(), 0

    def block(self, codes: list[int], end: list[int]) -> None:
        costs = backward(codes, end)
        if self.cost is None:
            self.cost = costs[0][START]
        self.codes, self.k, self.edits = codes, 0, [[] for _ in codes]
        for k, edit, role, state in forward(codes, costs, self.state):
            self.edits[k].append((edit, role))
            self.state = state

    def row(self, turn: int | None, role: str, text: str) -> Iterator[tuple[int | None, str, str, str, str]]:
        """(turn, edit, fault, role, text) of the row and of what is inserted before it."""
        fault, edits = self.codes[self.k] & 3, self.edits[self.k]
        self.k, self.rows = self.k + 1, self.rows + 1
        self.counts[fault] += 1
        initial = role[:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.turns += turn != self.turn
            self.turn = self.most = turn
        for edit, new in edits:
            yield self.out(turn, edit, new or role, "" if edit == "I" else text, "" if edit == "I" else FAULTS[fault])

    def rest(self) -> Iterator[tuple[int | None, str, str, str, str]]:
        while self.state in (SYSTEM, USER):
            role, self.state = ROLE[self.state], NEXT[self.state]
            yield self.out(self.most, "I", role, "", "")

    def out(self, turn, edit: str, role: str, text: str, fault: str):
        self.audit.append(edit)
        if edit != "D":
            self.hash.update(f"{chr(10) if self.hashed else ''}{role}:{text}".encode())
            self.hashed += 1
        return turn, edit, fault, role, text

    def report(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (self.conv_id, gaps, *self.counts[1:], self.illegal, self.cost or 0, "".join(self.audit), self.hash.hexdigest(), self.rows, self.hashed)


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, n_rows long, n_repaired long"
TURNS = "place long, turn long, edit string, fault string, role string, text string"


def _stream(rows: DataFrame, original: DataFrame, work: Work, turns: bool) -> DataFrame:
    """Blocks go beside the rows that they decide on: one exchange by conversation, read in order. A digest of the whole
    repaired conversation has to see its bytes in order, so a conversation streams through one task, a row at a time."""
    rows, blocks = _coded(rows, work)
    kind = rows.schema["conv_id"].dataType.simpleString()
    none = lambda t: F.lit(None).cast(t)
    marks = original.select("conv_id").distinct().select("conv_id", F.lit(-1).cast("long").alias("id"), F.lit(0).alias("kind"), none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"), none("array<byte>").alias("codes"), none("array<bigint>").alias("end"))
    decided = blocks.select("conv_id", "id", F.lit(1), none("long"), none("string"), none("string"), "codes", "end")
    given = rows.select("conv_id", "id", F.lit(2), "turn", "role", "text", none("array<byte>"), none("array<bigint>"))
    stream = marks.union(decided).union(given).repartition("conv_id").sortWithinPartitions("conv_id", "id", "kind")
    schema = f"conv_id {kind}, {TURNS if turns else REPORT}"
    types = [pa.string() if t.endswith("string") else pa.int64() for t in schema.split(", ")[1:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, kept, conv_type, size = None, [], None, 0

        def flush() -> pa.RecordBatch:
            columns = list(zip(*kept, strict=True)) or [()] * (len(types) + 1)
            kept.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [conv_type, *types], strict=True)], schema=pa.schema(list(zip(names, [conv_type, *types], strict=True))))

        def closed() -> Iterator[tuple]:
            place = walk.rows + len(walk.audit)
            for n, x in enumerate(walk.rest()):
                if turns:
                    yield (walk.conv_id, place + n, *x)
            if not turns:
                yield walk.report()

        for whole in batches:
            conv_type = whole.schema.field(0).type
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                for conv_id, kind_, turn, role, text, codes, end in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "kind", "turn", "role", "text", "codes", "end")), strict=True):
                    if kind_ == 0:
                        if walk is not None:
                            kept.extend(closed())
                        walk = Walk(conv_id)
                    elif kind_ == 1:
                        walk.block(codes, end)
                    else:
                        for x in walk.row(turn, role, text):
                            if turns:
                                kept.append((conv_id, walk.rows + len(walk.audit) - 1, *x))
                                size += len(text)
                    if len(kept) >= 1000 or size > 1 << 22:
                        size = 0
                        yield flush()
        if walk is not None:
            kept.extend(closed())
            yield flush()

    names = [c.split(" ")[0] for c in schema.split(", ")]
    return stream.mapInArrow(run, schema)


def repair_report(rows: DataFrame, original: DataFrame | None = None) -> DataFrame:
    """One row for each conversation of original (by default of rows): conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256, n_rows (before the repair), n_repaired (after it).

    rows(conv_id, turn, role, text): null roles and texts are one space; a null turn comes first and counts neither as turn
    nor as gap; a null conv_id is a conversation of its own. Rows of one turn are ordered by role, then by the SHA-256 of their
    text; equal rows stay, and all but the first are duplicates. A conversation without rows has zeros, an empty audit and the
    hash of nothing. Roles are judged by their first letter alone, and an empty or unknown one cannot be kept. Other columns
    are ignored; an empty table gives no rows.
    """
    return _stream(rows, rows if original is None else original, Work(rows.sparkSession, "conversations"), False)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The edits of all conversations, in order: conv_id, place (rises within a conversation), turn, edit (K, R, D or I), fault,
    role, text. The repaired conversation is what is left without the edits D. Awkward rows as in repair_report()."""
    return _stream(rows, rows, Work(rows.sparkSession, "conversations"), True)


def crc32_sql(text: str) -> str:
    """crc32 of a text as DuckDB SQL: a reflected shift register over the bits of its ASCII bytes."""
    bytes_ = f"list_transform(range(1, length({text}) + 1), lambda i: unicode(substr({text}, i, 1)))"
    bits = f"flatten(list_transform({bytes_}, lambda b: [b::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    step = "lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))"
    return f"xor(list_reduce({bits}, {step}, 4294967295::BIGINT), 4294967295)"


CONVERSATION_REPAIR_SQL = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32_sql("k")} % 20 AS kind
  FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations)
), damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM keyed, range(0, CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) t(n)
), convs AS MATERIALIZED (SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS g FROM (SELECT DISTINCT conv_id FROM conversations)
), placed AS (
  SELECT g, turn, role, text, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, sha256(text)) AS i, count(*) OVER (PARTITION BY g) AS n
  FROM damaged d JOIN convs c ON d.conv_id IS NOT DISTINCT FROM c.conv_id
), steps AS MATERIALIZED (
  SELECT *, NOT regexp_matches(text, '[^{SPACE}]') AS blank, NOT regexp_matches(text, '[^{SPACE}]') OR row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 AS bad,
    regexp_matches(text, '[^.!?{SPACE}][{SPACE}]*$')::INT AS cut, CASE WHEN role = '' THEN 'x' ELSE role[1] END AS r, lag(role[1]) OVER (PARTITION BY g ORDER BY i) || role[1] AS pair
  FROM placed
), back AS (
  SELECT g, max(i) + 1 AS i, 0 AS c0, 4 AS c1, 2 AS c2, 0 AS c3 FROM steps GROUP BY g
  UNION ALL
  SELECT g, i, least(r0, 2 + least(r2, 2 + r3)), least(r1, 2 + least(r2, 2 + r3)), least(r2, 2 + r3), least(r3, 2 + r2) FROM (
    SELECT b.g, s.i,
      least(3 + c0, CASE WHEN bad THEN 999999999 ELSE cut + least(2 + c2, CASE r WHEN 's' THEN c1 WHEN 'u' THEN c2 ELSE 999999999 END) END) AS r0,
      least(3 + c1, CASE WHEN bad THEN 999999999 ELSE cut + least(2 + c2, CASE r WHEN 'u' THEN c2 ELSE 999999999 END) END) AS r1,
      least(3 + c2, CASE WHEN bad THEN 999999999 ELSE cut + least(2 + c3, CASE r WHEN 'a' THEN c3 ELSE 999999999 END) END) AS r2,
      least(3 + c3, CASE WHEN bad THEN 999999999 ELSE cut + least(2 + c2, CASE r WHEN 'u' THEN c2 ELSE 999999999 END) END) AS r3
    FROM back b JOIN steps s ON s.g = b.g AND s.i = b.i - 1)
), togo AS MATERIALIZED (SELECT g, i, [c0, c1, c2, c3] AS c FROM back
), walk AS (
  SELECT g, 1::BIGINT AS i, 0 AS q, '' AS audit, NULL::VARCHAR AS said FROM togo WHERE i = 1
  UNION ALL
  SELECT g, CASE WHEN e = 'I' THEN i ELSE i + 1 END, CASE e WHEN 'D' THEN q WHEN 'K' THEN kept ELSE following END, audit || e, CASE e WHEN 'D' THEN said
    ELSE coalesce(said || chr(10), '') || CASE WHEN e = 'K' THEN role ELSE CASE following WHEN 2 THEN 'user' ELSE 'assistant' END END || ':' || CASE e WHEN 'I' THEN '' ELSE text END END
  FROM (SELECT *, CASE WHEN i > n THEN 'I' WHEN 3 + after[q + 1] = now[q + 1] THEN 'D' WHEN 2 + now[following + 1] = now[q + 1] THEN 'I'
      WHEN NOT bad AND cut + after[kept + 1] = now[q + 1] THEN 'K' ELSE 'R' END AS e
    FROM (SELECT w.*, s.role, s.text, bad, cut, t.c AS now, u.c AS after, CASE WHEN w.q = 2 THEN 3 ELSE 2 END AS following, coalesce(s.n, w.i - 1) AS n,
        CASE WHEN s.r = 's' AND w.q = 0 THEN 1 WHEN s.r = 'u' AND w.q <> 2 THEN 2 WHEN s.r = 'a' AND w.q = 2 THEN 3 END AS kept
      FROM walk w JOIN togo t ON t.g = w.g AND t.i = w.i LEFT JOIN togo u ON u.g = w.g AND u.i = w.i + 1 LEFT JOIN steps s ON s.g = w.g AND s.i = w.i
      WHERE s.i IS NOT NULL OR w.q IN (1, 2)))
), ended AS (
  SELECT g, audit, said FROM walk QUALIFY row_number() OVER (PARTITION BY g ORDER BY i DESC, length(audit) DESC) = 1
), facts AS (
  SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(bad AND NOT blank) AS duplicate, count_if(NOT bad AND cut = 1) AS truncated,
    count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal FROM steps GROUP BY g
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(t.c[1], 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM convs LEFT JOIN facts USING (g) LEFT JOIN (SELECT g, c FROM togo WHERE i = 1) t USING (g) LEFT JOIN ended USING (g)"""
