"""Secrets in texts: patterns for the known forms, and automata inferred from what those find for the forms they miss.

The values that the patterns find are labelled credentials. For each kind the prefix tree of all of them is generalised by
merging states whose outgoing frequencies are statistically compatible, down to a small probabilistic automaton; so are the
two halves of all other candidates, which are ordinary. A candidate that some kind's automaton makes much likelier than that
of the other half of the ordinary ones does, more so than all but a few candidates, is added under that kind.

No machine holds the values or their tree. All of them go through the automata as far as these are known, and Spark counts
what follows at each state and at each first unknown step; from the counts the driver settles those steps, and so on until
all values go through.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captionloom.operators.quantiles import ranked_values

from .common import Work, texts

# fixed values: the patterns, their kinds in order and least lengths
KINDS = ("assign", "access", "hex")
ASSIGN = "(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "(?<![0-9a-f])[0-9a-f]{32,}"
LEAST_VALUE = 8
#: A candidate is a longest run of these characters, of eight or more with a digit among them, and up to two = after it.
LETTER = "[A-Za-z0-9+/_.-]"
CANDIDATE = f"(?<!{LETTER})(?=[A-Za-z+/_.-]*[0-9]){LETTER}{{8,}}={{0,2}}"
SYMBOLS = 66
#: A step becomes a state of its own if one value in so many takes it; rarer ones join the state they differ least from.
LEAST_SHARE = 1000
#: Symbols that are counted ahead of a state, and the mark of a value's end among them, which no value has.
AHEAD, END = 2, "\n"
#: Significance with which two states count as different.
ALPHA = 0.05
#: Least log-likelihood ratio of an added span, and the share of ordinary candidates that may exceed the limit
#: (at least one, as some may be secrets).
MARGIN, RATE = math.log(1e6), 0.01
ORDINARY = "ordinary"


@dataclass
class Automaton:
    """States by number, 0 the first; arrivals and ends are counts, moves[state][symbol] = [next state, count]."""

    arrivals: list[int]
    ends: list[int]
    moves: list[dict[str, list[int]]]

    @classmethod
    def tree(cls, words: Iterable[str]) -> Automaton:
        """The prefix tree of the words."""
        out = cls([0], [0], [{}])
        for word in words:
            at = 0
            out.arrivals[0] += 1
            for symbol in word:
                move = out.moves[at].get(symbol)
                if move is None:
                    move = out.moves[at][symbol] = [len(out.ends), 0]
                    out.arrivals.append(0)
                    out.ends.append(0)
                    out.moves.append({})
                move[1] += 1
                at = move[0]
                out.arrivals[at] += 1
            out.ends[at] += 1
        return out

    def difference(self, a: int, b: int, bound: float, most: float = 1) -> float | None:
        """The largest difference of two states' frequencies, and of the states they lead to alike, as a share of what
        Hoeffding's bound allows; None if it exceeds `most`. b is the root of a tree."""
        worst, todo = 0.0, [(a, b)]
        while todo:
            p, q = todo.pop()
            n, m = self.arrivals[p], self.arrivals[q]
            if not n or not m:
                continue
            allowed = bound * (n**-0.5 + m**-0.5)
            here, there = self.moves[p], self.moves[q]
            apart = abs(self.ends[p] / n - self.ends[q] / m)
            for symbol in here.keys() | there.keys():
                x, y = here.get(symbol), there.get(symbol)
                apart = max(apart, abs((x[1] if x else 0) / n - (y[1] if y else 0) / m))
                if x and y:
                    todo.append((x[0], y[0]))
            worst = max(worst, apart / allowed)
            if worst > most:
                return None
        return worst

    def fold(self, a: int, b: int) -> None:
        """Adds the tree below b to state a and what follows it."""
        todo = [(a, b)]
        while todo:
            p, q = todo.pop()
            self.arrivals[p] += self.arrivals[q]
            self.ends[p] += self.ends[q]
            for symbol, (target, n) in self.moves[q].items():
                move = self.moves[p].get(symbol)
                if move is None:
                    self.moves[p][symbol] = [target, n]
                else:
                    move[1] += n
                    todo.append((move[0], target))

    @classmethod
    def inferred(cls, words: Iterable[str], alpha: float = ALPHA) -> Automaton:
        """The words' prefix tree with compatible states merged. Of the states next to those that are settled, the most
        frequent comes first; it joins the settled state that it differs least from, or is settled itself."""
        out = cls.tree(sorted(words))
        bound = math.sqrt(0.5 * math.log(2 / alpha))
        settled = [0]
        known = {0}
        while True:
            edge = [(out.arrivals[t], -t, s, symbol) for s in settled for symbol, (t, _) in out.moves[s].items() if t not in known]
            if not edge:
                break
            _, t, s, symbol = max(edge)
            near = [(d, k) for k, r in enumerate(settled) if (d := out.difference(r, -t, bound)) is not None]
            if near:
                joined = settled[min(near)[1]]
                out.moves[s][symbol][0] = joined
                out.fold(joined, -t)
            else:
                settled.append(-t)
                known.add(-t)
        number = {s: k for k, s in enumerate(settled)}
        moves = [{symbol: [number[t], n] for symbol, (t, n) in out.moves[s].items()} for s in settled]
        return cls([out.arrivals[s] for s in settled], [out.ends[s] for s in settled], moves)

    def log_likelihood(self, word: str) -> float:
        """Half a count is spread over the symbols and the end, so that nothing is impossible; after a symbol that was never
        met in a state, the word goes on from the first state."""
        at, total, spread = 0, 0.0, 0.5 / (SYMBOLS + 1)
        for symbol in word:
            move = self.moves[at].get(symbol)
            total += math.log(((move[1] if move else 0) + spread) / (self.arrivals[at] + 0.5))
            at = move[0] if move else 0
        return total + math.log((self.ends[at] + spread) / (self.arrivals[at] + 0.5))


def half(value: str) -> int:
    """The half of the ordinary candidates that a value is in, as half_of() has it."""
    return zlib.crc32(value.encode()) & 1


def half_of(value: Column) -> Column:
    return F.crc32(value.cast("binary")).bitwiseAND(F.lit(1).cast("long"))


@dataclass
class Formats:
    """The automata by kind, those of ordinary candidates (one, or one by which each half is judged), and the limit above which a
    candidate's score makes it a secret."""

    kinds: dict[str, Automaton]
    ordinary: list[Automaton]
    limit: float

    def score(self, word: str) -> tuple[float, str]:
        """The largest log-likelihood ratio against ordinary candidates, and its kind; of equals the first kind."""
        usual = self.ordinary[half(word) % len(self.ordinary)].log_likelihood(word)
        scores = [(a.log_likelihood(word) - usual, -k) for k, a in enumerate(self.kinds.values())]
        best, k = max(scores, default=(-math.inf, 0))
        return best, list(self.kinds)[-k] if self.kinds else ""

    @classmethod
    def learned(cls, values: dict[str, list[str]]) -> Formats:
        """From a few distinct values by kind, in memory; learn() is for tables. Every other ordinary candidate is held out of the
        automaton for the limit."""
        ordinary = sorted(values.get(ORDINARY, []))
        kinds = {k: Automaton.inferred(values[k]) for k in KINDS if values.get(k)}
        out = cls(kinds, [Automaton.inferred(ordinary[::2])], MARGIN)
        scores = sorted((out.score(x)[0] for x in ordinary[1::2]), reverse=True)
        if scores:
            out.limit = max(MARGIN, scores[min(len(scores) - 1, math.ceil(RATE * len(scores)))])
        return out


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[str, str]]]:
    """(start, kind's place in KINDS, end) of what the patterns find, sorted, and its values with their kinds."""
    spans, values = [], []
    for m in re.finditer(ASSIGN, text, re.IGNORECASE | re.ASCII):
        if len(m.group(2)) >= LEAST_VALUE:
            spans.append((m.start(), 0, m.end()))
            values.append(("assign", m.group(2)))
    for k, pattern in ((1, ACCESS), (2, HEX)):
        for m in re.finditer(pattern, text):
            spans.append((m.start(), k, m.end()))
            values.append((KINDS[k], m.group()))
    return sorted(spans), values


def other_candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, str]]:
    """(start, end, value) of the candidates that touch no span."""
    starts, reach, most = [s for s, _, _ in spans], [], 0
    for _, _, end in spans:
        most = max(most, end)
        reach.append(most)
    out = []
    for m in re.finditer(CANDIDATE, text):
        before = bisect_right(starts, m.end() - 1) - 1
        if before < 0 or reach[before] <= m.start():
            out.append((m.start(), m.end(), m.group()))
    return out


def joined(spans: Iterable[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{start}:{end}" for start, k, end in spans)


SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int64()), ("end", pa.int64())])
FOUND = "doc_id {}, spans array<struct<start:bigint,kind:bigint,end:bigint>>, labelled array<struct<kind:string,value:string>>, others array<struct<start:bigint,end:bigint,value:string>>"


def found_in(docs: DataFrame) -> DataFrame:
    """doc_id, spans of the patterns, labelled values, and other candidates of each row. Columns decide which texts hold any
    of them; only those reach Python."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    types = [pa.list_(SPAN), pa.list_(pa.struct([("kind", pa.string()), ("value", pa.string())])), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch, rows = whole.slice(start, 256), []
                for text in batch.column(1).to_pylist():
                    spans, values = base_spans(text) if text else ([], [])
                    others = other_candidates(text, spans) if text else []
                    rows.append(
                        (
                            [dict(zip(("start", "kind", "end"), s, strict=True)) for s in spans],
                            [{"kind": k, "value": v} for k, v in values],
                            [dict(zip(("start", "end", "value"), s, strict=True)) for s in others],
                        )
                    )
                columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "spans", "labelled", "others"])

    t = F.col("text")
    hold = t.rlike(f"(?i){ASSIGN}") | t.rlike(ACCESS) | t.rlike(HEX) | t.rlike(CANDIDATE)
    return texts(docs).select("doc_id", F.when(hold, t).alias("text")).mapInArrow(run, FOUND.format(kind))


def followed(values: DataFrame, automata: dict[str, Automaton]) -> DataFrame:
    """kind, state, symbol, ahead, n: of values(kind, value), how many visits of a state are followed by what (symbol is empty), and
    how many values leave a state by a symbol that it has no move for, where they stop, and are followed by what there."""
    moves = {k: [{symbol: to for symbol, (to, _) in m.items()} for m in a.moves] for k, a in automata.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[str, int, str, str]] = Counter()
        for batch in batches:
            for kind, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at, ways, marked = 0, moves[kind], value + END
                for k, symbol in enumerate(marked):
                    counts[kind, at, "", marked[k : k + AHEAD]] += 1
                    if symbol == END:
                        break
                    to = ways[at].get(symbol)
                    if to is None:
                        counts[kind, at, symbol, marked[k + 1 : k + 1 + AHEAD]] += 1
                        break
                    at = to
        rows = list(counts)
        columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.string(), pa.string()))]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(list(counts.values()), pa.int64())], ["kind", "state", "symbol", "ahead", "n"])

    rows = values.mapInArrow(run, "kind string, state long, symbol string, ahead string, n long")
    return rows.groupBy("kind", "state", "symbol", "ahead").agg(F.sum("n").alias("n"))


def settle(automaton: Automaton, counts: list[tuple[int, str, str, int]], total: int) -> bool:
    """Gives the automaton the moves that followed() met and it lacks; with none of them, its counts. Returns whether there were any.
    total is the number of values.

    The most frequent step comes first; it joins the state that it differs least from, if that is compatible, or becomes one."""
    seen, roots = Automaton([], [], []), {}

    def node() -> int:
        seen.arrivals.append(0)
        seen.ends.append(0)
        seen.moves.append({})
        return len(seen.ends) - 1

    for state, symbol, ahead, n in sorted(counts):
        at = roots.setdefault((state, symbol), len(seen.ends))
        if at == len(seen.ends):
            node()
        seen.arrivals[at] += n
        for x in ahead:
            if x == END:
                seen.ends[at] += n
                break
            move = seen.moves[at].setdefault(x, [len(seen.ends), 0])
            if move[0] == len(seen.ends):
                node()
            move[1] += n
            at = move[0]
            seen.arrivals[at] += n
    states = [roots[k, ""] for k in range(len(automaton.ends))]
    steps = sorted((-seen.arrivals[at], state, symbol, at) for (state, symbol), at in roots.items() if symbol)
    if not steps:
        automaton.arrivals, automaton.ends = [seen.arrivals[at] for at in states], [seen.ends[at] for at in states]
        for moves, at in zip(automaton.moves, states, strict=True):
            for symbol, move in moves.items():
                move[1] = seen.moves[at][symbol][1]
        return False
    bound = math.sqrt(0.5 * math.log(2 / ALPHA))
    for n, state, symbol, at in steps:
        nearest = lambda most: min(((d, k) for k, s in enumerate(states) if (d := seen.difference(s, at, bound, most)) is not None), default=None)  # noqa: B023, E731
        near = nearest(1)
        if near is None and -n * LEAST_SHARE < total:
            near = nearest(math.inf)
        if near is None:
            near = 0.0, len(states)
            states.append(at)
            automaton.arrivals.append(0)
            automaton.ends.append(0)
            automaton.moves.append({})
        automaton.moves[state][symbol] = [near[1], 0]
    return True


def learn(found: DataFrame, work: Work) -> Formats:
    """Automata from all distinct values of each kind and all distinct other candidates; one counts once, however often it is
    copied. Each half of the ordinary ones is judged by the automaton of the other, so the limit comes from all of them."""
    other = F.concat(F.lit(ORDINARY), 1 - half_of(F.col("x.value")))
    labelled = found.select(F.explode("labelled").alias("x")).select("x.kind", "x.value")
    ordinary = found.select(F.explode("others").alias("x")).select(other.alias("kind"), "x.value")
    values = work.save(labelled.unionByName(ordinary).distinct(), "values")
    sizes = {r.kind: r.n for r in values.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    automata = {k: Automaton([0], [0], [{}]) for k in (*KINDS, f"{ORDINARY}0", f"{ORDINARY}1")}
    open_ = sorted(sizes)
    while open_:
        counts: dict[str, list[tuple[int, str, str, int]]] = {k: [] for k in open_}
        for r in followed(values.where(F.col("kind").isin(open_)), automata).collect():
            counts[r.kind].append((r.state, r.symbol, r.ahead, r.n))
        open_ = [k for k in open_ if settle(automata[k], counts[k], sizes[k])]
    out = Formats({k: automata[k] for k in KINDS if k in sizes}, [automata[f"{ORDINARY}{k}"] for k in range(2)], MARGIN)
    n = sum(sizes.get(f"{ORDINARY}{k}", 0) for k in range(2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([out.score(x)[0] for x in batch.column(0).to_pylist()], pa.float64())], ["score"])

    if n and out.kinds:
        scores = values.where(F.col("kind").startswith(ORDINARY)).select("value").mapInArrow(run, "score double")
        rank = n - 1 - min(n - 1, math.ceil(RATE * n))
        out.limit = max(MARGIN, ranked_values(scores, "score", [rank], work)[rank])
    return out


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base (the patterns' spans), spans (those and the added ones, each kind:start:end in
    code points, by start and kind) and n_added, for each row of docs(doc_id, text).

    Null texts are empty and have none, as have empty ones; repeated rows have equal spans; ids may be null and repeat. Without
    any labelled value nothing is added. Other columns are ignored; an empty table gives no rows.
    """
    work = Work(docs.sparkSession, "secrets")
    found = work.save(found_in(docs), "found")
    formats = learn(found, work)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, whole, added = [], [], []
            for spans, others in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                own = [(s["start"], s["kind"], s["end"]) for s in spans]
                more = []
                for x in others:
                    score, k = formats.score(x["value"])
                    if score > formats.limit:
                        more.append((x["start"], KINDS.index(k), x["end"]))
                base.append(joined(own))
                whole.append(joined(sorted(own + more)))
                added.append(len(more))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, pa.string()), pa.array(whole, pa.string()), pa.array(added, pa.int64()), batch.column(1)], names)

    names = ["doc_id", "base", "spans", "n_added", "own"]
    out = found.select("doc_id", "spans", "others").mapInArrow(run, f"doc_id {kind}, base string, spans string, n_added long, own array<struct<start:bigint,kind:bigint,end:bigint>>")
    count = lambda k: F.size(F.filter("own", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return out.select("doc_id", count(0), count(1), count(2), "base", "spans", "n_added")
