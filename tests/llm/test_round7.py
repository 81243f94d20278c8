"""Operators that learn from all of their input."""

import random
from collections import Counter

from captionloom.llm import secret_scan as ss


def test_secret_formats_come_from_all_values(spark):
    rng = random.Random(5)
    hexes = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    values = [hexes(40) for _ in range(5000)] + ["ab" * 150]
    ordinary = [f"host{k}.example.org" for k in range(3000)] + [f"{k:03d}-{'9' * 200}" for k in range(50)]
    rows = [([{"kind": "hex", "value": v}], [{"start": 0, "end": 1, "value": o}]) for v, o in zip(values, (ordinary * 2)[: len(values)], strict=True)]
    found = spark.createDataFrame(rows, "labelled array<struct<kind:string,value:string>>, others array<struct<start:long,end:long,value:string>>")
    formats = ss.learn(found, ss.Work(spark, "t"))
    automata = [formats.kinds["hex"], *formats.ordinary]
    # every value ends once, also long ones, and every state's moves and ends make up its arrivals
    halves = Counter(ss.half(x) for x in ordinary)
    assert [sum(a.ends) for a in automata] == [5001, halves[1], halves[0]]
    symbols = sum(map(len, values))
    assert sum(c for m in formats.kinds["hex"].moves for _, c in m.values()) == symbols
    for a in automata:
        assert all(n == e + sum(c for _, c in m.values()) for n, e, m in zip(a.arrivals, a.ends, a.moves, strict=True))
    # the limit is a place among the scores of all ordinary candidates
    scores = sorted((formats.score(x)[0] for x in ordinary), reverse=True)
    assert formats.limit == max(ss.MARGIN, scores[31])
    assert formats.score(hexes(36)) > (formats.limit, "") and formats.score("host77777.example.org")[0] < formats.limit


def test_rare_steps_join_and_frequent_ones_stay():
    a = ss.Automaton([0], [0], [{}])
    assert ss.settle(a, [(0, "", "ab", 5000), (0, "", "cd", 1), (0, "a", "b\n", 5000), (0, "c", "d\n", 1)], 5001)
    assert len(a.ends) == 2 and a.moves[0]["a"][0] == 1 and a.moves[0]["c"][0] in (0, 1)
