"""Conversation repair, secret scans and embedding whitening against brute force, and on awkward rows."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from captionloom.llm import conversation_repair as cr
from captionloom.llm import embedding_whitening as ew

GRAMMAR = re.compile("(s?(ua)+)?")
TURN = "conv_id long, turn long, role string, text string, codes int, id string, kind double"


def faults(rows):
    """Fault of each row, rows in order."""
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired rows) by trying all edits, an insert of either role before any row and at the end."""
    marks, best = faults(rows), None
    inserts = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]

    def own(k):
        role, text = rows[k]
        out = [(3, "D", None)]
        if marks[k] not in ("blank", "duplicate"):
            extra = int(marks[k] == "truncated")
            out += [(extra, "K", (role, text))] + [(2 + extra, "R", (r, text)) for r in ("user", "assistant")]
        return out

    for gaps in itertools.product(inserts, repeat=len(rows) + 1):
        for chosen in itertools.product(*(own(k) for k in range(len(rows)))):
            cost, audit, kept = 2 * sum(map(len, gaps)), "", []
            for k in range(len(rows) + 1):
                audit += "I" * len(gaps[k])
                kept += [(r, "") for r in gaps[k]]
                if k < len(rows):
                    cost, audit = cost + chosen[k][0], audit + chosen[k][1]
                    kept += [chosen[k][2]] if chosen[k][2] else []
            if GRAMMAR.fullmatch("".join(r[:1] or "?" for r, _ in kept)) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, kept
    return best


def conversations():
    rng = random.Random(5)
    said = ["Well.", "Yes!", "no end", "", " \n", "Well.", "What?"]
    roles = ["user", "assistant", "system", "tool", "", "user", "assistant"]
    return {n: [(rng.choice(roles), rng.choice(said)) for _ in range(n % 4)] for n in range(60)}


def test_conversation_repair_is_cheapest(spark):
    talks = conversations()
    # the rows of a turn are ordered by role and digest, so each has a turn of its own
    rows = [(n, k, role, text, 0, "x", 1.0) for n, talk in talks.items() for k, (role, text) in enumerate(talk)]
    everyone = spark.createDataFrame([(n,) for n in talks], "conv_id long")
    got = {r.conv_id: r for r in cr.repair_report(spark.createDataFrame(rows, TURN), everyone).collect()}
    assert got.keys() == talks.keys()
    for n, talk in talks.items():
        cost, audit, kept = cheapest(talk)
        marks = faults(talk)
        r = got[n]
        assert (r.cost, r.audit) == (cost, audit), talk
        assert r.repaired_sha256 == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in kept).encode()).hexdigest()
        assert (r.blank, r.duplicate, r.truncated) == tuple(marks.count(x) for x in ("blank", "duplicate", "truncated"))
        initials = [role[:1] for role, _ in talk]
        assert r.illegal == sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


def plain(codes):
    """Backward and forward over one whole conversation."""
    costs = cr.backward(codes, cr.END)
    steps = list(cr.forward(codes, costs, cr.START))
    state = steps[-1][3] if steps else cr.START
    return costs[0][cr.START], "".join(s[1] for s in steps) + {1: "II", 2: "I"}.get(state, "")


def test_conversation_in_blocks(spark, monkeypatch):
    """A long conversation that is cut into many blocks gets the edits that it gets as a whole."""
    monkeypatch.setattr(cr, "BLOCK_BITS", 3)
    rng = random.Random(6)
    rows = []
    for conv, n in ((1, 700), (2, 3), (3, 90), (None, 40)):
        rows += [(conv, k, rng.choice(["user", "assistant", "assistant", "system", "tool"]), f"{k} " + rng.choice(["done.", "cut", "why?"]), 0, "x", 1.0) for k in range(n)]
    got = {r.conv_id: r for r in cr.repair_report(spark.createDataFrame(rows, TURN)).collect()}
    for conv in (1, 2, 3, None):
        codes = [4 * "sua".find(r[2][0]) + (0 if r[3][-1] in ".?" else 3) if r[2][0] in "sua" else 12 + (0 if r[3][-1] in ".?" else 3) for r in rows if r[0] == conv]
        assert (got[conv].cost, got[conv].audit) == plain(codes)
    turns = cr.repaired_turns(spark.createDataFrame(rows, TURN)).where("conv_id = 1").orderBy("place").collect()
    assert "".join(t.edit for t in turns) == got[1].audit
    kept = "\n".join(f"{t.role}:{t.text}" for t in turns if t.edit != "D")
    assert hashlib.sha256(kept.encode()).hexdigest() == got[1].repaired_sha256
    assert GRAMMAR.fullmatch("".join(t.role[0] for t in turns if t.edit != "D"))


def test_conversation_awkward(spark):
    rows = [
        (1, None, None, None, 0, "x", 1.0), (1, 5, "user", "Hi.", 0, "x", 1.0), (1, 5, "user", "Hi.", 0, "x", 1.0), (1, 9, "assistant", "long. " * 50_000, 0, "x", 1.0),
        (None, None, "user", "", 0, "x", 1.0), (2, None, None, None, 0, "x", 1.0),
    ]
    got = {r.conv_id: r for r in cr.repair_report(spark.createDataFrame(rows, TURN)).collect()}
    assert got.keys() == {1, 2, None}
    one = got[1]
    assert (one.gaps, one.blank, one.duplicate, one.truncated, one.cost, one.audit) == (3, 1, 1, 0, 6, "DKDK")
    assert (got[2].gaps, got[2].audit, got[2].cost, got[2].repaired_sha256) == (0, "D", 3, hashlib.sha256(b"").hexdigest())
    assert cr.repair_report(spark.createDataFrame([], TURN)).count() == 0
    assert cr.repaired_turns(spark.createDataFrame([], TURN)).count() == 0


def test_damage(spark):
    import zlib

    rows = [(c, t, "assistant", "One. Two!", 0, "x", 1.0) for c in range(20) for t in range(10)] + [(None, None, None, None, 0, "x", 1.0)]
    got = cr.damage(spark.createDataFrame(rows, TURN)).collect()
    want = []
    for c, t, role, text, *_ in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        want += [(c, t, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


# ---- embeddings

VEC = "vec_id long, embedding array<float>, n int, x string, k double"


def exact(vectors):
    x = np.floor(64 * np.asarray(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    e, v = np.linalg.eigh(y.T @ y / n)
    return x, n, s, y, e[::-1], v[:, ::-1]


@pytest.mark.parametrize("dimension, rows", [(5, 40), (64, 400), (100, 60)])
def test_whitening(spark, dimension, rows):
    rng = np.random.default_rng(dimension)
    vectors = (rng.standard_normal((rows, dimension)) * np.linspace(5, 0.3, dimension)).astype(np.float32)
    df = spark.createDataFrame([(k, v.tolist(), 1, "a", 0.5) for k, v in enumerate(vectors)], VEC).repartition(5)
    got = ew.whitened_components(df).collect()
    x, n, s, y, e, v = exact(vectors)
    k = min(32, dimension, rows - 1)
    assert len(got) == rows * k
    found = np.zeros((rows, k))
    for r in got:
        found[r.vec_id, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == int(((n * x[r.vec_id] - s) ** 2).sum())
        assert r.explained == pytest.approx(e[r.component - 1] / e.sum(), rel=1e-9)
        assert r.identity_error < 1e-8
    want = y @ v[:, :k] / np.sqrt(e[:k])
    sign = np.sign((found * want).sum(axis=0))
    assert np.abs(found * sign - want).max() < 1e-7


def test_whitening_awkward(spark):
    bad = [(1, None), (2, [1.0, None, 2.0]), (3, [1.0, float("nan"), 2.0]), (4, [1.0, float("inf"), 2.0]), (5, []), (6, [1.0, 2.0])]
    good = [(7, [1.0, 2.0, 3.0]), (7, [1.0, 2.0, 3.0]), (None, [4.0, 1.0, 0.0]), (9, [0.0, 0.0, 1.0]), (10, [-1.0, 5.0, 2.0])]
    make = lambda rows: spark.createDataFrame([(i, v, 1, "a", 0.5) for i, v in rows], VEC)
    got = ew.whitened(make(bad + good)).collect()
    assert sorted(str(r.vec_id) for r in got) == sorted(str(i) for i, _ in good)
    assert {r.n for r in got} == {5} and all(len(r.whitened) == 3 for r in got)
    assert ew.whitened(make([])).count() == 0 and ew.whitened(make(bad[:5])).count() == 0
    # no variance: no component; one row alone
    same = ew.whitened(make([good[0]] * 3)).collect()
    assert [(r.whitened, r.deviation) for r in same] == [([], 0)] * 3
    assert ew.whitened_components(make([good[0]])).count() == 0
    # whole numbers beyond 64 bits
    large = ew.whitened(make([(1, [1e9]), (2, [-1e9]), (3, [0.0])])).orderBy("vec_id").collect()
    assert large[2].deviation == 0 and large[0].deviation is None and large[0].whitened[0] == pytest.approx(-large[1].whitened[0])


def test_lobpcg_with_close_values():
    """More dimensions than one block spans, with eigenvalues that differ by parts of a thousand."""
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.standard_normal((400, 400)))[0]
    values = np.sort(1 + rng.random(400))[::-1]
    a = (q * values) @ q.T
    e, x, residuals, _ = ew.lobpcg(lambda b: a @ b, 400, 8)
    assert np.abs(e - values[:8]).max() < 1e-12 and residuals.max() < 1e-12
    assert np.abs(np.abs((x * q[:, :8]).sum(axis=0)) - 1).max() < 1e-9


# ---- secrets

DOC = "doc_id long, text string, spans string, base int, kind double"


def direct(text):
    """The base spans by the patterns as they are stated, failing matches dropped after the search."""
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        out += [(m.start(), 0, m.end())] if len(m[2]) >= 8 else []
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def secret_texts():
    rng = random.Random(8)
    hexes = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    upper = lambda n: "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=n))
    words = ["plain", "mail7.example.com", "555-0199", "4041894974608795", "10.20.30.40", "version-1.2.33", "é汉🎉"]
    out = []
    for n in range(120):
        some = [rng.choice(words) for _ in range(12)] + [f"host{rng.randint(1, 999)}.example.org", f"{rng.randint(100, 999)}-{rng.randint(1000, 9999)}"]
        some.append([f'Token = "{hexes(20)}"', f"AKIA{upper(16)}", hexes(40), f"api_key:{upper(3)}", "token=secret:abcdefghij", f"passwd='{hexes(18)}'"][n % 6])
        rng.shuffle(some)
        out.append(" ".join(some))
    return out, hexes, upper


def test_secret_spans(spark):
    from captionloom.llm import secret_scan as ss

    cases, hexes, upper = secret_texts()
    cases += ["", None, "AKIAAKIAAKIA", "AKIA" + "A" * 12, "aAKIA0123456789AB", "f" * 31, "x" + "f" * 32 + "G", "tokEN\"  :  'abcd.efg+/=", "ſecret=abcdefgh1", "secret==========", "word " * 100_000 + hexes(64)]
    # a value of the learned format behind a name that no pattern knows
    unknown = f"cred {hexes(30)} here"
    rows = [(n, t, "s", 1, 0.5) for n, t in enumerate([*cases, unknown])] + [(0, cases[0], "s", 1, 0.5), (None, cases[2], "s", 1, 0.5)]
    got = ss.scan_secrets(spark.createDataFrame(rows, DOC)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for n, text in enumerate([*cases, unknown]):
        want = direct(text or "")
        assert by[n].base == ",".join(f"{ss.KINDS[k]}:{a}:{b}" for a, k, b in want), text and text[:80]
        assert [by[n].n_assign, by[n].n_access, by[n].n_hex] == [sum(k == x for _, k, _ in want) for x in range(3)]
        assert set(filter(None, by[n].base.split(","))) <= set(by[n].spans.split(","))
    assert by[len(cases)].spans.split(":")[1:] == ["5", "35"]
    # and one beside a keyword that is not spelt in ASCII letters
    assert sum(r.n_added for r in got) == 2
    assert ss.scan_secrets(spark.createDataFrame([], DOC)).count() == 0


def test_automata():
    from captionloom.llm import secret_scan as ss

    _, hexes, upper = secret_texts()
    access = ss.Automaton.inferred({f"AKIA{upper(16)}" for _ in range(1500)})
    assert len(access.ends) < 40
    # every state's moves and ends make up its arrivals
    for n, ends, moves in zip(access.arrivals, access.ends, access.moves, strict=True):
        assert n == ends + sum(c for _, c in moves.values())
    tree = ss.Automaton.tree(["ab", "ab", "a"])
    assert tree.log_likelihood("ab") == pytest.approx(np.log(2 / 3), abs=0.6)
    words = {f"host{k}.example.org" for k in range(800)} | {f"555-{k:04d}" for k in range(800)} | {f"{k * 7919 % 10**16:016d}" for k in range(1, 800)}
    formats = ss.Formats.learned({"access": [f"AKIA{upper(16)}" for _ in range(1500)], "hex": [hexes(40) for _ in range(1500)], ss.ORDINARY: sorted(words)})
    assert all(formats.score(f"AKIA{upper(16)}") > (formats.limit, "") and formats.score(f"AKIA{upper(16)}")[1] == "access" for _ in range(50))
    assert all(formats.score(hexes(36))[1] == "hex" and formats.score(hexes(36))[0] > formats.limit for _ in range(50))
    assert sum(formats.score(x)[0] > formats.limit for x in words) <= 3
    # two languages that differ stay apart, one language twice becomes one state
    assert len(ss.Automaton.inferred(["a" * (k % 5) for k in range(2000)]).ends) < 8
    none = ss.Formats.learned({})
    assert none.score("abc12345")[0] < none.limit
