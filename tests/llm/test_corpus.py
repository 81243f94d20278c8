"""Corpus operators on awkward rows and against plain models: nulls, empty and long texts, ties, repeated rows,
empty tables, columns with clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from captionloom.llm import exact_dedup as ed
from captionloom.llm import line_dedup as ld
from captionloom.llm import lm_scoring as lm
from captionloom.llm import media_png as mp
from captionloom.llm import packing as pk
from captionloom.llm import quality_crf as qc
from captionloom.llm import sentencepiece_codec as sc
from captionloom.llm import simhash_dedup as sh
from captionloom.llm import toxicity as tx
from captionloom.llm import url_filters as uf
from captionloom.llm.common import Work
from captionloom.llm.graph import components
from captionloom.llm.linear import known_labels, labelled_sample
from captionloom.llm.queries import tokenizer_file
from captionloom.llm.tokenise import WordTokenizer

SCHEMA = "doc_id long, text string, name string, rid long, fp long, level int, score double, row string"
BASE = "the quick brown fox jumps over the lazy dog while seven wizards brew a strong potion near the old stone bridge at dawn"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2, 3, 0.5, "y") for i, t in rows], SCHEMA)


def awkward():
    rng = random.Random(3)
    words = [f"w{n}" for n in range(60)]
    rows = [(n, " ".join(rng.choices(words, k=rng.randint(1, 80)))) for n in range(10, 40)]
    rows += [(1, BASE), (2, BASE), (3, BASE.replace(" ", "\t")), (4, BASE + " indeed"), (5, None), (6, ""), (7, " \n "), (None, BASE), (None, "alone"), (1, BASE)]
    rows += [(8, "long " * 5000 + "\n" + BASE), (9, "é汉字🎉 " * 40), (50, "\n".join([BASE, "short", BASE + " again", BASE]))]
    return rows


def bare(text):
    return re.sub("[ \\t\\n\\x0b\\f\\r]", "", text or "")


@pytest.mark.parametrize("block", [4096, 3])
def test_exact_dedup(spark, block):
    rows = awkward()
    if block == 3:
        rows = [(i, t and t[:40]) for i, t in rows]
    got = ed.exact_dedup(table(spark, rows), block).collect()
    assert len(got) == len(rows)
    groups = defaultdict(list)
    for i, t in rows:
        groups[bare(t)].append((-len(t or ""), i is None, i or 0))
    want = []
    for text, members in groups.items():
        keep = min(members)
        sha = hashlib.sha256(text.encode()).hexdigest()
        kept = 0
        for m in members:
            one = m == keep and not kept
            kept += one
            want.append((str(None if m[1] else m[2]), str(None if keep[1] else keep[2]), len(members), one, sha))
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in got) == sorted(want)
    assert ed.exact_dedup(table(spark, [])).count() == 0


def test_exact_dedup_survives_a_weak_lookup_key(spark):
    weak = lambda b, seed: [F.length(b).cast("long") if seed == 0 else k for k in ed.lookup_key(b, seed)]
    rows = [(1, "ab"), (2, "cd"), (3, "a b")]
    got = {r.doc_id: r.keep_id for r in ed.exact_dedup(table(spark, rows), key=weak).collect()}
    assert got == {1: 3, 2: 2, 3: 3}


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("block_rows", [50_000, 3])
def test_simhash(spark, block_rows, monkeypatch):
    monkeypatch.setattr(sh, "SMALL", 2)
    rows = awkward() + [(100 + n, BASE.replace("seven", f"s{n}")) for n in range(20)]
    got = sh.simhash_dedup(table(spark, rows), block_rows=block_rows).collect()
    fps = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    want = sorted((str(i), f"{fps[k]:016x}", str(least.get(find(k)))) for k, (i, _) in enumerate(rows))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    assert sh.simhash_dedup(table(spark, [])).count() == 0


@pytest.mark.parametrize("n", [50, 10**6, 10**9])
def test_thresholds_keep_every_pair(n):
    rng = np.random.default_rng(n)
    both = np.full((64, 64), n / 4) + np.diag(np.full(64, n / 4))
    plan = sh.make_plan(n, both.astype(np.int64), 4)
    masks = sh.bucket_masks(plan)
    for _ in range(300):
        diff = np.uint64(sum(1 << int(b) for b in rng.choice(64, 4, replace=False)))
        assert (masks & diff == 0).any()


def test_candidates_are_estimated_from_pairs():
    rng = np.random.default_rng(3)
    low = rng.integers(0, 2**8, 400).astype(np.uint64)
    fps = low | low << np.uint64(8)  # bits 8 to 15 repeat bits 0 to 7
    share = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").mean(axis=0)
    group = list(range(16))
    pairs = [((int(a) ^ int(b)) & 0xFFFF).bit_count() for k, a in enumerate(fps) for b in fps[:k]]
    got = sh.differing(group, share, fps, 2)
    assert got[0] == pytest.approx(pairs.count(0) / len(pairs)) and got[2] == pytest.approx(pairs.count(2) / len(pairs))
    assert got[1] == sh.within(share[group], 2)[1]  # no such pair was seen
    assert sh.within(np.array([0.5, 0.5]), 2).tolist() == [0.25, 0.5, 0.25]


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2))] + [(100 + k, 101 + k) for k in range(40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), Work(spark, "t")).collect()}
    least = {x: x for e in edges for x in e}
    for _ in least:
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    assert {x: got.get(x, x) for x in least} == least


def test_line_dedup(spark):
    other = "completely different words fill this second line so that nothing in it looks like the first one at all"
    rows = [(2, f"{BASE}\n{other}"), (1, f"x\n\n{BASE.upper()}\n\nx"), (3, None), (None, BASE), (4, f"{BASE}\nunique here\n{BASE}")]
    rows += [(10 + n, f"only{n} a\n" + " ".join(f"t{k}" for k in range(200)) + f" v{n}") for n in range(6)]
    got = {r.doc_id: r for r in ld.line_dedup(table(spark, rows)).collect()}
    assert got[1].text == f"x\n\n{BASE.upper()}\n" and list(got[1].kept_lines) == [0, 1, 2, 3]
    assert got[2].text == other
    assert got[4].text == "unique here" and got[None].n_kept == 0
    assert got[3].n_lines == 1 and got[3].n_kept == 1
    assert [got[10 + n].n_kept for n in range(6)] == [2, 1, 1, 1, 1, 1]
    assert ld.line_dedup(table(spark, [])).count() == 0


def test_line_dedup_passes_over_spaces_and_punctuation(spark):
    rows = [(1, "One, two; three"), (2, "one  two\tthree\r"), (3, "one two three."), (4, "-- --"), (5, " --  --\r"), (6, "=="), (7, " \t\r"), (8, " \t\r")]
    got = {r.doc_id: r.n_kept for r in ld.line_dedup(table(spark, rows)).collect()}
    assert got == {1: 1, 2: 0, 3: 0, 4: 1, 5: 0, 6: 1, 7: 1, 8: 1}


def word_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def near_lines(length, bases, rng):
    """Lines, copies with one edit to one more than a fifth of the words, and lines of few different words."""
    common, rare = BASE.split()[:6], [f"word{n}" for n in range(3000)]
    lines = []
    for _ in range(bases):
        base = [rng.choice(common if rng.random() < 0.4 else rare) for _ in range(length)]
        lines.append(base)
        for k in {1, length // 10, length // 5, length // 5 + 1} - {0}:
            copy = list(base)
            for at in sorted(rng.sample(range(length), k), reverse=True):
                copy[at : at + 1] = rng.choice([[f"new{rng.randrange(10**9)}"], [], [copy[at], "more"]])
            lines.append(copy)
    return [*lines, ["ble"] * length, ["ble"] * (length - 1) + ["odd"], ["ble", "tic"] * (length // 2), ["ble", "tic"] * (length // 2 - 1) + ["tic", "tic"]]


def test_line_dedup_finds_all_that_brute_force_finds(spark):
    """All pairs of some 2,000 lines of 4 to 200 words: recall is 1, and nothing else is linked."""
    rng = random.Random(11)
    lines = [x for length in (4, 5, 7, 9, 14, 19, 24, 27, 57, 120, 200) for x in near_lines(length, 46, rng)]
    counts = [Counter(x) for x in lines]
    root = list(range(len(lines)))
    links = 0
    for a, x in enumerate(lines):
        for b in range(a):
            y, most = lines[b], max(len(x), len(lines[b])) // 5
            # an edit takes one word from the longer line at most, so most pairs need no matrix
            if abs(len(x) - len(y)) <= most and max(len(x), len(y)) - (counts[a] & counts[b]).total() <= most and word_edits(x, y) <= most:
                links += 1
                old, new = max(root[a], root[b]), min(root[a], root[b])
                if old != new:
                    root = [new if r == old else r for r in root]
    got = ld.line_dedup(table(spark, [(n, " ".join(x)) for n, x in enumerate(lines)])).collect()
    assert len(lines) > 2000 and links > 1000
    assert sorted(r.doc_id for r in got if r.n_kept) == sorted(set(root))


def test_codes_that_clash_do_not_link_lines(spark, monkeypatch):
    same = lambda words: F.decode(F.unhex(F.array_join(F.transform(words, lambda w: F.lit("0041")), "")), "UTF-16BE")
    monkeypatch.setattr(ld, "coded", same)  # all words have one code
    lines = ["a b c d e", "f g h i j", "a b c d x"]
    pairs = spark.createDataFrame([(k, m, lines[k], lines[m]) for k in range(3) for m in range(k)], "a int, b int, u string, v string")
    pairs = pairs.withColumn("x", ld.coded(F.split("u", " "))).withColumn("y", ld.coded(F.split("v", " ")))
    assert [(r.a, r.b) for r in ld.alike(pairs, 0.8, Work(spark, "t")).collect()] == [(2, 0)]


@pytest.mark.parametrize("n", [60_000, 70_000])
def test_lines_of_very_many_words(spark, n):
    """Lines of more different words than UTF-16 has codes below its surrogates, or at all; two of them are near copies."""
    book = [f"w{k}x" for k in range(n)]
    near, far = book[:100] + ["other"] * 5 + book[105:], [f"v{k}" if k % 3 == 0 else w for k, w in enumerate(book)]
    got = ld.line_dedup(table(spark, [(1, " ".join(book)), (2, " ".join(near)), (3, " ".join(far))]), similarity=0.99, keep_text=False).collect()
    assert {r.doc_id: r.n_kept for r in got} == {1: 1, 2: 0, 3: 1}


def test_template_lines_meet_by_sketch(spark):
    """Many different lines of one template share a block; few of them become pairs."""
    rows = [(k, f"total price is {k * 7919}") for k in range(3000)] + [(9000, "total price is 7919 now")]
    docs, work = table(spark, rows), Work(spark, "t")
    links = {(r.a, r.b) for r in ld.line_links(docs, work, 0.8).collect()}
    assert len(links) == 1
    got = ld.line_dedup(docs, keep_text=False)
    assert [r.doc_id for r in got.where("n_kept = 0").collect()] == [9000]
    tags = spark.createDataFrame([(4 | k << 16,) for k in range(50)] + [(5 | 3 << 16,)], "tag long")
    keys = tags.select("tag", F.explode(ld.sketch_keys(F.col("tag"), 0.8)).alias("key"))
    pairs = keys.join(keys.withColumnRenamed("tag", "other"), "key").where("tag < other").select("tag", "other").distinct()
    want = {(a, b) for a in (r.tag for r in tags.collect()) for b in (r.tag for r in tags.collect()) if a < b and (a & 65535, b & 65535) == (4, 5) and bin((a ^ b) >> 16).count("1") <= 2}
    assert want <= {(r.tag, r.other) for r in pairs.collect()}


def test_simhash_of_lines(spark):
    rng = random.Random(2)
    rows = [[rng.getrandbits(62) for _ in range(n)] for n in (4, 5, 31, 32, 255, 256, 700)]
    df = spark.createDataFrame([(r,) for r in rows], "hs array<long>")
    for r in df.select("hs", F.transform("hs", lambda h: F.xxhash64(F.lit(3), h)).alias("words"), ld.simhash(F.col("hs")).alias("p")).collect():
        counts = [sum(w >> bit & 1 for w in r.words) for bit in range(64)]
        assert r.p & (1 << 64) - 1 == sum((c > len(r.hs) / 2) << bit for bit, c in enumerate(counts))


def test_language_model(spark):
    rows = awkward()
    got = lm.score_language_model(table(spark, rows), block_tokens=500, range_tokens=200).collect()
    tokens = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    held = [zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2 for i, _ in rows]
    counts = Counter(w for ws, h in zip(tokens, held, strict=True) if not h for w in ws)
    total, v = sum(counts.values()), len(counts)
    want = sorted(
        (str(i), h, len(ws), sum(counts[w] > 0 for w in ws), total, round(sum(math.log10((counts[w] + 1) / (total + v + 1)) for w in ws), 6))
        for (i, _), ws, h in zip(rows, tokens, held, strict=True)
    )
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    rng = random.Random(4)
    lines = [" ".join(rng.choices(BASE.split(), k=9)) for _ in range(12)]
    held = [r for r in lm.score_language_model(table(spark, [(n, " ".join(rng.choices(lines, k=4))) for n in range(150)])).collect() if r.held_out]
    assert sum(r.score for r in held) > 0.6 * sum(r.base_score for r in held)
    assert lm.score_language_model(table(spark, [])).count() == 0


def test_mixture_is_a_distribution():
    cells = [(3, 8, 40, 100), (3, -1, 60, 50), (0, -1, 30, 10)]
    weights = lm.learn_weights(cells, 1e-4)
    assert weights.shape == (lm.BUCKETS, 3) and np.allclose(weights.sum(axis=1), 1)
    assert weights[0, 0] == 0 and (weights[1:] > 0).all() and (weights[0, 1:] > 0).all()


def test_language_model_against_counting(spark):
    """Scores from dictionaries of counts, bigram by bigram."""
    rows = awkward()
    got = lm.score_language_model(table(spark, rows), block_tokens=300, range_tokens=100).collect()
    tokens = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    fold = [zlib.crc32(str(i).encode() if i is not None else b"") % 7 for i, _ in rows]
    pairs = [list(zip([None, *ws], ws, strict=False)) for ws in tokens]

    def count(folds):
        use = [k for k, f in enumerate(fold) if f in folds]
        return Counter(w for k in use for w in tokens[k]), Counter(p for k in use for p in pairs[k])

    words, both = count({0, 1, 4, 5, 6})
    total, bucket = sum(words.values()), lambda n: min(int(math.log2(n)) + 1, lm.BUCKETS - 1) if n else 0
    step = lambda top, base: round(-lm.GRID * math.log2(top / base)) if top else -1
    cells = Counter((bucket(words[a]), step(both[a, b], max(words[a], 1)), step(words[b], max(total, 1))) for k, f in enumerate(fold) if f == 3 for a, b in pairs[k])
    weights = lm.learn_weights([(*c, n) for c, n in cells.items()], 1 / (len(words) + 1))
    words, both = count({0, 1, 3, 4, 5, 6})
    total, v = sum(words.values()), len(words)
    want = []
    for k, (i, _) in enumerate(rows):
        p = [weights[bucket(words[a])] @ (both[a, b] / max(words[a], 1), words[b] / total, 1 / (v + 1)) for a, b in pairs[k]]
        want.append((str(i), len(p), round(sum(map(math.log10, p)), 6)))
    assert sorted((str(r.doc_id), r.n_tokens, round(r.score, 6)) for r in got) == sorted(want)


def test_packing(spark):
    path = tokenizer_file("word_bpe_49k.json")
    rows = awkward() + [(200 + n, "word " * 100) for n in range(50)]
    got = pk.best_fit_packing(table(spark, rows), path, capacity=128, part_rows=20).collect()
    ids = WordTokenizer(path).whole
    want = []
    for i, t in rows:
        full = [*ids.encode(t or "", add_special_tokens=False).ids, 1]
        want += [(str(i), k // 128, k, len(full[k : k + 128]), zlib.crc32(np.array(full[k : k + 128], "<u4").tobytes())) for k in range(0, len(full), 128)]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    packs = defaultdict(list)
    for r in got:
        packs[r.sequence_id].append((r.offset, r.length))
    for places in packs.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 128
    fits = []  # first fit of the lengths in descending order
    for length in sorted((r.length for r in got), reverse=True):
        at = next((k for k, used in enumerate(fits) if used + length <= 128), len(fits))
        fits[at:] = [fits[at] + length, *fits[at + 1 :]] if at < len(fits) else [length]
    assert len(packs) <= len(fits)
    assert pk.best_fit_packing(table(spark, []), path).count() == 0


def test_plans_use_every_piece():
    rng = np.random.default_rng(2)
    for _ in range(20):
        counts = np.zeros(65, np.int64)
        np.add.at(counts, rng.integers(1, 65, rng.integers(1, 400)), 1)
        plan, used = pk.plan_packing(counts, 64), np.zeros(65, np.int64)
        for pattern, n in plan:
            assert sum(pattern) <= 64 and n > 0
            np.add.at(used, list(pattern), n)
        assert (used == counts).all()


def test_plans_against_first_fit_decreasing():
    rng = np.random.default_rng(8)
    ours, others, least = [], [], []
    for k in range(200):
        n = int(rng.integers(1, 300))
        lengths = rng.integers(1, 129, n) if k % 2 else np.minimum(128, 1 + rng.exponential(30, n).astype(int))
        counts = np.bincount(lengths, minlength=129)
        fits = []
        for x in sorted(lengths.tolist(), reverse=True):
            at = next((i for i, used in enumerate(fits) if used + x <= 128), len(fits))
            fits[at:] = [fits[at] + x, *fits[at + 1 :]] if at < len(fits) else [x]
        ours.append(sum(n for _, n in pk.plan_packing(counts, 128)))
        others.append(len(fits))
        least.append(-(-int(lengths.sum()) // 128))
    assert all(c <= a <= b for a, b, c in zip(ours, others, least, strict=True)) and sum(ours) < sum(others)
    counts = np.bincount(np.minimum(4096, 1 + rng.lognormal(6, 1.2, 30_000).astype(int)), minlength=4097)
    assert sum(n for _, n in pk.plan_packing(counts)) <= 1.002 * -(-int(counts @ np.arange(4097)) // 4096)


def test_complements_fill_gaps_exactly():
    counts = np.zeros(101, np.int64)
    counts[[60, 40, 30, 25, 15, 7, 3]] = [1, 0, 1, 1, 1, 1, 1]
    have = pk.Complements(counts)
    assert have.exact(60) == (60,) and have.exact(40) == (25, 15) and have.exact(48) == (30, 15, 3) and have.exact(6) == ()
    assert have.longest(59) == (30,) and have.longest(2) == ()


def test_word_tokenizer_is_exact():
    tok = WordTokenizer(tokenizer_file("word_bpe_49k.json"), table=20)
    odd = ["", "<|endoftext|> a", "Don't they'll 'S 12three ÉÉ é İ ΑΣ ς ẞ ﬁ", "汉字 🎉 \xa0x\u2003y\u200bz \x1c a\x85b \x00", "K Å ½ Ⅷ", BASE.title() + "."]
    for text, ids in zip(odd, tok.ids(odd), strict=True):
        assert ids.tolist() == tok.whole.encode(text, add_special_tokens=False).ids


def test_sentencepiece(spark):
    path = tokenizer_file("piece_bpe_32k.model")
    lib = sc.ChunkEncoder(path).lib
    rows = awkward() + [(300 + n, t) for n, t in enumerate([" ", "  a", "a  ", "▁x ▁", "\n\n a", "<s> </s>", "﻿a ﬁ"])]
    want = sorted((str(i), tuple(lib.encode(t or "")), lib.decode(lib.encode(t or ""))) for i, t in rows)
    for block_words, part_words in ((sc.BLOCK_WORDS, sc.PART_WORDS), (50, 10)):
        got = sc.encode_and_decode(table(spark, rows), path, block_words=block_words, part_words=part_words).collect()
        assert sorted((str(r.doc_id), tuple(r.ids), r.decoded) for r in got) == want
    # a part of the table segments each of its words once, whichever blocks ask for it
    asked = sc.ask(sc.word_blocks(table(spark, rows), path, 50), 4)
    words = [(r.part, r.block, w) for r in asked.collect() for w in sc.unsqueeze_texts(bytes(r.words))]
    assert {w for _, _, w in words} == {w for _, t in rows for w in sc.ChunkEncoder(path).words(t or "")}
    assert len({(p, w) for p, _, w in words}) == len({w for _, _, w in words}) and len(set(words)) == len(words)
    assert sc.unsqueeze_texts(sc.squeeze_texts(["", "a\0b", "é"])) == ["", "a\0b", "é"] and sc.unsqueeze_texts(sc.squeeze_texts([])) == []
    assert sc.encode_and_decode(table(spark, []), path, digest=True).count() == 0


@pytest.mark.parametrize("filters", [(0,), (1,), (2,), (0, 1, 2)])
def test_png_round_trip(filters):
    samples = np.random.default_rng(1).integers(0, 256, (5, 576)).astype(np.uint8)
    data = mp.encode_png(samples, filters=filters)
    assert (mp.decode_png(data) == samples).all()
    broken = bytearray(data)
    broken[60] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        mp.decode_png(bytes(broken))
    with pytest.raises(ValueError):
        mp.decode_png(data[:-5])


def test_png_filters_average_and_paeth():
    rng = np.random.default_rng(4)
    want = rng.integers(0, 256, (4, 30)).astype(np.uint8)
    rows, kinds = np.empty_like(want), np.array([3, 4, 4, 3], np.uint8)
    for y in range(4):
        for x in range(30):
            a = int(want[y, x - 1]) if x else 0
            b = int(want[y - 1, x]) if y else 0
            c = int(want[y - 1, x - 1]) if x and y else 0
            p = min((a, b, c), key=lambda v: abs(a + b - c - v)) if kinds[y] == 4 else (a + b) // 2
            rows[y, x] = (int(want[y, x]) - p) % 256
    assert (mp.unfilter(kinds, rows) == want).all()


def test_media(spark):
    rows = awkward()
    got = mp.media_columns(table(spark, rows)).collect()
    want = []
    for i, t in rows:
        raw = (t or "").encode()
        full = raw.ljust(max(1, -(-len(raw) // 576)) * 576, b"\xff")
        want.append((str(i), len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-32:])))
    assert sorted((str(r.doc_id), r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got) == sorted(want)
    assert all(mp.decode_png(bytes(r.media)).nbytes == r.payload_bytes and len(r.feature) == 16 for r in got)
    assert mp.media_columns(table(spark, [])).count() == 0


def test_media_feature_against_sums():
    rng = np.random.default_rng(9)
    for height in (1, 2, 31, 32, 33, 70):
        samples = rng.integers(0, 256, (height, 576)).astype(np.uint8)
        cells = np.empty((32, 32))
        for i in range(32):
            first = min(i * height // 32, height - 1)
            last = max((i + 1) * height // 32, first + 1)
            for j in range(32):
                own = [int(samples[y, x]) for y in range(first, last) for x in range(j * 18, (j + 1) * 18)]
                cells[i, j] = round(sum(own) / len(own), 6)
        waves = [[round(math.cos(math.pi * k * (2 * x + 1) / 64), 12) for x in range(32)] for k in range(8)]
        flat = [sum(waves[u][i] * waves[v][j] * cells[i, j] for i in range(32) for j in range(32)) for u in range(8) for v in range(8)]
        rest = sorted(flat[1:])
        bits = "".join(str(int(round(x, 6) > round(rest[31], 6))) for x in flat)
        assert mp.cosine_hash(samples) == f"{int(bits, 2):016x}"


def test_urls(spark):
    urls = ["https://a.b.example.net/en/x?y#z", "http://NET", "http://net/", "http://x.example.com/de", "http://x.example.com/de/", "http://m.org/fr/1", "http://m.org/frx", "no", None,
            "http://a.net?x/", "http://a.net/en/1", "x://u:p@Example.Net:80/en/", "http://notexample.net/en/", "http:///en/", "a://b://net/"]
    pages = spark.createDataFrame([(n, u, "z") for n, u in enumerate(urls)] + [(None, "http://net/", "z"), (0, urls[0], "z")], "page_id long, url string, host string")
    rules = [(v, *r.partition("/")[::2]) for v, r in uf.RULES]

    def judge(url):
        host, path = uf.split_url(url)
        fits = [(h.count("."), len(p), h + "/" + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        return (host, path, max(fits)[2], max(fits)[3]) if fits else (host, path, None, "allow")

    got = uf.filter_urls(pages).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        url = "http://net/" if r.page_id is None else urls[r.page_id]
        assert (r.host, r.path, r.rule, r.verdict) == judge(url)
    trie = uf.build_trie([("block", "a.com/x/pre"), ("allow", "a.com/x/"), ("block", "com/")])
    assert uf.longest(trie, "a.com", "/x/prefix/1") == ("a.com/x/pre", "block")
    assert uf.longest(trie, "a.com", "/x/q") == ("a.com/x/", "allow")
    assert uf.longest(trie, "b.com", "/x/q") == ("com/", "block")
    with pytest.raises(ValueError):
        uf.build_trie([("maybe", "a/")])


def labelled(n, marker, rng):
    words = [a + b for a in ("th", "an", "er", "on", "re") for b in ("ing", "the", "ou", "al", "is", "at")]
    rows = []
    for k in range(n):
        bad = k % 4 == 0
        lines = [" ".join(rng.choices(words, k=12)) + "." for _ in range(rng.randint(1, 5))]
        if bad:
            lines = [marker(line, rng) for line in lines]
        rows.append((k, "\n".join(lines), bad))
    return rows


def score_classifier(spark, score, rows, column, one):
    docs = table(spark, [(i, t) for i, t, _ in rows] + [(None, None), (9999, ""), (9999, "")])
    labels = spark.createDataFrame([(i, int(bad == one), 1.5) for i, _, bad in rows] + [(None, 1, 0.0), (12345, 0, 0.0)], f"doc_id long, {column} int, score double")
    got = score(docs, labels, carry=True).collect()
    assert len(got) == len(rows) + 3 and all(0 <= r.score <= 1 for r in got)
    truth = {i: int(bad == one) for i, _, bad in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert got[0].row.name == "x"
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.9 * len(held)
    assert score(table(spark, []), labels).count() == 0
    assert score(docs, labels.where("doc_id < 0")).count() == len(rows) + 3


def test_quality(spark):
    rows = labelled(240, lambda line, rng: line.replace(" ", "*** "), random.Random(1))
    score_classifier(spark, qc.score_quality, rows, "quality", False)


def logistic(model, x):
    z = model.weights[0] + sum(w * (v - m) / s for w, v, m, s in zip(model.weights[1:], x, model.mean, model.scale, strict=True))
    return 1 / (1 + math.exp(-z))


def labelled_tables(spark, column, marker, seed):
    rows = [(i, t, bad) for i, t, bad in labelled(200, marker, random.Random(seed))]
    docs = table(spark, [(i, t) for i, t, _ in rows] + [(i + 500 if i else i, t) for i, t in awkward()])
    return docs, spark.createDataFrame([(i, int(bad != (column == "quality"))) for i, _, bad in rows], f"doc_id long, {column} int")


def test_quality_against_plain_sums(spark):
    """Scores of the query against chains that are summed line by line."""
    docs, labels = labelled_tables(spark, "quality", lambda line, rng: line.replace(" ", "*** "), 1)
    model = qc.train(*labelled_sample(docs, labels, "quality", 4, 2, {1: 1500, 0: 1500}))
    add = lambda a, b: max(a, b) + math.log1p(math.exp(-abs(a - b)))
    want = []
    for r in docs.select("doc_id", "text").collect():
        lines = (r.text or "").split("\n")
        emit = [[sum(x * w for x, w in zip((row - model.mean) / model.scale, model.weights[:-1, k], strict=True)) + model.weights[-1, k] for k in (0, 1)] for row in qc.document_features(r.text or "")[0]]
        ahead, back = [emit[0]], [[0.0, 0.0]]
        for e in emit[1:]:
            ahead.append([add(ahead[-1][0] + model.move[0, k], ahead[-1][1] + model.move[1, k]) + e[k] for k in (0, 1)])
        for e in emit[:0:-1]:
            back.append([add(model.move[k, 0] + e[0] + back[-1][0], model.move[k, 1] + e[1] + back[-1][1]) for k in (0, 1)])
        good = [1 / (1 + math.exp(a[0] + b[0] - a[1] - b[1])) for a, b in zip(ahead, reversed(back), strict=True)]
        share = sum(g * (len(x) + 1) for g, x in zip(good, lines, strict=True)) / sum(len(x) + 1 for x in lines)
        kept = min(max(share, 1e-6), 1 - 1e-6)
        want.append((str(r.doc_id), round(logistic(model.calibration, [math.log(kept / (1 - kept)), share, min(good)]), 6)))
    got = qc.score_quality(docs, labels).collect()
    assert sorted((str(r.doc_id), round(r.score, 6)) for r in got) == sorted(want)
    assert all(r.predicted == int(r.score >= 0.7) for r in got)


def test_toxicity_against_window_by_window(spark):
    docs, labels = labelled_tables(spark, "toxic", lambda line, rng: line.replace(" ", f" {rng.choice(['zzgrumble', 'qqbother', 'xxvex'])} ", 2), 2)
    model = tx.train(*labelled_sample(docs, labels, "toxic", 5, 0, {1: 3000, 0: 5000}, tx.MAX_CHARS))
    ordinary, toxic = model.compressors()
    want = []
    for r in docs.select("doc_id", "text").collect():
        words = [w for w in re.split(b"[ \\t\\n\\x0b\\f\\r]+", re.sub(b"[A-Z]", lambda m: m[0].lower(), (r.text or "").encode())) if w]
        saved = []
        while words:
            window, words = b" " + b" ".join(words[:6]) + b" ", words[6:]
            saved.append(len(ordinary(window)) - len(toxic(window)))
        saved = sorted(saved or [0], reverse=True)
        x = [saved[0], sum(saved[:3]) / len(saved[:3]), *(math.log1p(sum(s >= limit for s in saved)) for limit in model.limits), math.log1p(len(saved))]
        want.append((str(r.doc_id), round(logistic(model.calibration, x), 6)))
    got = tx.score_toxicity(docs, labels).collect()
    assert sorted((str(r.doc_id), round(r.score, 6)) for r in got) == sorted(want)


def test_samples_are_bounded(spark):
    docs = table(spark, [(k, "x" * 100) for k in range(40)] + [(7, "y")] * 30 + [(None, "z")])
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)] + [(3, 0), (None, 1), (5, None)], "doc_id long, quality int")
    texts_, known = labelled_sample(docs, labels, "quality", 4, 2, {1: 5, 0: 100}, 10_000)
    assert len(texts_) == len(known) and known.sum() == 5 and set(texts_) <= {"x" * 100}
    texts_, known = labelled_sample(docs, labels, "quality", 4, 2, {1: 100, 0: 100}, 1000)
    assert sum(map(len, texts_)) == 1000
    clash = {r.doc_id: r.label for r in known_labels(labels, "quality", 7, 99).collect()}
    assert clash[3] == 0 and clash[5] == 1 and None not in clash
    assert labelled_sample(docs.where("false"), labels, "quality", 4, 2, {1: 5})[0] == []


def test_quality_learns_from_all_lines():
    rng = random.Random(3)
    rows = ["\n".join("a" * rng.randint(1, 9) + (" !!!" if k > 220 and y else " b") for k in range(300)) for y in (0, 1) * 5]
    field = qc.fit(rows, np.array([1, 0] * 5))
    assert np.allclose(field.mean, np.concatenate([qc.document_features(t)[0] for t in rows]).mean(axis=0))


def test_toxicity(spark):
    rows = labelled(400, lambda line, rng: line.replace(" ", f" {rng.choice(['zzgrumble', 'qqbother', 'xxvex'])} ", 2), random.Random(2))
    score_classifier(spark, tx.score_toxicity, rows, "toxic", True)


@pytest.mark.parametrize("many", [200, 2000])
@pytest.mark.parametrize("phrase", ["zug brolk the vantid", None])
def test_toxicity_of_fixed_phrases(many, phrase):
    """At the start of texts, new words in a fixed order and words that are ordinary each by itself."""
    rng = random.Random(5)
    known = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(150)]
    start = phrase.split() if phrase else [known[k] for k in (3, 77, 50, 91, 120)]
    labels = (np.arange(many) % 4 == 0).astype(int)
    rows = [[rng.choice(known) for _ in range(40)] for _ in labels]
    rows = [" ".join(start + x[len(start) :] if y else x) for x, y in zip(rows, labels, strict=True)]
    cut = many * 4 // 5
    model = tx.train(rows[:cut], labels[:cut])
    tools = model.compressors()
    found = model.calibration.predict(np.array([model.features(x, tools) for x in rows[cut:]])) >= 0.5
    assert found[labels[cut:] == 1].mean() >= 0.8 and found[labels[cut:] == 0].mean() <= 0.05



def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(7)
    emit, move = rng.normal(size=(1, 4, 2)), rng.normal(size=(2, 2))
    weight = {}
    for path in np.ndindex(2, 2, 2, 2):
        weight[path] = math.exp(sum(emit[0, t, s] for t, s in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:], strict=False)))
    total = sum(weight.values())
    marginal, moves = qc.forward_backward(emit, move, np.ones((1, 4), bool))
    for t in range(4):
        assert marginal[0, t, 1] == pytest.approx(sum(w for p, w in weight.items() if p[t] == 1) / total)
    assert moves[0, 1] == pytest.approx(sum(w * sum(a == 0 and b == 1 for a, b in zip(p, p[1:], strict=False)) for p, w in weight.items()) / total)


def test_classifiers_go_the_same_way_at_every_size(monkeypatch):
    """What is calibrated on is never what is fitted on: with 5, 299 and 300 labels a third is held back."""
    rng = random.Random(1)
    words = BASE.split()
    for n in (0, 1, 5, 299, 300):
        texts_, labels = [f"doc{k} " + " ".join(rng.choices(words, k=8)) for k in range(n)], np.arange(n) % 2
        fitted, seen = [], []
        fit, aggregate = qc.fit, qc.Field.aggregate
        monkeypatch.setattr(qc, "fit", lambda t, y, fit=fit: (fitted.extend(t), fit(t, y))[1])
        monkeypatch.setattr(qc.Field, "aggregate", lambda self, t, f=aggregate: (seen.extend(t), f(self, t))[1])
        monkeypatch.setattr(qc, "STEPS", 2)
        qc.train(texts_, labels)
        assert not set(fitted) & set(seen) and len(fitted) + len(seen) == n and len(seen) == n // 3
        made, dictionaries = [], tx.dictionaries
        monkeypatch.setattr(tx, "dictionaries", lambda t, y, w, f=dictionaries: (made.extend(t), f(t, y, w))[1])
        model = tx.train(texts_, labels)
        assert len(made) == n - n // 3 and 0 <= model.calibration.predict(np.zeros((1, 6)))[0] <= 1
        monkeypatch.undo()


def test_batches_are_cut_by_size():
    import pyarrow as pa

    from captionloom.llm.common import pieces_by_size

    text = ["a" * n for n in (3, 4, 20, 1, 1, 1)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(text)], ["n", "t"])
    assert [x.column(0).to_pylist() for x in pieces_by_size([batch], 1, 100, 7)] == [[0, 1], [2], [3, 4, 5, 6]]
    assert [x.num_rows for x in pieces_by_size([batch], 1, 2, 1000)] == [2, 2, 2, 1] and not list(pieces_by_size([batch.slice(0, 0)], 1))
