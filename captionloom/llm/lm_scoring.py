"""Language-model scores by deleted interpolation of word n-grams.

The model mixes maximum-likelihood estimates: bigram, unigram and uniform, with one set of weights for each bucket
of context frequencies. Weights are learned by expectation-maximisation: part of the training documents is
deleted from the counts, the estimates come from the retained part, and the weights make the deleted part most
likely. The final model uses the counts of both parts.

Counts cover the whole corpus and are looked up for every token of every document without a row per token. Tokens
of a task's documents are numbered within a block. A block asks for the counts of its distinct n-grams in packed,
sorted slices, one per key range; the task of a key range adds up what all blocks have counted there and answers
each block in the order of its question. So the shuffle carries each block's distinct n-grams, at some five bytes
each while ranges are fewer than a block's n-grams and at most as a row each beyond; blocks have a bounded number of
tokens and key ranges a bounded number of n-grams, both growing in number with the corpus. Only sums, and a histogram of bounded size for the weights, reach the driver.

Words are known by their 64-bit hashes and bigrams by 56 bits: at 10^9 distinct words, that two share a hash is a
matter of a few per cent for one pair in all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Work, crc_fold, pieces, texts

FOLDS, HELD_OUT = 7, 2
#: Training documents with this remainder are the deleted part, on which the mixture weights are learned.
DELETED = 3
BLOCK_TOKENS = 1_200_000
RANGE_TOKENS = 1_000_000
PAIR_BITS = 56
BUCKETS = 32
GRID = 8  # cells of the histogram for each factor of two in a probability
EM_STEPS = 60
END = xxhash.xxh64_intdigest(b"")


def squeeze(values: np.ndarray) -> bytes:
    """Unsigned integers by byte planes, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueeze(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def squeeze_sorted(values: np.ndarray) -> bytes:
    return squeeze(np.diff(values, prepend=np.uint64(0)))


def unsqueeze_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(data, np.uint64), dtype=np.uint64)


def word_hashes(text: str) -> list[int]:
    """Hashes of the words and of the end; bytes.lower() changes A-Z alone, split() takes \\x20 and \\x09-\\x0D."""
    digest = xxhash.xxh64_intdigest
    return [*map(digest, text.encode().lower().split()), END]


def contexts(tokens: np.ndarray, sizes: np.ndarray, end: int) -> np.ndarray:
    """The token before each; before a document's first stands the end."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)] = end
    return before


def pair_keys(words: np.ndarray, tokens: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of the distinct bigrams, and each token's place among them."""
    codes, place = np.unique(before.astype(np.uint64) * np.uint64(len(words)) + tokens, return_inverse=True)
    first, second = words[codes // np.uint64(len(words))], words[codes % np.uint64(len(words))]
    keys = (first ^ (first >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + second
    keys = (keys ^ (keys >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    keys = (keys ^ (keys >> np.uint64(31))) >> np.uint64(64 - PAIR_BITS)
    keys, merged = np.unique(keys, return_inverse=True)
    return keys, merged[place]


BLOCK = "block long, ids array<long>, sizes binary, parts binary, words binary, tokens binary, n_tokens long"
BLOCK_ARROW = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 4, pa.int64()]


def make_blocks(docs: DataFrame, folds: int, held_out: int, deleted: int, block_tokens: int) -> DataFrame:
    """Documents by blocks: ids, token counts, part (0 retained, 1 deleted, 2 held out), words, tokens as word numbers."""
    names = [x.split()[0] for x in BLOCK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, parts, hashes, sizes = [], [], [], []

        def block():
            words, tokens = np.unique(np.concatenate(hashes), return_inverse=True)
            row = [
                number,
                ids,
                squeeze(np.array(sizes, np.uint32)),
                squeeze(np.array(parts, np.uint8)),
                squeeze_sorted(words),
                squeeze(tokens.astype(np.uint32)),
                tokens.size,
            ]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, BLOCK_ARROW, strict=True)], names)

        for batch in pieces(batches):
            for doc_id, part, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = np.array(word_hashes(text), np.uint64)
                ids.append(doc_id)
                parts.append(part)
                hashes.append(found)
                sizes.append(found.size)
            if sum(sizes) >= block_tokens:
                yield block()
                ids, parts, hashes, sizes = [], [], [], []
                number += 1
        if ids:
            yield block()

    fold = crc_fold(F.col("doc_id"), folds)
    part = F.when(fold == held_out, 2).when(fold == deleted, 1).otherwise(0).cast("int")
    return texts(docs).select(F.col("doc_id").cast("long"), part, "text").mapInArrow(run, BLOCK)


def decode_block(row: dict) -> tuple[np.ndarray, ...]:
    words = unsqueeze_sorted(row["words"])
    tokens, sizes = unsqueeze(row["tokens"], np.uint32), unsqueeze(row["sizes"], np.uint32).astype(np.int64)
    before = contexts(tokens, sizes, int(np.searchsorted(words, np.uint64(END))))
    return words, tokens, sizes, np.repeat(unsqueeze(row["parts"], np.uint8), sizes), before


def ranges_of(sets: list[tuple[np.ndarray, int]], ranges: int) -> Iterator[tuple[int, list[slice]]]:
    """Of sorted keys of so many bits each: the key ranges that any of them has, with its slice of each. ranges is a power
    of two. There are never more ranges than keys, however many ranges the corpus has."""
    parts = [keys >> np.uint64(bits - (ranges.bit_length() - 1)) for keys, bits in sets]
    found = np.unique(np.concatenate([p[np.concatenate([[True], p[1:] != p[:-1]])] if p.size else p for p in parts]))
    ends = [(np.searchsorted(p, found, "left"), np.searchsorted(p, found, "right")) for p in parts]
    for k, q in enumerate(found.tolist()):
        yield q, [slice(first[k], last[k]) for first, last in ends]


KINDS = ("word", "pair")
ASK = "part int, block long, " + ", ".join(f"{k}_keys binary, {k}_kept binary, {k}_cut binary" for k in KINDS)
ANSWER = (
    "part int, block long, " + ", ".join(f"{k}_kept binary, {k}_cut binary" for k in KINDS)
    + ", n_kept long, n_cut long, v_kept long, v_all long"
)


def ask(blocks: DataFrame, ranges: int) -> DataFrame:
    """One row per block and key range: the distinct words and bigrams there with the block's own counts."""
    names = [x.split()[0] for x in ASK.split(", ")]
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 6]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            words, tokens, _, parts, before = decode_block(row)
            pairs, places = pair_keys(words, tokens, before)
            sets = []
            for keys, at, bits in ((words, tokens, 64), (pairs, places, PAIR_BITS)):
                kept, cut = (np.bincount(at[parts == k], minlength=keys.size).astype(np.uint32) for k in (0, 1))
                sets.append((keys, kept, cut, bits))
            rows = []
            for q, own in ranges_of([(keys, bits) for keys, _, _, bits in sets], ranges):
                slices = [(squeeze_sorted(keys[s]), squeeze(kept[s]), squeeze(cut[s])) for (keys, kept, cut, _), s in zip(sets, own, strict=True)]
                rows.append((q, row["block"], *(x for s in slices for x in s)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    return blocks.mapInArrow(run, ASK)


def answer(asked: DataFrame) -> DataFrame:
    """The counts over all blocks, in the order in which each block asked for them."""
    names = [x.split()[0] for x in ANSWER.split(", ")]
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4, *[pa.int64()] * 4]

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["block"])
        out = [[r["part"], r["block"]] for r in rows]
        sums = [0, 0, 0, 0]
        for kind in KINDS:
            keys = [unsqueeze_sorted(r[f"{kind}_keys"]) for r in rows]
            ends = np.cumsum([k.size for k in keys])[:-1]
            distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
            totals = []
            for part in ("kept", "cut"):
                own = np.concatenate([unsqueeze(r[f"{kind}_{part}"], np.uint32) for r in rows])
                totals.append(np.bincount(place, weights=own, minlength=distinct.size))
            if kind == "word":
                sums = [int(totals[0].sum()), int(totals[1].sum()), int((totals[0] > 0).sum()), int((totals[0] + totals[1] > 0).sum())]
            for target, *slices in zip(out, *(np.split(t[place].astype(np.uint64), ends) for t in totals), strict=True):
                target.extend(map(squeeze, slices))
        for k, target in enumerate(out):
            target.extend(sums if k == 0 else [0, 0, 0, 0])
        return pa.Table.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names)

    return asked.groupBy("part").applyInArrow(run, ANSWER)


RESOLVED = "ids array<long>, sizes binary, parts binary, tokens binary, words_kept binary, words_cut binary, pairs_kept binary, pairs_cut binary, end long"


def resolve(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """Blocks with the counts of each word number, and of each token's bigram."""
    names = [x.split()[0] for x in RESOLVED.split(", ")]
    kinds = [pa.list_(pa.int64()), *[pa.binary()] * 7, pa.int64()]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        (row,) = left.to_pylist()
        found = sorted(right.to_pylist(), key=lambda r: r["part"])
        words, tokens, _, _, before = decode_block(row)
        _, places = pair_keys(words, tokens, before)
        counts = {c: np.concatenate([unsqueeze(r[c], np.uint64) for r in found]) for c in (f"{k}_{p}" for k in KINDS for p in ("kept", "cut"))}
        out = [row["ids"], row["sizes"], row["parts"], row["tokens"], squeeze(counts["word_kept"]), squeeze(counts["word_cut"])]
        out += [squeeze(counts[f"pair_{p}"][places]) for p in ("kept", "cut")]
        out.append(int(np.searchsorted(words, np.uint64(END))))
        return pa.Table.from_arrays([pa.array([x], k) for x, k in zip(out, kinds, strict=True)], names)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, RESOLVED)


def bucket(count: np.ndarray) -> np.ndarray:
    """0 for a context that was not met, else one more than the whole part of its count's logarithm to base 2."""
    return np.where(count > 0, np.minimum(np.log2(np.maximum(count, 1)).astype(np.int64) + 1, BUCKETS - 1), 0)


def unpack(row: dict) -> tuple[np.ndarray, ...]:
    """sizes, parts, then per token kept and deleted counts of the word, of its context, of both."""
    sizes, parts = unsqueeze(row["sizes"], np.uint32).astype(np.int64), unsqueeze(row["parts"], np.uint8)
    tokens = unsqueeze(row["tokens"], np.uint32)
    before = contexts(tokens, sizes, row["end"])
    words = [unsqueeze(row[f"words_{p}"], np.uint64).astype(np.float64) for p in ("kept", "cut")]
    pairs = [unsqueeze(row[f"pairs_{p}"], np.uint64).astype(np.float64) for p in ("kept", "cut")]
    return sizes, parts, *(w[tokens] for w in words), *(w[before] for w in words), *pairs


def deleted_histogram(resolved: DataFrame, kept_tokens: int) -> list[tuple[int, int, int, int]]:
    """How many tokens of the deleted part have a context bucket, a bigram and a unigram estimate (as grid steps; -1: zero)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            sizes, parts, word, _, context, _, pair, _ = unpack(row)
            use = np.repeat(parts == 1, sizes)
            word, context, pair = word[use], context[use], pair[use]
            with np.errstate(divide="ignore", invalid="ignore"):
                steps = [
                    np.where(top > 0, np.rint(-GRID * np.log2(np.where(top > 0, top, 1) / np.maximum(base, 1))), -1).astype(np.int32)
                    for top, base in ((pair, context), (word, np.float64(kept_tokens)))
                ]
            # one number for each cell: sorting it takes far less memory than sorting rows
            cell, n = np.unique((bucket(context) << 40) + ((steps[0] + 1).astype(np.int64) << 20) + (steps[1] + 1), return_counts=True)
            cells = np.stack([cell >> 40, (cell >> 20 & 0xFFFFF) - 1, (cell & 0xFFFFF) - 1], axis=1)
            yield pa.RecordBatch.from_arrays([*(pa.array(cells[:, k].astype(np.int32)) for k in range(3)), pa.array(n, pa.int64())], names)

    names = ["bucket", "pair", "word", "n"]
    cells = resolved.mapInArrow(run, "bucket int, pair int, word int, n long").groupBy(*names[:3]).agg(F.sum("n").alias("n"))
    return [tuple(r) for r in cells.collect()]


def learn_weights(cells: list[tuple[int, int, int, int]], uniform: float) -> np.ndarray:
    """Mixture weights (bigram, unigram, uniform) by bucket; buckets without events take those of all events. A context that
    was not met (bucket 0) has no bigrams, so the other two share its weight."""
    table = np.array(sorted(cells), float).reshape(-1, 4)
    p = np.stack([np.where(table[:, k] < 0, 0, 2.0 ** (-table[:, k] / GRID)) for k in (1, 2)] + [np.full(len(table), uniform)], axis=1)

    def fit(rows: np.ndarray, start: np.ndarray, prior: np.ndarray) -> np.ndarray:
        weights, n = start, table[rows, 3]
        for _ in range(EM_STEPS):
            share = weights * p[rows]
            share /= share.sum(axis=1, keepdims=True)
            weights = prior + (share * n[:, None]).sum(axis=0)
            weights = weights / weights.sum()
        return weights

    overall = fit(np.arange(len(table)), np.full(3, 1 / 3), np.ones(3))
    out = np.tile(overall, (BUCKETS, 1))
    for k in range(BUCKETS):
        rows = np.flatnonzero(table[:, 0] == k)
        if rows.size:
            out[k] = fit(rows, overall, overall)
    out[0, 0] = 0
    out[0] /= out[0].sum()
    return out


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_blocks(resolved: DataFrame, weights: np.ndarray, n: int, v: int) -> DataFrame:
    names = [x.split()[0] for x in SCORES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            sizes, parts, *counts = unpack(row)
            word, context, pair = (counts[k] + counts[k + 1] for k in (0, 2, 4))
            mix = weights[bucket(context)]
            p = mix[:, 0] * pair / np.maximum(context, 1) + mix[:, 1] * word / max(n, 1) + mix[:, 2] / (v + 1)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
            base = np.add.reduceat(np.log10((word + 1) / (n + v + 1)), starts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["ids"], pa.int64()),
                    pa.array(parts == 2),
                    pa.array(sizes),
                    pa.array(np.add.reduceat((word > 0).astype(np.int64), starts)),
                    pa.array(np.full(len(sizes), n, np.int64)),
                    pa.array(base),
                    pa.array(np.add.reduceat(np.log10(p), starts)),
                ],
                names,
            )

    return resolved.mapInArrow(run, SCORES)


def score_language_model(
    docs: DataFrame,
    folds: int = FOLDS,
    held_out: int = HELD_OUT,
    deleted: int = DELETED,
    block_tokens: int = BLOCK_TOKENS,
    range_tokens: int = RANGE_TOKENS,
) -> DataFrame:
    """Scores each row of docs(doc_id, text) with a model of all rows but those with crc32(doc_id) mod folds = held_out.

    A-Z are lower-cased; tokens are the words between white space and one end. Returns one row per input row:
    doc_id, held_out, n_tokens, n_known (tokens met in training), train_tokens (N), base_score (log10 probability
    under add-one unigrams) and score (under the interpolated model).

    A null text is empty and has the end alone. A null doc_id counts as the empty string for the folds. Repeated
    rows count as often as they are there. Other columns are ignored. Without training rows all tokens are
    unknown and share one probability. An empty table gives no rows.
    """
    work = Work(docs.sparkSession, "lm")
    blocks = work.save(make_blocks(docs, folds, held_out, deleted, block_tokens), "blocks")
    total = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    ranges = 1 << max(4, (max(1, total // range_tokens) - 1).bit_length())
    answers = work.save(answer(ask(blocks, ranges)), "answers")
    sums = answers.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("n_kept", "n_cut", "v_kept", "v_all"))).first()
    kept, cut, v_kept, v = map(int, sums)
    resolved = work.save(resolve(blocks, answers.drop("n_kept", "n_cut", "v_kept", "v_all")), "resolved")
    work.drop("blocks", "answers")
    weights = learn_weights(deleted_histogram(resolved, kept), 1 / (v_kept + 1))
    return score_blocks(resolved, weights, kept + cut, v)
