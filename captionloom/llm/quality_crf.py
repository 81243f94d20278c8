"""Document quality from a linear-chain conditional random field over lines.

Each line has features of its own and of its neighbours. A two-state chain (good, bad) is fitted on lines that
inherit the labels of their documents; forward-backward sums give each line's marginal probability of being
good. A document's quality is the mean of its lines' marginals weighted by their lengths, put through a logistic
calibration that is fitted on a third of the sample, which the field has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, pieces_by_size, texts
from .linear import Logistic, labelled_sample

FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.7
#: The field is fitted on at most this many labelled documents of each kind.
MAX_EACH = 1500
#: Lines, padding included, of the documents that are taken together; a longer document stands alone.
PADDED_LINES = 80_000
STEPS, RATE, RIDGE = 100, 0.1, 1e-3

UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
LETTERS = UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
SPACE = b" \t\r\x0b\x0c"
COMMON = b".,"
OWN = 15
#: Documents that are padded together when scored.
TOGETHER = 32


def line_features(line: str) -> list[float]:
    raw = line.encode()
    n = len(raw) or 1
    words = raw.split()
    m = len(words) or 1
    bare = raw.translate(None, LETTERS)
    letters = len(raw) - len(bare)
    digits = len(bare) - len(bare.translate(None, DIGITS))
    marks = len(bare.translate(None, DIGITS + SPACE + COMMON))
    upper = len(raw) - len(raw.translate(None, UPPER))
    same = sum(map(eq, words, words[1:]))
    ends = b"".join([w[-1:] for w in words])
    odd_ends = len(ends.translate(None, LETTERS + DIGITS + COMMON))
    return [
        np.log1p(len(raw)),
        np.log1p(len(words)),
        letters / n,
        digits / n,
        marks / n,
        min(1.0, 5 * marks / n),
        upper / max(1, letters),
        raw.count(b"|") / m,
        raw.count(b"!") / m,
        odd_ends / m,
        len(set(words)) / m,
        same / m,
        min(20.0, letters / m),
        float(raw[-1:] in (b".", b"!", b"?")),
        float(not words),
    ]


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line (its own, the one's before, the one's after, first, last), and the lines' lengths."""
    lines = text.split("\n")
    own = np.array([line_features(x) for x in lines])
    edge = np.zeros((1, OWN))
    first, last = np.zeros((len(lines), 1)), np.zeros((len(lines), 1))
    first[0] = last[-1] = 1
    x = np.concatenate([own, np.concatenate([edge, own[:-1]]), np.concatenate([own[1:], edge]), first, last], axis=1)
    return x, np.array([len(line) + 1 for line in lines], float)


def together(lengths: list[int], most: int) -> list[list[int]]:
    """Documents of like length in groups of at most `most` documents, and PADDED_LINES lines or one document."""
    groups: list[list[int]] = []
    for i in np.argsort(lengths, kind="stable").tolist():
        if not groups or len(groups[-1]) >= most or (len(groups[-1]) + 1) * lengths[i] > PADDED_LINES:
            groups.append([])
        groups[-1].append(i)
    return groups


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def forward_backward(emit: np.ndarray, move: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """State marginals (documents x lines x 2) and expected moves (2 x 2), over padded lines (real: not padding)."""
    docs, lines, _ = emit.shape
    alpha, beta = np.empty_like(emit), np.zeros_like(emit)
    alpha[:, 0] = emit[:, 0]
    for t in range(1, lines):
        step = log_sum(alpha[:, t - 1, :, None] + move, 1) + emit[:, t]
        alpha[:, t] = np.where(real[:, t, None], step, alpha[:, t - 1])
    for t in range(lines - 2, -1, -1):
        step = log_sum(move + (emit[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        beta[:, t] = np.where(real[:, t + 1, None], step, 0)
    total = log_sum(alpha[:, -1], 1)
    marginal = np.exp(alpha + beta - total[:, None, None]) * real[:, :, None]
    if lines > 1:
        pair = alpha[:, :-1, :, None] + move + (emit + beta)[:, 1:, None, :] - total[:, None, None, None]
        moves = (np.exp(np.minimum(pair, 0)) * real[:, 1:, None, None]).sum(axis=(0, 1))
    else:
        moves = np.zeros((2, 2))
    return marginal, moves


@dataclass(frozen=True)
class Field:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    move: np.ndarray
    calibration: Logistic

    def marginals(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        """Of each document's lines, their probability of being good. Documents of like length are padded together."""
        out: list[np.ndarray] = [None] * len(rows)
        for ids in together([len(x) for x in rows], TOGETHER):
            emit = np.zeros((len(ids), max(len(rows[i]) for i in ids), 2))
            real = np.zeros(emit.shape[:2], bool)
            for k, i in enumerate(ids):
                emit[k, : len(rows[i])] = ((rows[i] - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]
                real[k, : len(rows[i])] = True
            good = forward_backward(emit, self.move, real)[0][:, :, 1]
            for k, i in enumerate(ids):
                out[i] = good[k, : len(rows[i])]
        return out

    def aggregate(self, texts_: list[str]) -> np.ndarray:
        """Of each text: length-weighted good share as log-odds and as it is, and the worst line's share."""
        found = [document_features(t) for t in texts_]
        out = np.empty((len(texts_), 3))
        for k, (good, (_, lengths)) in enumerate(zip(self.marginals([x for x, _ in found]), found, strict=True)):
            share = float(good @ lengths / lengths.sum())
            kept = min(max(share, 1e-6), 1 - 1e-6)
            out[k] = np.log(kept / (1 - kept)), share, good.min()
        return out


def train(texts_: list[str], labels: np.ndarray) -> Field:
    """The field from two thirds of the sample, its calibration from the rest, at every size: no document's score is calibrated on
    a field that has seen it."""
    part = np.arange(labels.size) % 3 != 2
    field = fit([t for t, p in zip(texts_, part, strict=True) if p], labels[part])
    seen = field.aggregate([t for t, p in zip(texts_, part, strict=True) if not p])
    return replace(field, calibration=Logistic(seen, labels[~part]))


def fit(texts_: list[str], labels: np.ndarray) -> Field:
    """Gradient ascent (Adam) on the penalised likelihood of the line labels."""
    width = 3 * OWN + 2
    rows = [document_features(t)[0] for t in texts_]
    if not rows:
        zero = np.zeros(width)
        return Field(zero, zero + 1, np.zeros((width + 1, 2)), np.zeros((2, 2)), None)
    flat = np.concatenate(rows)
    mean, scale = flat.mean(axis=0), flat.std(axis=0)
    scale[scale < 1e-6] = 1
    groups = []
    for ids in map(np.array, together([len(r) for r in rows], len(rows))):
        most = max(len(rows[i]) for i in ids)
        x, real = np.zeros((len(ids), most, width + 1)), np.zeros((len(ids), most), bool)
        for k, i in enumerate(ids):
            x[k, : len(rows[i]), :-1] = (rows[i] - mean) / scale
            x[k, : len(rows[i]), -1] = 1
            real[k, : len(rows[i])] = True
        y = np.eye(2)[labels[ids]][:, None, :] * real[:, :, None]
        # moves of the labelled chains: a document's label never changes
        stay = np.diag([float((real[labels[ids] == k].sum(axis=1) - 1).sum()) for k in (0, 1)])
        groups.append((x, real, y, stay))
    total = len(flat)
    weights, move = np.zeros((width + 1, 2)), np.zeros((2, 2))
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(move), np.zeros_like(move)]
    for step in range(1, STEPS + 1):
        slope_w, slope_m = -RIDGE * weights, -RIDGE * move
        for x, real, y, stay in groups:
            marginal, moves = forward_backward(x @ weights, move, real)
            slope_w += np.tensordot(x, y - marginal, axes=([0, 1], [0, 1])) / total
            slope_m += (stay - moves) / total
        for k, (value, slope) in enumerate(((weights, slope_w), (move, slope_m))):
            m, v = state[2 * k], state[2 * k + 1]
            m += 0.1 * (slope - m)
            v += 0.01 * (slope * slope - v)
            value += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(mean, scale, weights, move, None)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = FOLDS,
    held_out: int = HELD_OUT,
    threshold: float = THRESHOLD,
    max_each: int = MAX_EACH,
    carry: bool = False,
) -> DataFrame:
    """Scores each row of docs(doc_id, text), learning from labels(doc_id, quality 0/1).

    Labels of documents whose crc32(doc_id) modulo folds is held_out are not learned from. Returns one row per
    input row: doc_id, held_out, score (0 to 1: likely good), predicted (1 if score >= threshold), and with carry the
    input row itself as the struct row, which saves a join where documents are to be filtered.

    A null text is empty: one empty line. A null doc_id counts as the empty string for held_out. Labels that are
    null or of no document are passed over, of labels that contradict each other the smaller counts, of several texts of an
    id one is learned from; without labels of both kinds the score is their share. Repeated
    rows have equal scores. Other columns are ignored; an empty table gives no rows.
    """
    sample, known = labelled_sample(docs, labels, "quality", folds, held_out, {1: max_each, 0: max_each})
    model = train(sample, known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_by_size(batches, 2):
            score = model.calibration.predict(model.aggregate(batch.column(2).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32)), *batch.columns[3:]], names
            )

    names = ["doc_id", "held_out", "score", "predicted"] + ["row"] * carry
    more = [F.struct(*(docs[c] for c in docs.columns)).alias("row")] if carry else []
    held = (crc_fold(F.col("doc_id"), folds) == held_out).alias("held_out")
    rows = texts(docs, *more).select(F.col("doc_id").cast("long"), held, "text", *(["row"] if carry else []))
    schema = "doc_id long, held_out boolean, score double, predicted int"
    return rows.mapInArrow(run, f"{schema}, row {rows.schema['row'].dataType.simpleString()}" if carry else schema)
