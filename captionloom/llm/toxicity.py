"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text.

A text is cut into windows of a few words. Each window is compressed twice, with a dictionary trained on ordinary
text and with one trained on toxic text; what the second saves over the first tells how much of the window it
knows. The toxic dictionary ends in the ordinary one's content, so that ordinary words cost alike in both and the
difference is due to what is typical of toxic text alone. A document's largest savings and the numbers of windows
above thresholds, which are calibrated by how often ordinary windows reach them, go through a logistic calibration
fitted on labelled documents.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, pieces, texts
from .linear import Logistic, labelled_sample

FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.5
#: The classifier is fitted on at most this many toxic and ordinary labelled documents.
MAX_TOXIC, MAX_ORDINARY = 3000, 5000
WINDOW = 6
ORDINARY_BYTES, TOXIC_BYTES = 16384, 4096
#: A word or phrase is typical of toxic text if it stands between this many different pairs of words there, at LIFT
#: times the ordinary rate.
CONTEXTS, LIFT = 8, 30.0
#: Characters of these documents in all.
MAX_CHARS = 20_000_000
#: Windows are counted above the savings that so few ordinary windows of the calibration part reach.
RATES = (1e-2, 1e-3, 2e-4)
#: Ordinary training windows that save at least HARD bytes, of which HARD_BYTES go into both dictionaries.
HARD, HARD_BYTES = 3, 12288
LEVEL, MIN_MATCH = 12, 3


def windows(text: str, size: int = WINDOW) -> list[bytes]:
    words = text.encode().lower().split()
    return [b" " + b" ".join(words[k : k + size]) + b" " for k in range(0, len(words), size)]


def trained(samples: list[bytes], size: int) -> bytes:
    """A dictionary trained on samples, used as plain content; of too few samples, their last bytes."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


def phrases(words: list[bytes], size: int) -> Iterator[tuple[int, bytes]]:
    """The runs of size words, each with its place."""
    return ((k, b" ".join(words[k : k + size])) for k in range(len(words) - size + 1))


def contexts(texts_: list[list[bytes]], only: set[bytes], size: int) -> dict[bytes, int]:
    """Between how many different pairs of words each phrase stands; copies of a text add nothing."""
    around: dict[bytes, set[tuple[bytes, bytes]]] = defaultdict(set)
    for words in texts_:
        padded = [b"", *words, b""]
        for k, phrase in phrases(words, size):
            if phrase in only:
                around[phrase].add((padded[k], padded[k + size + 1]))
    return {w: len(x) for w, x in around.items()}


def typical(toxic: list[list[bytes]], ordinary: list[list[bytes]], window: int) -> list[bytes]:
    """Where toxic text has words that are typical of it, or phrases that are although none of their words is."""
    n1, n0 = (max(1, sum(map(len, x))) for x in (toxic, ordinary))
    alone: set[bytes] = set()
    often: set[bytes] = set()
    out = []
    for size in range(1, window + 1):
        # a phrase is as rare as the rarer of the two that are a word shorter
        last = often
        seen = Counter(x for words in toxic for _, x in phrases(words, size) if size == 1 or {x.rsplit(b" ", 1)[0], x.split(b" ", 1)[1]} <= last)
        often = {x for x, n in seen.items() if n >= 2}
        there, here = contexts(toxic, often, size), contexts(ordinary, often, size)
        found = {x for x, n in there.items() if n >= CONTEXTS and n / n1 > LIFT * (here.get(x, 0) + 0.5) / n0}
        found = {x for x in found if size == 1 or alone.isdisjoint(x.split())}
        alone = found if size == 1 else alone
        out += [b" " + x + b" " for words in toxic for _, x in phrases(words, size) if x in found]
    return out


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    calibration: Logistic
    window: int
    limits: tuple[int, ...] = ()

    def compressors(self):
        out = []
        for content in (self.ordinary, self.toxic):
            data = zstandard.ZstdCompressionDict(content or b"        ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            params = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, dict_size=len(content), min_match=MIN_MATCH, write_content_size=0, write_checksum=0, write_dict_id=0, window_log=17
            )
            data.precompute_compress(compression_params=params)
            out.append(zstandard.ZstdCompressor(dict_data=data, compression_params=params).compress)
        return out

    def savings(self, parts: list[bytes], compressors) -> np.ndarray:
        ordinary, toxic = compressors
        return np.array([len(ordinary(x)) - len(toxic(x)) for x in parts] or [0])

    def features(self, text: str, compressors) -> list[float]:
        return self.describe(self.savings(windows(text, self.window), compressors))

    def describe(self, saved: np.ndarray) -> list[float]:
        top = np.sort(saved)[-3:]
        counts = [np.log1p(int((saved >= t).sum())) for t in self.limits]
        return [float(top[-1]), float(top.mean()), *counts, float(np.log1p(saved.size))]


def dictionaries(texts_: list[str], labels: np.ndarray, window: int) -> Model:
    """The two dictionaries of a labelled sample, without limits and calibration."""
    split = {k: [t.encode().lower().split() for t, label in zip(texts_, labels, strict=True) if label == k] for k in (0, 1)}
    marked = typical(split[1], split[0], window)
    plain = [x for words in split[0] for x in (b" " + b" ".join(words[k : k + window]) + b" " for k in range(0, len(words), window))]
    ordinary = trained(plain, ORDINARY_BYTES)
    words = trained(marked, TOXIC_BYTES)
    model = Model(ordinary, words + ordinary, None, window)
    # ordinary windows in which the toxic dictionary saves most are added to both, where they cost alike from then on
    different = list(dict.fromkeys(plain))
    saved = model.savings(different, model.compressors())
    hard = [x for n, x in sorted(zip((-saved).tolist(), different, strict=False)) if n <= -HARD]
    ordinary = b"".join(dict.fromkeys(hard))[:HARD_BYTES] + ordinary
    return Model(ordinary, words + ordinary, None, window)


def train(texts_: list[str], labels: np.ndarray, window: int = WINDOW) -> Model:
    """Dictionaries from two thirds of the sample, thresholds and calibration from the rest, at every size."""
    part = np.arange(labels.size) % 3 != 2
    model = dictionaries([t for t, p in zip(texts_, part, strict=True) if p], labels[part], window)
    tools, use = model.compressors(), np.flatnonzero(~part)
    found = [model.savings(windows(texts_[i], window), tools) for i in use]
    usual = np.concatenate([np.zeros(1, int), *(x for x, i in zip(found, use, strict=True) if labels[i] == 0)])
    limits = tuple(max(1, int(np.quantile(usual, 1 - r, method="lower")) + 1) for r in RATES)
    model = Model(model.ordinary, model.toxic, None, window, limits)
    x = np.array([model.describe(saved) for saved in found]).reshape(-1, 3 + len(limits))
    return Model(model.ordinary, model.toxic, Logistic(x, labels[use]), window, limits)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = FOLDS,
    held_out: int = HELD_OUT,
    threshold: float = THRESHOLD,
    max_toxic: int = MAX_TOXIC,
    max_ordinary: int = MAX_ORDINARY,
    carry: bool = False,
) -> DataFrame:
    """Scores each row of docs(doc_id, text), learning from labels(doc_id, toxic 0/1).

    Labels of documents whose crc32(doc_id) modulo folds is held_out are not learned from. Returns one row per
    input row: doc_id, held_out, score (0 to 1), predicted (1 if score >= threshold), and with carry the
    input row itself as the struct row, which saves a join where documents are to be filtered.

    A null text is empty, and an empty text has a score like any other. A null doc_id counts as the empty
    string for held_out. Labels that are null or of no document are passed over, of labels that contradict each other
    the smaller counts, of several texts of an id one is learned from; without labels of both kinds the score is their share. Repeated rows have equal scores. Other columns are ignored; an empty table gives
    no rows.
    """
    sample, known = labelled_sample(docs, labels, "toxic", folds, held_out, {1: max_toxic, 0: max_ordinary}, MAX_CHARS)
    model = train(sample, known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = model.compressors()
        for batch in pieces(batches):
            x = np.array([model.features(t, tools) for t in batch.column(2).to_pylist()])
            score = model.calibration.predict(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32)), *batch.columns[3:]], names
            )

    names = ["doc_id", "held_out", "score", "predicted"] + ["row"] * carry
    more = [F.struct(*(docs[c] for c in docs.columns)).alias("row")] if carry else []
    held = (crc_fold(F.col("doc_id"), folds) == held_out).alias("held_out")
    rows = texts(docs, *more).select(F.col("doc_id").cast("long"), held, "text", *(["row"] if carry else []))
    schema = "doc_id long, held_out boolean, score double, predicted int"
    return rows.mapInArrow(run, f"{schema}, row {rows.schema['row'].dataType.simpleString()}" if carry else schema)
