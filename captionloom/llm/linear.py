"""Small logistic models for calibration, and bounded samples of labelled documents."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, texts

#: Characters of the labelled documents that a classifier is fitted on.
SAMPLE_CHARS = 100_000_000


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(np.asarray(x, float) / 2))


class Logistic:
    """Ridge logistic regression by Newton steps on standardised features; without two classes, their share."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 40):
        x, y = np.asarray(x, float), np.asarray(y, float)
        if not y.size:
            x, y = np.zeros((1, x.shape[-1])), np.zeros(1)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0)
        self.scale[self.scale < 1e-9] = 1.0
        z = self._design(x)
        self.weights = np.zeros(z.shape[1])
        if y.min() == y.max():
            p = (y.sum() + 0.5) / (y.size + 1)
            self.weights[0] = np.log(p / (1 - p))
            return
        penalty = np.full(z.shape[1], ridge)
        penalty[0] = 1e-6
        for _ in range(steps):
            p = sigmoid(z @ self.weights)
            slope = z.T @ (p - y) + penalty * self.weights
            curve = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(curve, slope)
            self.weights -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
            if np.abs(step).max() < 1e-8:
                break

    def _design(self, x: np.ndarray) -> np.ndarray:
        z = (np.asarray(x, float) - self.mean) / self.scale
        return np.concatenate([np.ones((z.shape[0], 1)), z], axis=1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self._design(x) @ self.weights)


def known_labels(labels: DataFrame, label: str, folds: int, held_out: int) -> DataFrame:
    """doc_id, label of documents that are not held out; of labels that contradict each other the smaller counts."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id is not null and label is not null")
    return known.where(crc_fold(F.col("doc_id"), folds) != held_out).groupBy("doc_id").agg(F.min("label").alias("label"))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: dict[int, int], most_chars: int = SAMPLE_CHARS
) -> tuple[list[str], np.ndarray]:
    """Texts and labels of at most most[k] documents of each label k that are not held out, most_chars characters in all.

    The ids are taken in the order of a hash, so the sample is the same on every run and its size is bounded
    whatever the corpus; the ids (and only they) are broadcast to the scans of the texts. Of several texts of an id
    one is taken. A document that would go beyond most_chars is left out, whole.
    """
    known = known_labels(labels, label, folds, held_out).join(docs.select("doc_id"), "doc_id", "left_semi")
    ids = None
    for value, n in most.items():
        part = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        ids = part if ids is None else ids.unionByName(part)
    spark, wanted = docs.sparkSession, {r.doc_id: r.label for r in ids.collect()}

    def of(ids: list[int]) -> DataFrame:
        return texts(docs).join(F.broadcast(spark.createDataFrame([(i,) for i in ids], "doc_id long")), "doc_id").groupBy("doc_id")

    sizes = {r.doc_id: r.n for r in of(list(wanted)).agg(F.length(F.min("text")).alias("n")).collect()} if wanted else {}
    chosen, used = [], 0
    for doc_id in wanted:
        if used + sizes.get(doc_id, 0) <= most_chars:
            chosen.append(doc_id)
            used += sizes.get(doc_id, 0)
    rows = sorted(of(chosen).agg(F.min("text").alias("text")).collect()) if chosen else []
    return [r.text for r in rows], np.array([wanted[r.doc_id] for r in rows], int)
