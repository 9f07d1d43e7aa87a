"""Quality classifier: naive Bayes support vectors over hashed n-gram indicators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import learnable

SLOTS = 1 << 18
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def features(text: str | None) -> np.ndarray:
    """Slots of a text's n-grams, each once: words, word pairs, whether a word repeats the one before, and four characters in a row."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return np.empty(0, dtype=np.int64)
    h = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), dtype=">u8").astype(np.uint64)
    pairs = h[:-1] * _A + h[1:]
    again = np.unique((h[:-1] == h[1:]).astype(np.uint64))
    points = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8).astype(np.uint64)
    grams = np.uint64(0)
    if len(points) >= 4:
        grams = ((points[:-3] << np.uint64(24)) + (points[1:-2] << np.uint64(16)) + (points[2:-1] << np.uint64(8)) + points[3:]) * _B
        mixed = np.concatenate([h * _B, pairs * _B, (again + np.uint64(7)) * _B, grams * _A])
    else:
        mixed = np.concatenate([h * _B, pairs * _B, (again + np.uint64(7)) * _B])
    seen = np.zeros(SLOTS, dtype=bool)
    seen[(mixed >> np.uint64(46)).astype(np.int64)] = True
    return np.nonzero(seen)[0]


@dataclass
class Model:
    """Weights of the slots, bias, and the logistic that turns a margin into the probability of label 1."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, slots: np.ndarray) -> float:
        return float(self.weights[slots].sum() / np.sqrt(max(1, len(slots)))) + self.bias

    def score(self, slots: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(slots) + self.shift, -500, 500))))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    counts = [np.full(SLOTS, alpha), np.full(SLOTS, alpha)]
    for slots, label in zip(rows, labels):
        counts[int(label)][slots] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def dual_coordinate_descent(rows: list[np.ndarray], labels: np.ndarray, cost: float, epochs: int = 12) -> Model:
    """L2-regularised hinge loss over indicators scaled by their ratios and the root of their number; the classes weigh the same."""
    ratio = log_count_ratios(rows, labels)
    y = np.where(labels == 1, 1.0, -1.0)
    share = np.array([max(1, (labels == k).sum()) for k in (0, 1)]) * 2 / len(labels)
    upper = cost / share[labels]
    scaled = [(s, ratio[s] / np.sqrt(max(1, len(s)))) for s in rows]
    diagonal = np.array([float(v @ v) + 1.0 for _, v in scaled])
    w, b, dual = np.zeros(SLOTS), 0.0, np.zeros(len(rows))
    order = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            s, v = scaled[i]
            gradient = y[i] * (float(w[s] @ v) + b) - 1
            new = min(max(dual[i] - gradient / diagonal[i], 0.0), upper[i])
            step = (new - dual[i]) * y[i]
            if step:
                w[s] += step * v
                b += step
                moved = max(moved, abs(step))
                dual[i] = new
        if moved < 1e-4:
            break
    return Model(w * ratio, b)


def calibrated(margins: np.ndarray, labels: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Slope and shift of a logistic fitted to held-out margins (Newton steps, targets drawn in from 0 and 1)."""
    up, down = (labels == 1).sum(), (labels == 0).sum()
    target = np.where(labels == 1, (up + 1) / (up + 2), 1 / (down + 2))
    at = np.array([1.0, 0.0])
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -500, 500)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (target - p))
        at = at + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(at[0]), 1e-3), float(at[1])


def train(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0, folds: int = 3) -> Model | None:
    """A calibrated model; None unless both labels occur."""
    if len(set(labels.tolist())) < 2:
        return None
    model = dual_coordinate_descent(rows, labels, cost)
    fold, margins = np.arange(len(rows)) % folds, np.zeros(len(rows))
    for k in range(folds):
        kept = np.nonzero(fold != k)[0]
        if len(set(labels[kept].tolist())) < 2:
            margins = np.array([model.margin(s) for s in rows])
            break
        part = dual_coordinate_descent([rows[i] for i in kept], labels[kept], cost)
        for i in np.nonzero(fold == k)[0]:
            margins[i] = part.margin(rows[i])
    model.slope, model.shift = calibrated(margins, labels)
    return model


def _featured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = [features(t.as_py()).astype(np.int32).tobytes() for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(raw, pa.binary())], names=["doc_id", "label", "slots"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most_rows: int = 6000) -> Model | None:
    """Learns from `labels` (doc_id, `label` 0 or 1) joined with the texts of `docs`.

    At most about `most_rows` labelled rows are taken, those with the smallest hashes of doc_id: the bound of the
    sample, and of what the driver holds.
    """
    known = labels.filter(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("label"))
    rows = known.count()
    drawn = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < min(1.0, most_rows / max(1, rows)) * (1 << 20))
    found = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").mapInArrow(_featured, "doc_id long, label int, slots binary")
    sample = sorted(((r["doc_id"], r["label"], r["slots"]) for r in found.toLocalIterator()), key=lambda r: (r[0] is None, r))
    return train([np.frombuffer(s, dtype=np.int32) for _, _, s in sample], np.array([k for _, k, _ in sample], dtype=np.int64))


def _scored(weights: bytes | None, model: Model | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model and Model(np.frombuffer(weights, dtype=np.float32).astype(np.float64), model.bias, model.slope, model.shift)
        for batch in batches:
            scores = [own.score(features(t.as_py())) if own else 0.5 for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score (probability of label 1) of every document of `docs` (doc_id, text).

    Null and blank texts have no n-gram and get the model's prior; without a model every score is 0.5. Very long texts are
    read whole, one at a time. Equal texts have equal scores, so ties stay ties. Repeated rows are scored each; other
    columns are ignored, whatever their names; an empty table gives no rows.
    """
    slim = model and Model(np.empty(0), model.bias, model.slope, model.shift)
    return docs.select("doc_id", "text").mapInArrow(_scored(model and model.weights.astype(np.float32).tobytes(), slim), "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """Scores `docs` with a model of the labelled rows outside the held-out quarter.

    The order of rows does not matter: labelled rows are taken and sorted by what they hold. Repeated labelled rows count each.
    Nulls, very long texts, ties and empty tables are as `score` has them.
    """
    return score(docs, fit(docs, labels.filter(learnable(F.col("doc_id"))), label))
