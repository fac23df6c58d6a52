"""Quality classifier: a support vector machine over naive Bayes features.

A text is the set of its hashed character n-grams, and of levels of how often a word
follows itself (the word bigrams of equal words, taken as one). Each n-gram is scaled by the
log-ratio of its frequency in good and bad texts, texts are brought to unit
length, and a linear hinge-loss model is fitted by dual coordinate descent. A
logistic curve over margins of texts not fitted on turns margins into scores.

The model is fitted on at most about ``SAMPLE`` labelled rows, chosen by a hash
of their id, and is a table of ``BUCKETS`` weights; every text is scored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelattice.llm.common import by_record, held_out

# Labelled rows fitted on. Larger label tables are thinned by a hash of the id.
SAMPLE = 20_000
BITS = 18
BUCKETS = 1 << BITS
NGRAMS = (1, 2, 3)
_STEP = 1 << 20
_WORD = re.compile(r"\S+")
# One row in this many of the sample sets the logistic curve instead of the weights.
_CALIBRATION = 5


def features(text: str | None) -> np.ndarray:
    """Sorted buckets of the character n-grams of a text.

    Case is kept; digits count as one character, so does white space. Long texts
    are read in overlapping steps.
    """
    text = text or ""
    overlap = max(NGRAMS) - 1
    found = []
    for at in range(0, len(text), _STEP):
        part = text[max(0, at - overlap):at + _STEP]
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        codes[(codes >= 48) & (codes <= 57)] = 48
        codes[codes <= 32] = 32
        for n in NGRAMS:
            if len(codes) < n:
                continue
            mixed = np.full(len(codes) - n + 1, n, np.uint64)
            for k in range(n):
                mixed = (mixed ^ codes[k:len(codes) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
            found.append((mixed >> np.uint64(64 - BITS)).astype(np.int32))
    found.append(_repetition(text))
    return np.unique(np.concatenate(found)) if text else np.empty(0, np.int32)


def _repetition(text: str) -> np.ndarray:
    """Buckets for the number, in powers of two, and the tenths of words equal to the one before."""
    repeats = words = 0
    last = None
    for match in _WORD.finditer(text):
        word = match[0]
        repeats += word == last
        words += 1
        last = word
    levels = [*range(repeats.bit_length()), *range(100, 100 + 10 * repeats // max(words, 1))]
    mixed = (np.array(levels, np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(64 - BITS)).astype(np.int32)


@dataclass(frozen=True)
class Model:
    """margin = sum(weight) / sqrt(sum(square)) + bias over a text's buckets; score = logistic."""

    weight: np.ndarray
    square: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, text: str | None) -> float:
        at = features(text)
        length = float(np.sqrt(self.square[at].sum()))
        margin = float(self.weight[at].sum()) / length + self.bias if length else self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500))))


def _constant(good: int, total: int) -> Model:
    """The model of one class only: the smoothed share of good rows for every text."""
    nothing = np.zeros(BUCKETS, np.float32)
    return Model(nothing, nothing, 0.0, 0.0, float(np.log((good + 1) / (total - good + 1))))


def _descend(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, cost: float, epochs: int) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss; rows are (buckets, values) of unit length."""
    weight, bias = np.zeros(BUCKETS), 0.0
    dual = np.zeros(len(rows))
    order = np.random.default_rng(0)
    curve = np.array([float(v @ v) + 1 for _, v in rows])
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, values = rows[i]
            gradient = signs[i] * (weight[at] @ values + bias) - 1
            moved = min(max(dual[i] - gradient / curve[i], 0.0), cost)
            if moved != dual[i]:
                step = (moved - dual[i]) * signs[i]
                dual[i] = moved
                weight[at] += step * values
                bias += step
    return weight, bias


def _logistic(margins: np.ndarray, good: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of the logistic curve with the least log-loss, lightly regularised."""
    a = np.array([1.0, 0.0])
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        gradient = x.T @ (p - good) + 1e-3 * a
        curvature = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curvature, gradient)
        a = a - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(a[0]), float(a[1])


def fit(rows: list[np.ndarray], good: np.ndarray, cost: float = 1.0, epochs: int = 10) -> Model:
    """A model from bucket arrays and their 0/1 labels."""
    if not len(good) or good.min() == good.max():
        return _constant(int(good.sum()), len(good))
    aside = np.arange(len(rows)) % _CALIBRATION == 0
    if len(set(good[~aside])) < 2 or len(set(good[aside])) < 2:
        aside[:] = False
    counts = np.ones((2, BUCKETS))
    for i in np.flatnonzero(~aside):
        counts[int(good[i]), rows[i]] += 1
    share = counts / counts.sum(axis=1, keepdims=True)
    ratio = np.log(share[1] / share[0])
    unit = []
    for at in rows:
        values = ratio[at]
        unit.append((at, values / max(float(np.linalg.norm(values)), 1e-12)))
    used = np.flatnonzero(~aside)
    weight, bias = _descend([unit[i] for i in used], np.where(good[used] == 1, 1.0, -1.0), cost, epochs)
    judged = np.flatnonzero(aside) if aside.any() else used
    margins = np.array([weight[unit[i][0]] @ unit[i][1] + bias for i in judged])
    slope, shift = _logistic(margins, good[judged].astype(float))
    return Model((weight * ratio).astype(np.float32), (ratio * ratio).astype(np.float32), bias, slope, shift)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE,
          id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from the labelled documents that may be learned from.

    Labels other than 0 and 1, NULL labels and NULL ids are ignored; a row labelled
    twice counts twice. The sample's ids are broadcast (about ``sample`` rows), so
    no text is shuffled; its buckets come to the driver ordered by id.
    """
    usable = labels.select(
        F.col(id_col).alias("labelled_id"), F.col(label_col).cast("int").alias("good"),
    ).where(F.col("good").isin(0, 1) & F.col("labelled_id").isNotNull()).where(~held_out("labelled_id"))
    share = min(1.0, sample / max(1, usable.count()))
    if share < 1:
        usable = usable.where(F.pmod(F.xxhash64("labelled_id"), F.lit(1 << 31)) < int(share * (1 << 31)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_record(batches, 128):
            found = [features(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.string()), pa.array(found, pa.binary()), batch.column(2)],
                names=["id", "buckets", "good"])

    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(
        F.broadcast(usable), F.col("doc_id") == F.col("labelled_id")).select("doc_id", "text", "good")
    rows = sorted(chosen.mapInArrow(run, "id string, buckets binary, good int").toLocalIterator(),
                  key=lambda r: (r["id"], bytes(r["buckets"]), r["good"]))
    return fit([np.frombuffer(r["buckets"], np.int32) for r in rows], np.array([r["good"] for r in rows], int))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row; NULL and empty texts have the score of a text without n-grams.

    Repeated rows and NULL ids are scored like others; other columns are ignored.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_record(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([model.score(t.as_py()) for t in batch.column(1)], pa.float64())],
                names=["doc_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double")
