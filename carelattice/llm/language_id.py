"""Language identification with hyperdimensional profiles.

Every letter owns a random vector of +1 and -1. A letter trigram is the product
of its letters' vectors, each rotated by its place; a text is the sum of its
trigrams, a language the sum of its training texts. A text belongs to the
language whose sum has the largest cosine with its own.

Training sums are made per task and merged by a grouped sum of ``dims`` numbers
per language, which is all that reaches the driver and the prediction tasks.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelattice.llm.common import by_record, held_out

DIMS = 1024
UNDECIDED = "und"
# Trigram vectors kept per worker, trigrams handled at once, and code points per step.
_KEPT = 32_768
_AT_ONCE = 8_192
_STEP = 1 << 20


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


@cache
def _letter_vector(code: int, dims: int) -> np.ndarray:
    return np.random.default_rng(code).choice(np.array([-1, 1], np.int8), dims)


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct letter trigrams of a text and their counts.

    Everything but letters is one gap (code 0), also before and after the text.
    Three code points of 21 bits make a trigram. Long texts are read in steps.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    letters = _letters()
    tail = np.zeros(1, np.uint64)
    text = text or ""
    any_letter = False
    for at in range(0, len(text), _STEP):
        codes = np.frombuffer(text[at:at + _STEP].lower().encode("utf-32-le", "surrogatepass"), "<u4")
        codes = np.where(letters[codes], codes, 0).astype(np.uint64)
        any_letter = any_letter or bool(codes.any())
        if at + _STEP >= len(text):
            codes = np.append(codes, np.uint64(0))
        codes = np.concatenate([tail, codes])
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
        codes = codes[keep]
        if len(codes) > 2:
            found.append(np.unique(
                codes[:-2] << np.uint64(42) | codes[1:-1] << np.uint64(21) | codes[2:], return_counts=True))
        tail = codes[-2:]
    if not any_letter:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return found[0] if len(found) == 1 else merge_counts(found)


def merge_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of several (sorted keys, counts) tables."""
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    counts = np.bincount(place, np.concatenate([c for _, c in parts]), len(keys))
    return keys, counts.astype(np.int64)


class Encoder:
    """Sums of bound trigram vectors; the vectors of recent trigrams are kept."""

    def __init__(self, dims: int) -> None:
        self.dims = dims
        self.keys = np.empty(0, np.uint64)
        self.rows = np.empty(0, np.int64)
        self.vectors = np.empty((_KEPT, dims), np.int8)

    def _bound(self, key: int) -> np.ndarray:
        first, second, third = key >> 42, key >> 21 & 0x1FFFFF, key & 0x1FFFFF
        return (np.roll(_letter_vector(first, self.dims), 2) * np.roll(_letter_vector(second, self.dims), 1)
                * _letter_vector(third, self.dims))

    def _at(self, keys: np.ndarray) -> np.ndarray:
        if len(self.keys):
            place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            missing = keys[self.keys[place] != keys]
        else:
            missing = keys
        if len(missing):
            if len(self.keys) + len(missing) > _KEPT:
                self.__init__(self.dims)
                missing = keys
            fresh = np.stack([self._bound(k) for k in missing.tolist()])
            rows = np.arange(len(missing)) + len(self.keys)
            self.vectors[rows] = fresh
            keys_now = np.concatenate([self.keys, missing])
            order = np.argsort(keys_now)
            self.keys, self.rows = keys_now[order], np.concatenate([self.rows, rows])[order]
            place = np.searchsorted(self.keys, keys)
        return self.rows[place]

    def bundle(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        total = np.zeros(self.dims)
        for at in range(0, len(keys), _AT_ONCE):
            part = slice(at, at + _AT_ONCE)
            rows = self._at(keys[part])
            total += counts[part].astype(np.float32) @ self.vectors[rows].astype(np.float32)
        return total


@cache
def encoder(dims: int) -> Encoder:
    return Encoder(dims)


def profiles(docs: DataFrame, dims: int = DIMS, text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """The summed vector of every language in ``docs``; rows with a NULL language are left out.

    ``dims`` numbers per language are collected. All rows are summed.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list] = {}
        sums: dict[str, np.ndarray] = {}

        def settle(lang: str) -> None:
            keys, counts = merge_counts(waiting.pop(lang))
            sums[lang] = sums.get(lang, 0) + encoder(dims).bundle(keys, counts)

        for batch in by_record(batches):
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                parts = waiting.setdefault(lang, [])
                parts.append(trigrams(text.as_py()))
                if len(parts) >= 256:
                    waiting[lang] = [merge_counts(parts)]
                    if len(waiting[lang][0][0]) > _KEPT:
                        settle(lang)
            if len(waiting) > 64:
                for lang in [*waiting]:
                    settle(lang)
        for lang in [*waiting]:
            settle(lang)
        for lang, vector in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * dims), pa.array(np.arange(dims, dtype=np.int32)), pa.array(vector)],
                names=["lang", "dim", "value"])

    known = docs.where(F.col(lang_col).isNotNull()).select(
        F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    summed = known.mapInArrow(run, "lang string, dim int, value double").groupBy("lang", "dim").agg(
        F.sum("value").alias("value"))
    found: dict[str, np.ndarray] = {}
    for lang, dim, value in summed.toLocalIterator():
        found.setdefault(lang, np.zeros(dims))[dim] = value
    return {lang: found[lang] for lang in sorted(found) if found[lang].any()}


def _profile_matrix(known: dict[str, np.ndarray], dims: int) -> tuple[list[str], np.ndarray]:
    names = sorted(known)
    return names, np.stack([known[n] / np.linalg.norm(known[n]) for n in names]) if names else np.zeros((0, dims))


def predict(text: str | None, names: list[str], matrix: np.ndarray) -> tuple[str, float, float]:
    """Language, its cosine (at least 0) and its lead over the next one."""
    keys, counts = trigrams(text)
    if not len(keys) or not names:
        return UNDECIDED, 0.0, 0.0
    vector = encoder(matrix.shape[1]).bundle(keys, counts)
    cosines = matrix @ vector / max(float(np.linalg.norm(vector)), 1e-12)
    best = int(np.argmax(cosines))
    return (names[best], float(np.clip(cosines[best], 0, 1)),
            float(cosines[best] - np.delete(cosines, best).max(initial=0.0)))


def classify(docs: DataFrame, known: dict[str, np.ndarray], dims: int = DIMS,
             id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, lang_pred, score, margin) of every row, and the columns of ``keep``.

    ``score`` is the cosine with the predicted language, at least 0; ``margin`` the
    lead over the next language. Texts that are NULL or have no letter, and all
    texts when no language is known, are ``und`` with score 0. Equal cosines go to
    the first language by name. Repeated rows and NULL ids are scored like others.
    """
    names, matrix = _profile_matrix(known, dims)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_record(batches):
            found = [predict(t.as_py(), names, matrix) for t in batch.column("text")]
            langs, scores, margins = zip(*found)
            kept = [c for c in batch.schema.names if c != "text" or "text" in keep]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                                                   pa.array(margins, pa.float64())],
                names=[*kept, "lang_pred", "score", "margin"])

    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"),
                         *[c for c in keep if c not in (id_col, "text")])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields
                       if f.name != "text" or "text" in keep)
    return source.mapInArrow(run, f"{fields}, lang_pred string, score double, margin double")


def identified(docs: DataFrame, known: dict[str, np.ndarray], dims: int = DIMS, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a language, that is not ``und``, and all their columns."""
    at = docs.columns.index(text_col)
    names, matrix = _profile_matrix(known, dims)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_record(batches):
            found = [predict(t.as_py(), names, matrix)[0] for t in batch.column(at)]
            yield batch.filter(pa.array([lang != UNDECIDED for lang in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents that may be learned from."""
    return docs.where(~held_out(id_col))
