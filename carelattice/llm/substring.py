"""Removal of long word sequences that an earlier document already has.

First pass: every window of 50 words is counted under the smallest hash of the
10-word sequences inside it, which equal windows share and neighbouring windows
mostly have in common. Each partition's count-min sketch of these keys (a sparse
one: grouped before the shuffle) is merged with the others'. A window's estimate,
the smallest of its cells, is never below the number of documents that have it.

Second pass: only windows estimated to be in two documents or more are written out,
under a 128-bit hash, and grouped exactly for the smallest document id.

Whole copies are recognised by a hash of all their words before, so a group of
copies counts once. The texts that have repeated windows are found again by a
bitmap of fixed size, which spares the others the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelattice.llm.common import by_record, written

WINDOW = 50
GRAM = 10
# The sketch: rows, and bits of a cell's number. It is sparse, so width costs nothing.
ROWS = 2
WIDTH_BITS = 40
# Distinct words remembered per worker, and windows handled at once.
_WORDS = 1_000_000
_STEP = 1 << 19
# Bits of the bitmap of documents: 512 pieces of 4 KB.
_BITMAP = 1 << 24
_PIECE = 1 << 15

_M1, _M2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _Rolling:
    """Hashes of all runs of consecutive words, from hashes of the words."""

    def __init__(self, multiplier: int) -> None:
        self.up = np.cumprod(np.full(_STEP + WINDOW, np.uint64(multiplier)))
        self.down = np.cumprod(np.full(_STEP + WINDOW, np.uint64(pow(multiplier, -1, 1 << 64))))

    def __call__(self, words: np.ndarray, size: int) -> np.ndarray:
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * self.down[:len(words)])])
        return _mix((sums[size:] - sums[:-size]) * self.up[:len(words) - size + 1])


class Hasher:
    """Word and window hashes of texts; word hashes are remembered per worker."""

    def __init__(self) -> None:
        self.rolling = _Rolling(_M1), _Rolling(_M2)
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.values = np.empty((2, 1 << 12), np.uint64)

    def words(self, words: list[bytes]) -> np.ndarray:
        """Two 64-bit hashes per word, as rows of a matrix."""
        if len(self.place) > _WORDS:
            self.clear()
        for word in set(words).difference(self.place):
            at = len(self.place)
            if at == self.values.shape[1]:
                self.values = np.concatenate([self.values, np.empty_like(self.values)], axis=1)
            digest = xxhash.xxh3_128_intdigest(word)
            self.values[0, at], self.values[1, at] = digest & 0xFFFFFFFFFFFFFFFF, digest >> 64
            self.place[word] = at
        return self.values[:, np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))]

    def steps(self, words: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first window, word hashes, window keys) for up to ``_STEP`` windows at a time."""
        for at in range(0, len(words) - WINDOW + 1, _STEP):
            hashes = self.words(words[at:at + _STEP + WINDOW - 1])
            grams = self.rolling[0](hashes[0], GRAM)
            yield at, hashes, _sliding_minimum(grams, WINDOW - GRAM + 1)

    def windows(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.rolling[0](hashes[0], WINDOW), self.rolling[1](hashes[1], WINDOW)


def _sliding_minimum(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every ``size`` consecutive values, by doubling the reach."""
    reach = 1
    while 2 * reach <= size:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = size - reach
    return np.minimum(values[:-rest], values[rest:]) if rest else values


_hasher: Hasher | None = None


def hasher() -> Hasher:
    global _hasher
    if _hasher is None:
        _hasher = Hasher()
    return _hasher


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of anything but ASCII white space."""
    return text.split() if text else []


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))


def _profile(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_record(batches):
        sizes, wholes, digests, keys = [], [], [], []
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            words = words_of(text)
            joined = b" ".join(words)
            sizes.append(len(words))
            wholes.append(xxhash.xxh3_128_digest(joined))
            digests.append(hashlib.sha256(joined).hexdigest())
            found = [np.unique(k) for _, _, k in hasher().steps(words)]
            keys.append(_signed(np.unique(np.concatenate(found))) if found else np.empty(0, np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()),
             pa.array(wholes, pa.binary()), pa.array(digests, pa.string()), _lists(keys)],
            names=["doc_id", "text_key", "n_words", "whole", "sha256", "keys"])


def _windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct windows of each text whose key is in its list of keys."""
    for batch in by_record(batches, 64):
        rows, firsts, seconds = [], [], []
        lists = batch.column("keys")
        for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
            wanted = np.sort(lists[i].values.to_numpy())
            for _, hashes, keys in hasher().steps(words_of(text)):
                at = np.flatnonzero(np.isin(_signed(keys), wanted))
                if len(at):
                    one, two = hasher().windows(hashes)
                    _, first = np.unique(one[at], return_index=True)
                    rows.append(np.full(len(first), i))
                    firsts.append(_signed(one[at[first]]))
                    seconds.append(_signed(two[at[first]]))
        if rows:
            row = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(row), batch.column("text_key").take(row),
                 pa.array(np.concatenate(firsts)), pa.array(np.concatenate(seconds))],
                names=["doc_id", "text_key", "h1", "h2"])


def _covered(words: list[bytes], repeated: np.ndarray) -> np.ndarray:
    """Which words lie in a window whose hash is among ``repeated``."""
    change = np.zeros(len(words) + 1, np.int64)
    repeated = np.sort(repeated)
    for at, hashes, _ in hasher().steps(words):
        starts = at + np.flatnonzero(np.isin(_signed(hasher().windows(hashes)[0]), repeated))
        np.add.at(change, starts, 1)
        np.add.at(change, starts + WINDOW, -1)
    return np.cumsum(change[:-1]) > 0


def _remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_record(batches, 64):
        removed, digests, spans = [], [], []
        lists = batch.column("repeated")
        for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
            words = words_of(text)
            gone = _covered(words, lists[i].values.to_numpy())
            edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            digest, last = hashlib.sha256(), 0
            kept = [w for w, out in zip(words, gone.tolist()) if not out]
            digest.update(b" ".join(kept))
            removed.append(int(gone.sum()))
            digests.append(digest.hexdigest())
            spans.append([{"first": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(removed, pa.int64()),
             pa.array(digests, pa.string()),
             pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))],
            names=["doc_id", "text_key", "n_removed", "kept_sha256", "spans"])


def _cells(key: str) -> list[Column]:
    """The cells of a key, one per row of the sketch."""
    mask = (1 << WIDTH_BITS) - 1
    return [F.xxhash64(F.col(key), F.lit(row)).bitwiseAND(F.lit(mask)).bitwiseOR(F.lit(row << WIDTH_BITS))
            for row in range(ROWS)]


def repeated_keys(keys: DataFrame) -> DataFrame:
    """Rows of ``keys`` (one ``key`` per document) that the merged sketch counts twice or more."""
    sketch = keys.select(F.explode(F.array(*_cells("key"))).alias("cell")).groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"))
    hot = written(sketch.where("n > 1").select("cell"), "sketch")
    for cell in _cells("key"):
        keys = keys.withColumn("cell", cell).join(hot, "cell", "left_semi").drop("cell")
    return keys


def _texts_of(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """Rows of ``docs`` joined with their row of ``lists`` by doc_id and text_key.

    Rows without one are mostly dropped before the shuffle, by a bitmap of fixed
    size; when it is full, all are shuffled and the result is the same.
    """
    place = F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(_BITMAP))
    pieces = lists.select(place.alias("place")).groupBy((F.col("place") / _PIECE).cast("int").alias("piece")).agg(
        F.bitmap_construct_agg(F.pmod("place", F.lit(_PIECE))).alias("bits"))
    bit = F.pmod("place", F.lit(_PIECE))
    byte = F.conv(F.hex(F.substring("bits", (bit / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    likely = (
        docs.withColumn("place", place).withColumn("piece", (F.col("place") / _PIECE).cast("int"))
        .join(F.broadcast(pieces), "piece")
        .where(F.call_function("getbit", byte, (bit % 8).cast("int")) == 1)
        .select("doc_id", "text_key", "text")
    )
    return likely.join(lists, ["doc_id", "text_key"])


def repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, n_words, n_removed, kept_sha256, spans) of every row.

    ``spans`` lists the runs of words to remove as (first, end): those covered by a
    window that also starts in a row with a smaller id. Windows are judged on the
    input. ``kept_sha256`` is the digest of the other words, joined by one space.
    NULL and empty texts have no words. A row with a NULL id neither loses words nor
    makes others lose them. Rows sharing an id do not remove each other's words;
    equal rows get equal results. Other columns are ignored; an empty table gives
    no row.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_key"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    profiles = written(texts.mapInArrow(
        _profile, f"doc_id {kind}, text_key bigint, n_words bigint, whole binary, sha256 string, keys array<bigint>"),
        "profiles")
    named = profiles.where("doc_id is not null")
    # Joined by text and id together, which spreads a crowd of copies.
    first = named.groupBy("whole").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    known = written(named.where(F.col("n_words") >= WINDOW).join(first, ["whole", "doc_id"], "left").select(
        "doc_id", "text_key", F.coalesce("is_first", F.lit(False)).alias("is_first"), "keys"), "originals")
    originals = known.where("is_first").select("doc_id", "text_key", "keys").dropDuplicates(["doc_id", "text_key"])
    keys = originals.select("doc_id", "text_key", F.explode("keys").alias("key"))
    lists = written(repeated_keys(keys).groupBy("doc_id", "text_key").agg(F.collect_list("key").alias("keys")), "keys")

    windows = _texts_of(texts.where("doc_id is not null"), lists).select("doc_id", "text_key", "text", "keys").mapInArrow(
        _windows, f"doc_id {kind}, text_key bigint, h1 bigint, h2 bigint")
    least = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"))
    repeated = written(
        windows.join(least, ["h1", "h2"]).where(F.col("doc_id") > F.col("least"))
        .groupBy("doc_id", "text_key").agg(F.collect_set("h1").alias("repeated")), "repeated")
    span = "array<struct<first:bigint,end:bigint>>"
    fates = _texts_of(texts.where("doc_id is not null"), repeated).dropDuplicates(["doc_id", "text_key"]).select(
        "doc_id", "text_key", "text", "repeated").mapInArrow(
        _remove, f"doc_id {kind}, text_key bigint, n_removed bigint, kept_sha256 string, spans {span}")
    copies = known.where("not is_first").select("doc_id", "text_key").distinct().withColumn("copy", F.lit(True))
    copy = F.coalesce("copy", F.lit(False))
    return (
        profiles.drop("keys").join(fates, ["doc_id", "text_key"], "left").join(copies, ["doc_id", "text_key"], "left")
        .select(
            "doc_id", "text_key", "n_words",
            F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
            F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha256"))
            .alias("kept_sha256"),
            F.when(copy, F.array(F.struct(F.lit(0).cast("bigint").alias("first"), F.col("n_words").alias("end"))))
            .otherwise(F.coalesce("spans", F.array().cast(span))).alias("spans"))
    )


def without_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): the texts of ``docs`` without the word runs found by :func:`repeated_words`.

    Kept words are joined by one space. Word runs are cut in the JVM.
    """
    found = spans.select("doc_id", "text_key", "spans").dropDuplicates(["doc_id", "text_key"])
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_key"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    words = F.array_remove(F.split("text", "[\\x20\\x09-\\x0D]+"), "")
    kept = F.filter("words", lambda w, i: ~F.exists("spans", lambda s: (s["first"] <= i) & (i < s["end"])))
    joined = texts.join(found, texts.doc_id.eqNullSafe(found.doc_id) & (texts.text_key == found.text_key)).select(
        texts.doc_id, words.alias("words"), "spans")
    return joined.select("doc_id", F.array_join(kept, " ").alias("text"))
