"""SimHash near-duplicate classes by meet-in-the-middle ball hashing.

Two fingerprints at most ``2 r`` bits apart have a common variant: flip half of
the differing bits on each side. So every distinct fingerprint emits all its
variants with up to ``r`` flipped bits, variants are brought together by a
shuffle, and fingerprints meeting in a variant are verified and linked.

The shuffle does not carry each of the 2,081 variants of a 64-bit fingerprint.
Variants that agree in their first bits go to the same key, so one message per
variant prefix suffices (211 for 20 bits), and the flips of the other bits are
made where the message arrives. Around prefixes that very many fingerprints share
(a crowd of near copies) keys are 12 bits longer. A key's messages are sorted out by
Spark; a task holds those of one key (16 bytes each) and splits them further, bit by
bit, until the variants fit a fixed buffer.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelattice.llm.common import by_record, written
from carelattice.llm.components import connected_components, join_spread

SEED = 42
# Variants expanded at once in a task, and messages gathered before they are.
_VARIANTS = 1_000_000
_MESSAGES = 50_000
# A prefix with more distinct fingerprints than this gets longer keys, by so many bits.
CROWD = 100_000
_MORE_BITS = 12


def text_fingerprint(text: str | None, shingle: int = 4) -> int:
    """64-bit SimHash of the word shingles of ``text``, every repetition counted.

    Words are runs of anything but ASCII white space, A-Z lower-cased. Fewer words
    than a shingle: the whole sequence is the only one. No word, or NULL: zero.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    last = ends[shingle - 1:].tolist() or [len(joined)]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(last), 65_536):
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts[at:at + 65_536], last[at:at + 65_536])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(last), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 4, text_key: bool = False) -> DataFrame:
    """(id, fingerprint long) of every row; the long holds the 64 bits.

    With ``text_key`` a column of that name tells apart rows that share an id.
    """
    keys = [F.xxhash64(F.col(text_col).cast("string")).alias("text_key")] if text_key else []

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_record(batches):
            values = np.array([text_fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values.view(np.int64)), *batch.columns[2:]],
                names=["id", "fingerprint", *batch.schema.names[2:]])

    kind = docs.schema[id_col].dataType.simpleString()
    return (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *keys)
        .mapInArrow(run, f"id {kind}, fingerprint bigint" + ", text_key bigint" * text_key)
    )


@cache
def _flips(width: int, most: int) -> tuple[np.ndarray, ...]:
    """Masks over the lowest ``width`` bits: entry ``k`` has those with up to ``k`` bits set."""
    masks, out = [0], []
    for k in range(most + 1):
        if k:
            masks += [sum(1 << i for i in bits) for bits in combinations(range(width), k)]
        out.append(np.array(masks, np.uint64))
    return tuple(out)


def _meet(own: np.ndarray, variant: np.ndarray, used: np.ndarray, depth: int, radius: int,
          limit: int) -> Iterator[np.ndarray]:
    """Links of fingerprints ``own`` that share a variant.

    ``variant`` is each fingerprint with its first ``depth`` bits set to the
    variant's, at the cost of ``used`` flips; the other bits are still open.
    """
    if len(own) < 2:
        return
    masks = _flips(64 - depth, radius)
    sizes = np.array([len(masks[radius - k]) for k in range(radius + 1)])
    if depth < 64 and sizes[used].sum() > limit:
        bit = np.uint64(1 << (63 - depth))
        for value in (np.uint64(0), bit):
            same = (variant & bit) == value
            keep = same | (used < radius)
            yield from _meet(own[keep], np.where(same, variant, variant ^ bit)[keep],
                             (used + ~same)[keep], depth + 1, radius, limit)
        return
    parts, owners = [], []
    for k in range(radius + 1):
        at = np.flatnonzero(used == k)
        flips = masks[radius - k]
        parts.append((variant[at, None] ^ flips[None, :]).ravel())
        owners.append(np.repeat(at, len(flips)))
    variants, owner = np.concatenate(parts), np.concatenate(owners)
    order = np.argsort(variants)
    variants = variants[order]
    equal = variants[1:] == variants[:-1]
    if not equal.any():
        return
    # One star per variant: everyone who meets there is linked to the first.
    head = np.flatnonzero(np.concatenate([[True], ~equal]))
    group = np.cumsum(np.concatenate([[True], ~equal])) - 1
    others = np.flatnonzero(np.concatenate([[False], equal]))
    a, b = own[owner[order[others]]], own[owner[order[head[group[others]]]]]
    pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1), axis=0)
    yield pairs[(pairs[:, 0] != pairs[:, 1])
                & (np.bitwise_count(pairs[:, 0] ^ pairs[:, 1]) <= 2 * radius)]


def _variants_of(masks: np.ndarray) -> F.Column:
    return F.array(*[F.lit(int(m)).cast("bigint") for m in masks])


def _messages(prints: DataFrame, radius: int, prefix_bits: int, crowd: int) -> DataFrame:
    """(key, more, fingerprint): every fingerprint once per prefix of its variants.

    ``more`` holds the bits after the prefix for keys around a crowded prefix, else -1.
    There the message is repeated for the variants of these bits, as far as flips are left.
    """
    shift = 64 - prefix_bits
    prefix = F.shiftrightunsigned("fingerprint", shift)
    flips = _variants_of(_flips(prefix_bits, radius)[radius])
    crowded = prints.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd)
    around = written(
        crowded.select(F.explode(flips).alias("flip"), "prefix")
        .select(F.col("prefix").bitwiseXOR(F.col("flip")).cast("int").alias("key")).distinct(), "crowded-keys")
    sent = prints.select(F.explode(flips).alias("flip"), "fingerprint").select(
        prefix.bitwiseXOR(F.col("flip")).cast("int").alias("key"), F.bit_count("flip").alias("used"), "fingerprint")
    own = F.shiftrightunsigned("fingerprint", shift - _MORE_BITS).bitwiseAND(F.lit((1 << _MORE_BITS) - 1))
    left = F.lit(radius) - F.col("used")
    masks = _flips(_MORE_BITS, radius)
    longer = F.coalesce(*[F.when(left == k, _variants_of(masks[k])) for k in range(radius + 1)])
    spread = F.transform(longer, lambda m: own.bitwiseXOR(m).cast("int"))
    return sent.join(around.withColumn("is_crowded", F.lit(True)), "key", "left").select(
        "key", F.explode(F.when(F.col("is_crowded"), spread).otherwise(F.array(F.lit(-1)))).alias("more"), "fingerprint")


def ball_links(prints: DataFrame, max_bits: int = 4, prefix_bits: int = 20, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints at most ``max_bits`` apart.

    ``prints`` has one column ``fingerprint`` of distinct longs. Per variant all
    members are linked to one of them, not to each other: members of a variant are
    pairwise within ``max_bits``, so the links connect exactly what the pairs would.
    An odd ``max_bits`` uses the next larger ball, and links are verified.
    """
    radius = (max_bits + 1) // 2

    def links(key: np.ndarray, more: np.ndarray, own: np.ndarray) -> Iterator[pa.RecordBatch]:
        for longer in (False, True):
            here = (more >= 0) == longer
            depth = prefix_bits + _MORE_BITS * longer
            low = np.uint64(64 - depth)
            head = key[here].astype(np.uint64)
            if longer:
                head = (head << np.uint64(_MORE_BITS)) | more[here].astype(np.uint64)
            mine = own[here]
            used = np.bitwise_count((mine >> low) ^ head).astype(np.int64)
            variant = (head << low) | (mine & np.uint64((1 << (64 - depth)) - 1))
            for pairs in _meet(mine, variant, used, depth, radius, _VARIANTS):
                pairs = pairs[np.bitwise_count(pairs[:, 0] ^ pairs[:, 1]) <= max_bits]
                if len(pairs):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.ascontiguousarray(pairs[:, i]).view(np.int64)) for i in (0, 1)], names=["a", "b"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        waiting, last = 0, None
        for batch in batches:
            columns = [batch.column(i).to_numpy() for i in range(2)] + [batch.column(2).to_numpy().view(np.uint64)]
            place = (columns[0].astype(np.int64) << 32) + columns[1]
            # Keys are complete up to the place where the batch's last key begins.
            cut = int(np.searchsorted(place, place[-1]))
            if waiting + cut >= _MESSAGES and (cut or place[0] != last):
                held.append(tuple(c[:cut] for c in columns))
                yield from links(*[np.concatenate(c) for c in zip(*held)])
                held, waiting, columns = [], 0, [c[cut:] for c in columns]
            held.append(tuple(columns))
            waiting += len(columns[0])
            last = place[-1]
        if held:
            yield from links(*[np.concatenate(c) for c in zip(*held)])

    return (
        _messages(prints, radius, prefix_bits, crowd)
        .repartition("key", "more").sortWithinPartitions("key", "more").mapInArrow(run, "a bigint, b bigint")
    )


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 4, max_bits: int = 4, prefix_bits: int = 20) -> DataFrame:
    """(id, fingerprint, component_id) of every row of ``docs``.

    Rows with equal fingerprints, and fingerprints at most ``max_bits`` apart, are
    linked; component_id is the smallest id reachable, itself included. NULL and
    blank texts have fingerprint zero and are linked like any other. Rows with a
    NULL id belong to their class but are not counted for its smallest id.
    Repeated rows stay repeated; other columns are ignored; an empty table gives
    an empty result.
    """
    prints = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    least = written(prints.groupBy("fingerprint").agg(F.min("id").alias("least")), "distinct-prints")
    roots = connected_components(ball_links(least.select("fingerprint"), max_bits, prefix_bits))
    # The smallest id is sought over the fingerprints that have links; others keep their own.
    linked = roots.join(least, roots.node == least.fingerprint).select("fingerprint", "root", "least")
    smallest = linked.groupBy("root").agg(F.min("least").alias("smallest"))
    smallest = join_spread(linked, smallest, "root", "fingerprint").select("fingerprint", "smallest")
    # Written, so that the last join stands alone and a crowd of copies can be split in it.
    labels = written(least.join(smallest, "fingerprint", "left").select(
        "fingerprint", F.coalesce("smallest", "least").alias("component_id")), "labels")
    return prints.join(labels, "fingerprint").select("id", "fingerprint", "component_id")


def class_leaders(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shingle: int = 4, max_bits: int = 4, prefix_bits: int = 20) -> DataFrame:
    """(id, text_key) of one row of every class of ``simhash_classes``.

    It is the row with the smallest (id, text_key), NULL ids last. A class is known by
    its fingerprints here, as two classes may have the same smallest id, or none.
    """
    row = F.struct(F.col("id").isNull().alias("unnamed"), "id", "text_key")
    least = written(fingerprints(docs, id_col, text_col, shingle, text_key=True).groupBy("fingerprint").agg(
        F.min(row).alias("least")), "distinct-prints")
    roots = connected_components(ball_links(least.select("fingerprint"), max_bits, prefix_bits))
    linked = roots.join(least, roots.node == least.fingerprint).groupBy("root").agg(F.min("least").alias("least"))
    alone = least.join(roots, least.fingerprint == roots.node, "left_anti")
    return linked.select("least.id", "least.text_key").unionByName(alone.select("least.id", "least.text_key"))
