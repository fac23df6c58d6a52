"""Removal of bytes covered by long strings that occur more than once anywhere.

A window of 200 bytes is anchored where the fingerprint of 48 bytes inside it is
smallest, so equal windows have their anchor at the same offset, and about 77
neighbouring windows share one. Sampled suffixes, those that start at anchors, stand
for all others:

1. Anchor fingerprints are counted. Only those met twice can lie in repeated windows.
2. Each task sorts the suffixes at its remaining anchors, and the text before them
   read backwards, into runs. Runs are cut by ranges of fingerprints, front-coded and
   exchanged, so suffixes that begin with the same 48 bytes meet in one range.
3. A range merges its runs by loser trees that never compare a known prefix again.
   A window at an offset before the anchor is repeated if another suffix shares the
   rest of the window and its reversed left side the offset: both follow from the
   common prefixes of neighbours in the two merged orders.

Exact copies of a whole text are found first: all their bytes go, and one of them
stands for the others in the sort. Anchors met very often would fill a range, so
their windows are grouped one by one, by a 128-bit hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelattice.llm.common import by_record, written
from carelattice.llm.suffix_sort import front_code, front_decode, merge

WINDOW = 200
GRAM = 48
# Windows of a text handled at once, and bytes of strings in a run.
_STEP = 1 << 20
RUN_BYTES = 8 << 20
# Suffixes a range should hold; an anchor met more often than CROWD is not sorted.
RANGE = 20_000
CROWD = 20_000
# Parts over which the rows of one text are dealt in a join.
SPREAD = 16
# Bits of the bitmap that tells texts with work to do from others: 512 pieces of 4 KB.
_BITMAP = 1 << 24
_PIECE = 1 << 15

_M1, _M2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _Fingerprints:
    """64-bit fingerprints of all substrings of one size."""

    def __init__(self, seed: int, multiplier: int) -> None:
        self.bytes = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(seed))
        self.multiplier = multiplier
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, data: np.ndarray, size: int) -> np.ndarray:
        if len(data) > len(self.down):
            room = 1 << int(len(data) - 1).bit_length()
            self.up = np.cumprod(np.full(room, np.uint64(self.multiplier)))
            self.down = np.cumprod(np.full(room, np.uint64(pow(self.multiplier, -1, 1 << 64))))
        sums = np.empty(len(data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(self.bytes[data] * self.down[:len(data)], out=sums[1:])
        return _mix((sums[size:] - sums[:-size]) * self.up[:len(data) - size + 1])


_fingerprints: list[_Fingerprints] = []


def _hashers() -> list[_Fingerprints]:
    if not _fingerprints:
        _fingerprints.extend([_Fingerprints(3, _M1), _Fingerprints(5, _M2)])
    return _fingerprints


def _sliding_minimum(values: np.ndarray, size: int) -> np.ndarray:
    reach = 1
    while 2 * reach <= size:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = size - reach
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def anchors(text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(place, first window, last window, fingerprint) of a text's anchors, in blocks.

    A window is anchored at the first of its smallest fingerprints. Windows of a block
    border may give an anchor two entries, one per block.
    """
    span = WINDOW - GRAM + 1
    data = np.frombuffer(text, np.uint8)
    for at in range(0, len(data) - WINDOW + 1, _STEP):
        grams = _hashers()[0](data[at:at + _STEP + WINDOW - 1], GRAM)
        least = _sliding_minimum(grams, span)
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        last = np.append(first[1:], len(least)) - 1
        place = np.empty(len(first), np.int64)
        for i in range(0, len(first), 1 << 13):
            part = first[i:i + (1 << 13)]
            place[i:i + len(part)] = part + np.argmax(
                grams[part[:, None] + np.arange(span)] == least[part][:, None], axis=1)
        again = np.flatnonzero(last > place)
        if len(again):
            # The same smallest fingerprint again, before the windows that have it end.
            whole = np.ones(len(first), bool)
            whole[again] = False
            rows = [(place[whole], first[whole], last[whole])]
            for i in again.tolist():
                spots = first[i] + np.flatnonzero(grams[first[i]:last[i] + span] == least[first[i]])
                starts = np.concatenate([[first[i]], spots[:-1] + 1])
                used = starts <= last[i]
                rows.append((spots[used], starts[used], np.minimum(spots, last[i])[used]))
            place, first, last = (np.concatenate(c) for c in zip(*rows))
        yield at + place, at + first, at + last, grams[place]


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def _anchor_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k1, grams, counts): the distinct anchor fingerprints of each text."""
    for batch in by_record(batches):
        keys, numbers = [], []
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            found = [(g, p) for p, _, _, g in anchors(text)]
            grams = np.concatenate([g for g, _ in found]) if found else np.empty(0, np.uint64)
            places = np.concatenate([p for _, p in found]) if found else np.empty(0, np.int64)
            if len(found) > 1:
                _, one = np.unique(places, return_index=True)
                grams = grams[one]
            unique, n = np.unique(grams, return_counts=True)
            keys.append(_signed(unique))
            numbers.append(n)
        yield pa.RecordBatch.from_arrays(
            [batch.column("k1"), _lists(keys, pa.int64()), _lists(numbers, pa.int64())], names=["k1", "grams", "counts"])


def _bounds(ranges: int) -> np.ndarray:
    """Smallest mixed fingerprint of every range."""
    return np.array([(i << 64) // ranges for i in range(ranges)], np.uint64)


_RUN_FIELDS = ("r_common", "r_length", "r_rest", "l_order", "l_common", "l_length", "l_rest", "low", "owner", "place")
_RUN_SCHEMA = "part int, " + ", ".join(f"{f} binary" for f in _RUN_FIELDS)


class _Run:
    """Suffixes gathered by a task until they are sorted, cut and coded."""

    def __init__(self, ranges: int) -> None:
        self.bounds = _bounds(ranges)
        self.clear()

    def clear(self) -> None:
        self.size = 0
        # (fingerprint, right side, reversed left side) -> smallest offset, owners and places.
        self.held: dict[tuple[int, bytes, bytes], tuple[int, list]] = {}

    def add(self, text: bytes, owner: bytes, place: int, first: int, last: int, gram: int) -> None:
        right, left = text[place:last + WINDOW], text[first:place][::-1]
        key = (gram, right, left)
        known = self.held.get(key)
        if known is None:
            self.held[key] = known = (place - last, [])
            self.size += len(right) + len(left) + 200
        known[1].append((owner, place))
        self.size += 100

    def pieces(self) -> Iterator[dict]:
        """One piece per range that has suffixes, sorted by fingerprint and right side."""
        keys = sorted(self.held)
        part = np.searchsorted(self.bounds, np.array([k[0] for k in keys], np.uint64), side="right") - 1
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(keys)]]).tolist()
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            mine = keys[a:b]
            rights = [k[0].to_bytes(8, "big") + k[1] for k in mine]
            order = sorted(range(len(mine)), key=[k[2] for k in mine].__getitem__)
            r = front_code(rights)
            left = front_code([mine[i][2] for i in order])
            low = np.array([self.held[k][0] for k in mine], np.int32)
            owners = [o for k in mine for o, _ in self.held[k][1]]
            places = np.array([(i, p) for i, k in enumerate(mine) for _, p in self.held[k][1]], np.int64)
            yield {"part": int(part[a]), "r_common": r[0].tobytes(), "r_length": r[1].tobytes(), "r_rest": r[2],
                   "l_order": np.array(order, np.int32).tobytes(), "l_common": left[0].tobytes(),
                   "l_length": left[1].tobytes(), "l_rest": left[2], "low": low.tobytes(),
                   "owner": b"".join(owners), "place": places.tobytes()}
        self.clear()


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r["part"] for r in rows], pa.int32()), *[pa.array([r[f] for r in rows], pa.binary()) for f in _RUN_FIELDS]],
        names=["part", *_RUN_FIELDS])


def sorted_runs(texts: DataFrame, ranges: int, run_bytes: int) -> DataFrame:
    """Front-coded sorted runs of the suffixes of ``texts`` (key, text, grams), cut into ranges.

    ``grams`` are the anchor fingerprints to take. Equal suffixes of a run are one string.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Run(ranges)
        for batch in by_record(batches, 64):
            lists = batch.column("grams")
            owners = batch.column("key").to_pylist()
            for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                wanted = lists[i].values.to_numpy()
                for place, first, last, gram in anchors(text):
                    at = np.flatnonzero(np.isin(_signed(gram), wanted))
                    # Smallest fingerprints crowd near zero; mixed again, one to one, they fill all ranges.
                    for p, f, e, g in zip(place[at].tolist(), first[at].tolist(), last[at].tolist(), _mix(gram[at]).tolist()):
                        held.add(text, owners[i], p, f, e, g)
                        if held.size > run_bytes:
                            yield _batch(list(held.pieces()))
        rows = list(held.pieces())
        if rows:
            yield _batch(rows)

    return texts.select("key", "text", "grams").mapInArrow(run, _RUN_SCHEMA)


def repeated_offsets(right: tuple[np.ndarray, np.ndarray], left: tuple[np.ndarray, np.ndarray], low: np.ndarray,
                     high: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest offset at which each suffix starts a repeated window, or (1, 0).

    ``right`` and ``left`` are merged (order, common prefix) of the same suffixes.
    ``low`` and ``high`` are the offsets whose windows a suffix anchors; ``many`` marks
    suffixes that stand for several places.
    """
    order, common = right
    smallest, largest = np.where(many, low, 1), np.where(many, high, 0)
    seen = many.copy()
    left_rank = np.empty(len(low), np.int64)
    left_rank[left[0]] = np.arange(len(low))
    low, high = low[order], high[order]
    for offset in range(int(low.min()), int(high.max()) + 1) if len(low) else ():
        active = np.flatnonzero((low <= offset) & (offset <= high))
        if len(active) < 2:
            continue
        # Eight bytes of fingerprint stand before the right side.
        one = np.cumsum(common < 8 + WINDOW - offset)[active]
        twin = np.concatenate([[False], one[1:] == one[:-1]])
        twin[:-1] |= twin[1:]
        active, one = active[twin], one[twin]
        both = one * (len(low) + 1) + np.cumsum(left[1] < offset)[left_rank[order[active]]]
        by = np.argsort(both, kind="stable")
        same = both[by][1:] == both[by][:-1]
        hit = np.zeros(len(active), bool)
        hit[by[1:][same]] = hit[by[:-1][same]] = True
        found = order[active[hit]]
        found = found[~many[found]]
        smallest[found] = np.where(seen[found], smallest[found], offset)
        largest[found] = offset
        seen[found] = True
    return smallest, largest


def _merged(pieces: pd.DataFrame) -> pd.DataFrame:
    """The repeated stretches (key, start, stop) of one range."""
    rights, lefts, back, lows, highs, places = [], [], [], [], [], []
    owners: list[bytes] = []
    base = 0
    for p in pieces.itertuples():
        common, length = np.frombuffer(p.r_common, np.int32), np.frombuffer(p.r_length, np.int32)
        rights.append((front_decode(common, length, p.r_rest), common))
        common, length = np.frombuffer(p.l_common, np.int32), np.frombuffer(p.l_length, np.int32)
        lefts.append((front_decode(common, length, p.l_rest), common))
        order = np.frombuffer(p.l_order, np.int32).astype(np.int64)
        high = np.empty(len(order), np.int64)
        high[order] = common + length
        back.append(base + order)
        lows.append(np.frombuffer(p.low, np.int32).astype(np.int64))
        highs.append(high)
        owners += [p.owner[i:i + 16] for i in range(0, len(p.owner), 16)]
        places.append(np.frombuffer(p.place, np.int64).reshape(-1, 2) + np.array([base, 0]))
        base += len(order)
    low, high, place = np.concatenate(lows), np.concatenate(highs), np.concatenate(places)
    member = place[:, 0]
    many = np.bincount(member, minlength=base) > 1
    order, common = merge(lefts)
    smallest, largest = repeated_offsets(merge(rights), (np.concatenate(back)[order], common), low, high, many)
    hit = np.flatnonzero((smallest <= largest)[member])
    start = place[hit, 1] - largest[member[hit]]
    stop = place[hit, 1] - smallest[member[hit]] + WINDOW
    return pd.DataFrame({"key": [owners[i] for i in hit.tolist()], "start": start, "stop": stop})


def _crowded_windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, start, h1, h2) of every window anchored at a crowded fingerprint."""
    for batch in by_record(batches, 64):
        lists, owners = batch.column("grams"), batch.column("key")
        for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
            wanted = lists[i].values.to_numpy()
            data = np.frombuffer(text, np.uint8)
            for _, first, last, gram in anchors(text):
                at = np.flatnonzero(np.isin(_signed(gram), wanted))
                if not len(at):
                    continue
                begin = int(first.min())
                near = data[begin:int(last.max()) + WINDOW]
                one, two = (h(near, WINDOW) for h in _hashers())
                starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(first[at].tolist(), last[at].tolist())])
                for s in range(0, len(starts), 1 << 16):
                    part = starts[s:s + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [owners.take(pa.array(np.full(len(part), i))), pa.array(part),
                         pa.array(_signed(one[part - begin])), pa.array(_signed(two[part - begin]))],
                        names=["key", "start", "h1", "h2"])


def _first_half(key: str) -> Column:
    """Eight bytes of a key as a number."""
    return F.conv(F.hex(F.substring(key, 1, 8)), 16, -10).cast("bigint")


def _flagged(df: DataFrame, few: DataFrame, name: str) -> DataFrame:
    """``df`` with a column that is true where ``k1`` is in ``few``, and seldom elsewhere.

    Told by a bitmap of fixed size. When it is full all rows are flagged.
    """
    spot = F.pmod(F.xxhash64("k1"), F.lit(_BITMAP))
    bit = F.pmod("spot", F.lit(_PIECE))
    pieces = few.select(spot.alias("spot")).groupBy((F.col("spot") / _PIECE).cast("int").alias("piece")).agg(
        F.bitmap_construct_agg(bit).alias("bits"))
    byte = F.conv(F.hex(F.substring("bits", (bit / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    flag = F.coalesce(F.call_function("getbit", byte, (bit % 8).cast("int")) == 1, F.lit(False))
    return (
        df.withColumn("spot", spot).withColumn("piece", (F.col("spot") / _PIECE).cast("int"))
        .join(F.broadcast(pieces), "piece", "left").withColumn(name, flag).drop("spot", "piece", "bits")
    )


def _remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_record(batches, 64):
        removed, digests, spans = [], [], []
        lists = batch.column("stretches")
        for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
            stretches = lists[i].values
            edges: list[list[int]] = []
            for a, b in sorted(zip(stretches.field("start").to_pylist(), stretches.field("stop").to_pylist())):
                if edges and a <= edges[-1][1]:
                    edges[-1][1] = max(edges[-1][1], b)
                else:
                    edges.append([a, b])
            digest, last = hashlib.sha256(), 0
            for a, b in edges:
                digest.update(memoryview(text)[last:a])
                last = b
            digest.update(memoryview(text)[last:])
            removed.append(sum(b - a for a, b in edges))
            digests.append(digest.hexdigest())
            spans.append([{"first": a, "end": b} for a, b in edges])
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(removed, pa.int64()), pa.array(digests, pa.string()),
             pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))],
            names=["key", "n_removed", "kept_sha256", "spans"])


def repeated_stretches(texts: DataFrame, copies: DataFrame) -> DataFrame:
    """(k1, key, stretches): where the repeated windows of distinct texts lie.

    ``texts`` is (k1, key, text), texts of 200 bytes or more; rows whose key is in
    ``copies`` (k1, key) occur several times, and one of them is sorted for all.
    """
    counted = written(texts.select("k1", "text").mapInArrow(
        _anchor_counts, "k1 bigint, grams array<bigint>, counts array<bigint>"), "anchors")
    each = counted.select("k1", F.explode(F.arrays_zip("grams", "counts")).alias("g")).select(
        "k1", F.col("g.grams").alias("gram"), F.col("g.counts").alias("n"))
    # Two texts, or two places of one text; copies of a text are one.
    hot = written(
        each.groupBy("gram").agg(F.min("k1").alias("a"), F.max("k1").alias("b"), F.max("n").alias("most"),
                                 F.sum("n").alias("n"))
        .where("a <> b or most > 1").select("gram", "n"), "hot")
    wanted = written(each.select("k1", "gram").join(hot, "gram").groupBy("k1").agg(
        F.collect_set(F.when(F.col("n") <= CROWD, F.col("gram"))).alias("grams"),
        F.collect_set(F.when(F.col("n") > CROWD, F.col("gram"))).alias("crowded")), "wanted")
    suffixes, crowds = hot.agg(F.sum(F.when(F.col("n") <= CROWD, F.col("n"))), F.max(F.col("n") > CROWD)).first()

    likely = _flagged(_flagged(texts, wanted, "is_wanted").where("is_wanted"), copies, "is_copy")
    one = likely.where("is_copy").groupBy("k1", "key").agg(F.any_value("text").alias("text"))
    chosen = likely.where("not is_copy").select("k1", "key", "text").unionByName(one).join(wanted, "k1")
    found = sorted_runs(chosen, int((suffixes or 0) // RANGE) + 1, RUN_BYTES).groupBy("part").applyInPandas(
        _merged, "key binary, start bigint, stop bigint")
    if crowds:
        windows = written(chosen.where(F.size("crowded") > 0).select("key", "text", F.col("crowded").alias("grams")).mapInArrow(
            _crowded_windows, "key binary, start bigint, h1 bigint, h2 bigint"), "windows")
        twice = windows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2")
        found = found.unionByName(windows.join(twice, ["h1", "h2"], "left_semi").select(
            "key", "start", (F.col("start") + WINDOW).alias("stop")))
    return written(
        found.groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("stretches"))
        .select(_first_half("key").alias("k1"), "key", "stretches"), "stretches")


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, kept_sha256, spans) of every row.

    ``spans`` lists the maximal runs of UTF-8 bytes to remove as (first, end): those
    covered by a string of 200 bytes that also starts at another place of the same or
    any other row. Strings are judged on the input. ``kept_sha256`` is the digest of
    the other bytes.

    NULL texts are empty; texts under 200 bytes lose nothing. Ids only name rows: NULL
    and repeated ids are rows like others, and equal rows are places of their own. Texts
    are read in blocks of 2^20 windows, so a very long text needs memory in proportion
    to its own size only. Other columns are ignored; an empty table gives no row.
    Texts are told apart by MD5, and anchors of two texts by half of it.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).select(
        "doc_id", "text", F.unhex(F.md5(F.col("text").cast("binary"))).alias("key"), F.octet_length("text").alias("n_bytes"))
    profiles = written(rows.select(
        "doc_id", "key", F.col("n_bytes").cast("bigint").alias("n_bytes"),
        F.sha2(F.col("text").cast("binary"), 256).alias("sha256")), "profiles")
    long = profiles.where(F.col("n_bytes") >= WINDOW)
    copies = written(
        long.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        .select("key", _first_half("key").alias("k1")), "copies")

    texts = rows.where(F.col("n_bytes") >= WINDOW).select(_first_half("key").alias("k1"), "key", "text")
    stretches = repeated_stretches(texts, copies).join(copies.select("key"), "key", "left_anti")
    span = "array<struct<first:bigint,end:bigint>>"
    fates = (
        _flagged(texts, stretches, "is_wanted").where("is_wanted").select("key", "text")
        .join(stretches.select("key", "stretches"), "key")
        .mapInArrow(_remove, f"key binary, n_removed bigint, kept_sha256 string, spans {span}")
    )

    # Rows of a much copied text are dealt to several tasks.
    dealt = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("dealt")
    judged = written(
        long.withColumn("dealt", F.pmod(F.xxhash64("doc_id"), F.lit(SPREAD)).cast("int"))
        .join(copies.select("key", dealt).withColumn("copied", F.lit(True)), ["key", "dealt"], "left"), "judged")
    nothing = F.array().cast(span)
    outcome = ["doc_id", "n_bytes"]
    return (
        profiles.where(F.col("n_bytes") < WINDOW).select(
            *outcome, F.lit(0).cast("bigint").alias("n_removed"), F.col("sha256").alias("kept_sha256"), nothing.alias("spans"))
        .unionByName(judged.where("copied").select(
            *outcome, F.col("n_bytes").alias("n_removed"), F.lit(hashlib.sha256().hexdigest()).alias("kept_sha256"),
            F.array(F.struct(F.lit(0).cast("bigint").alias("first"), F.col("n_bytes").alias("end"))).alias("spans")))
        .unionByName(judged.where("copied is null").join(fates, "key", "left").select(
            *outcome, F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
            F.coalesce("kept_sha256", "sha256").alias("kept_sha256"), F.coalesce("spans", nothing).alias("spans")))
    )
