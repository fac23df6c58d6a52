"""Hierarchical packing of tokenised documents into windows of several lengths.

Documents are routed by length to context tiers. A tier's window takes the
longest waiting piece of its tier that fits, gaps are filled from shorter tiers,
and only when nothing fits a waiting piece is cut. What is left at the end of a
partition goes into windows of smaller powers of two, so no window is padded.
Full windows are dealt to step groups of equal token counts.

A partition is packed on its own while it is read: there is no shuffle, waiting
pieces are bounded, and a recomputed partition gives the same windows. Window
and group numbers carry the partition number in their high bits.
"""

from __future__ import annotations

from array import array
from bisect import bisect_right, insort
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelattice.llm.common import by_record

TIERS = (512, 1024, 2048, 4096)
# Waiting pieces per partition, and tokens per step group.
WAITING = 256
GROUP_TOKENS = 32_768
_SEPARATOR = "<|endoftext|>"
# Characters that form a unit of their own after a word.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Words and encoded roots remembered per worker, and words given to the tokenizer at once.
_WORDS = 400_000
_ROOTS = 800_000
_AT_ONCE = 500


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin characters stand for themselves, other bytes follow from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_BYTE_LETTERS = _byte_letters()


class WordEncoder:
    """Token ids of texts under a tokenizer whose tokens never cross white space.

    Such a tokenizer encodes a text as the sequence of its words, so the ids of a
    word are looked up once and remembered. This tokenizer lower-cases, takes a run of
    letters as one unit and a run of marks as another, so Latin words that differ only
    in case or in the marks after them share an entry and go to its merges directly.
    Other new words are encoded together, separated by a special token.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.separator = self.tokenizer.token_to_id(_SEPARATOR)
        self.known: dict[bytes, bytes] = {}
        self.roots: dict[bytes, bytes] = {}
        self.tails: dict[str, bytes] = {"": b""}

    def _alone(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _encode_words(self, words: list[bytes]) -> Iterator[bytes]:
        """Ids of each word, many words at a time behind separators."""
        for at in range(0, len(words), _AT_ONCE):
            joined = _SEPARATOR.join([w.decode() for w in words[at:at + _AT_ONCE]])
            [found] = self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            cuts = np.flatnonzero(ids == self.separator)
            raw = ids.tobytes()
            starts = [0, *(4 * cuts + 4).tolist()]
            stops = [*(4 * cuts).tolist(), len(raw)]
            yield from [raw[s:e] for s, e in zip(starts, stops)]

    def _learn(self, words: Iterable[bytes]) -> None:
        known, roots, tails = self.known, self.roots, self.tails
        merge = self.tokenizer.model.tokenize
        others: list[bytes] = []
        for word in words:
            whole = word.decode()
            text = whole.rstrip(_MARKS)
            if max(whole) >= "\u0100" or not text.isalpha():
                others.append(word)
                continue
            tail = whole[len(text):]
            if tail not in tails:
                tails[tail] = self._alone(tail)
            text = text.lower()
            root = text.encode()
            if root not in roots:
                # One run of letters is one unit for the merges; they see bytes as characters.
                letters = text if text.isascii() else root.decode("latin-1").translate(_BYTE_LETTERS)
                roots[root] = array("I", [t.id for t in merge(letters)]).tobytes()
            known[word] = roots[root] + tails[tail]
        strange = [w for w in others if b"<|" in w or b"|>" in w]
        for word in strange:
            known[word] = self._alone(word.decode())
        plain = [w for w in others if w not in known]
        known.update(zip(plain, self._encode_words(plain)))

    def forget(self) -> None:
        """Give the memory of the remembered words back."""
        self.known, self.roots, self.tails = {}, {}, {"": b""}

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each UTF-8 text; NULL has none."""
        if len(self.known) > _WORDS:
            self.known.clear()
        if len(self.roots) > _ROOTS:
            self.roots.clear()
            self.tails = {"": b""}
        split = [t.split() if t else [] for t in texts]
        found = [list(map(self.known.get, words)) for words in split]
        gaps = [i for i, ids in enumerate(found) if None in ids]
        missing: set[bytes] = set()
        for i in gaps:
            missing.update([w for w, ids in zip(split[i], found[i]) if ids is None])
        self._learn(missing)
        known = self.known
        for i in gaps:
            found[i] = [known[w] if ids is None else ids for w, ids in zip(split[i], found[i])]
        return [b"".join(ids) for ids in found]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of one tokenizer file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


class Packer:
    """Packs a stream of documents; windows come out through ``emit(window, pieces)``.

    A piece is (length, number, row, start, ids, document length). Waiting pieces
    are kept sorted by length, ``WAITING`` at most before windows are filled.
    """

    def __init__(self, emit: Callable[[int, list[tuple]], None], tiers: tuple[int, ...],
                 waiting: int = WAITING) -> None:
        self.emit, self.tiers, self.waiting = emit, sorted(tiers), waiting
        self.pool: list[tuple] = []
        self.tokens = self.seen = 0

    def _wait(self, row: object, start: int, ids: memoryview, total: int) -> None:
        self.seen += 1
        self.tokens += len(ids) // 4
        insort(self.pool, (len(ids) // 4, self.seen, row, start, ids, total))

    def add(self, row: object, ids: bytes) -> None:
        largest, total, view = self.tiers[-1], len(ids) // 4, memoryview(ids)
        full = total - total % largest
        for start in range(0, full, largest):
            self.emit(largest, [(largest, 0, row, start, view[4 * start:4 * (start + largest)], total)])
        if total > full:
            self._wait(row, full, view[4 * full:], total)
        while len(self.pool) > self.waiting:
            window = next(t for t in self.tiers if t >= self.pool[-1][0])
            if self.tokens < window:
                break
            self._fill(window)

    def _take(self, most: int) -> tuple:
        """The longest waiting piece of at most ``most`` tokens, else a cut of the shortest."""
        at = bisect_right(self.pool, most, key=lambda p: p[0])
        piece = self.pool.pop(at - 1 if at else 0)
        self.tokens -= piece[0]
        if at:
            return piece
        length, number, row, start, ids, total = piece
        self._wait(row, start + most, ids[4 * most:], total)
        return most, number, row, start, ids[:4 * most], total

    def _fill(self, window: int) -> None:
        pieces, gap = [], window
        while gap:
            pieces.append(self._take(gap))
            gap -= pieces[-1][0]
        self.emit(window, pieces)

    def close(self) -> None:
        """Windows for what waits: the largest tier while it lasts, then powers of two."""
        while self.tokens:
            self._fill(min(self.tiers[-1], 1 << (self.tokens.bit_length() - 1)))


PIECES = ("doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, "
          "sequence_id bigint, offset bigint, window bigint, step_group bigint")


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, tiers: tuple[int, ...] = TIERS,
         group_tokens: int = GROUP_TOKENS, id_col: str = "doc_id", text_col: str = "text",
         keep_words: bool = True) -> DataFrame:
    """One row per piece of a document: where it comes from and where it lies.

    A document's ids are its text's ids and ``end_id``; NULL and empty texts have
    the latter alone. ``ids`` holds the piece's ids as little-endian unsigned 32-bit
    numbers, ``window`` the length of its window: the largest tier, or a smaller
    power of two; all windows are full. ``tiers`` are powers of two. Windows of a
    step group sum to ``group_tokens`` tokens but for one group per partition.
    ``keep_words=False`` empties a worker's table of known words after each
    partition, for jobs whose workers go on to other stages.
    NULL ids and repeated rows are packed like any other; other columns are
    ignored; an empty table gives no piece.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = PIECES.format(kind=kind)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        base = (context.partitionId() if context else 0) << 32
        end = int(end_id).to_bytes(4, "little")
        words = encoder(tokenizer_path)
        out: dict[str, list] = {}
        ready: list[tuple[int, int, list[list[tuple]]]] = []
        open_groups: dict[int, list] = {}
        sequences = groups = 0
        id_type = None

        def emit(window: int, pieces: list[tuple]) -> None:
            nonlocal groups
            group = open_groups.setdefault(window, [])
            group.append(pieces)
            if len(group) * window >= group_tokens:
                ready.append((groups, window, open_groups.pop(window)))
                groups += 1

        def rows() -> Iterator[pa.RecordBatch]:
            nonlocal sequences
            columns: list[list] = [[] for _ in range(9)]
            for number, window, group in ready:
                for pieces in group:
                    offset = 0
                    for length, _, row, start, ids, total in pieces:
                        for column, value in zip(columns, (
                                row, start, length, bytes(ids), total, base + sequences, offset,
                                window, base + number)):
                            column.append(value)
                        offset += length
                    sequences += 1
            ready.clear()
            if columns[0]:
                types = [id_type, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 5]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset",
                           "window", "step_group"])

        packer = Packer(emit, tiers)
        for batch in by_record(batches, 256):
            id_type = batch.schema.field(0).type
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for row, ids in zip(batch.column(0).to_pylist(), words.encode(texts)):
                packer.add(row, ids + end)
            yield from rows()
        packer.close()
        # Groups left incomplete share the last step groups, largest windows first.
        rest = sorted(((w, p) for w, group in open_groups.items() for p in group), key=lambda x: -x[0])
        filled = 0
        for window, pieces in rest:
            if filled + window > group_tokens:
                groups, filled = groups + 1, 0
            ready.append((groups, window, [pieces]))
            filled += window
        yield from rows()
        if not keep_words:
            words.forget()

    return (
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        .mapInArrow(run, schema)
    )
