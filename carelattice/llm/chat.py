"""Chat formatting by columnar byte assembly.

A turn becomes ``<turn ROLE>``, a line feed, its text and ``</turn>`` with another
line feed. A backslash stands before every backslash and every ``<turn`` and
``</turn`` inside a text (and before each backslash and angle bracket of a role),
so no text can end or open a turn and all of it can be read back.

A batch is assembled without touching rows one by one: numpy marks the bytes to
escape, cumulative sums give every byte its place, and headers, texts and ends are
scattered into one preallocated buffer that becomes the Arrow column.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelattice.llm.common import by_record

# The template.
_OPEN, _MIDDLE, _CLOSE = b"<turn ", b">\n", b"</turn>\n"
_ESCAPE = ord("\\")
LOSS_ROLE = "assistant"
# Text bytes placed at once.
_BLOCK = 1 << 20

# Nothing of a turn is tried twice, so no places to go back to are kept.
_TURN = re.compile(rb"<turn ((?:[^\\>]++|\\.)*+)>\n((?:[^\\<]++|\\.|<(?!/?turn))*+)</turn>\n", re.DOTALL)
_ESCAPED = re.compile(rb"\\(.)", re.DOTALL)
_ROLE_SPECIAL = re.compile(rb"[\\<>]")


def _parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without NULLs, and row offsets into them."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def _marks(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sorted places of the bytes that need an escape before them."""
    places = [np.flatnonzero(data == _ESCAPE)]
    angles = np.flatnonzero(data == ord("<"))
    ends = offsets[np.searchsorted(offsets, angles, side="right")] if len(angles) else angles
    for control in (b"<turn", b"</turn"):
        fits = angles[angles + len(control) <= ends]
        for i, byte in enumerate(control):
            fits = fits[data[fits + i] == byte]
        places.append(fits)
    return np.sort(np.concatenate(places))


def _scatter(out: np.ndarray, starts: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copy row i of (data, offsets) to ``starts[i]`` on, in blocks of bytes."""
    shift = starts - offsets[:-1]
    for at in range(0, len(data), _BLOCK):
        place = np.arange(at, min(at + _BLOCK, len(data)))
        row = np.searchsorted(offsets, place, side="right") - 1
        out[place + shift[row]] = data[place]


def _scatter_escaped(out: np.ndarray, starts: np.ndarray, data: np.ndarray, offsets: np.ndarray,
                     marks: np.ndarray) -> None:
    """As ``_scatter``, with the escape byte before every marked byte."""
    before = np.searchsorted(marks, offsets[:-1])
    shift = starts - offsets[:-1] - before
    for at in range(0, len(data), _BLOCK):
        place = np.arange(at, min(at + _BLOCK, len(data)))
        row = np.searchsorted(offsets, place, side="right") - 1
        target = place + shift[row] + np.searchsorted(marks, place, side="right")
        out[target] = data[place]
        here = marks[np.searchsorted(marks, place[0]):np.searchsorted(marks, place[-1], side="right")]
        out[target[here - at] - 1] = _ESCAPE


def _constant(out: np.ndarray, starts: np.ndarray, value: bytes) -> None:
    for i, byte in enumerate(value):
        out[starts + i] = byte


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Formatted turns of columns without NULLs, and each text's first and end byte in its turn."""
    codes = roles.dictionary_encode()
    names = pa.array([_ROLE_SPECIAL.sub(rb"\\\g<0>", n.encode()) for n in codes.dictionary.to_pylist()], pa.binary())
    role_data, role_offsets = _parts(names.take(codes.indices) if len(names) else names)
    data, offsets = _parts(texts)
    marks = _marks(data, offsets)
    role_size, text_size = np.diff(role_offsets), np.diff(offsets)
    escapes = np.searchsorted(marks, offsets[1:]) - np.searchsorted(marks, offsets[:-1])
    first = len(_OPEN) + role_size + len(_MIDDLE)
    end = first + text_size + escapes
    ends = np.cumsum(end + len(_CLOSE))
    starts = ends - end - len(_CLOSE)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    _constant(out, starts, _OPEN)
    _scatter(out, starts + len(_OPEN), role_data, role_offsets)
    _constant(out, starts + first - len(_MIDDLE), _MIDDLE)
    _scatter_escaped(out, starts + first, data, offsets, marks)
    _constant(out, starts + end, _CLOSE)
    buffers = [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(out)]
    return pa.Array.from_buffers(pa.large_string(), len(ends), buffers), first, end


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, role, formatted, loss_start, loss_end) per turn, conversations in order.

    ``turns`` has conv_id, turn, role and text; other columns are ignored. Rows of a
    conversation lie together in one partition, by turn, then role, then text, NULL
    turns first. A NULL text or role counts as empty; NULL conversation ids form one
    conversation; repeated rows stay. The loss span, in bytes of the turn, covers
    the text of an assistant turn; it is empty for others. A conversation is the
    concatenation of its turns.

    Turns are streamed through a task in sorted order, so a conversation of any
    length needs only the memory of a batch.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_record(batches):
            roles = batch.column(1)
            formatted, first, end = assemble(roles, batch.column(2))
            scored = np.array([r == LOSS_ROLE for r in roles.to_pylist()], bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), roles, formatted.cast(pa.string()), pa.array(np.where(scored, first, 0)),
                 pa.array(np.where(scored, end, 0))],
                names=["conv_id", "role", "formatted", "loss_start", "loss_end"])

    kind = turns.schema["conv_id"].dataType.simpleString()
    ordered = turns.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(
        run, f"conv_id {kind}, role string, formatted string, loss_start bigint, loss_end bigint")


def parse(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """The (role, text) turns of formatted bytes; ValueError if they are not well formed."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at byte {at}")
        turns.append((_ESCAPED.sub(rb"\1", found[1]), _ESCAPED.sub(rb"\1", found[2])))
        at = found.end()
    return turns


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back per conversation from the output of :func:`format_turns`.

    Takes its partitions in their order; hashes are updated turn by turn, so nothing
    of a conversation is held but its digests.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list | None = None
        kind = None

        def close(rows: list[list]) -> pa.RecordBatch:
            columns = list(zip(*[(r[0], r[1], r[2].hexdigest(), r[3], r[4].hexdigest(), r[5]) for r in rows]))
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in by_record(batches):
            kind = batch.schema.field(0).type
            done = []
            for conv, text, start, end in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if now is None or now[0] != conv:
                    if now is not None:
                        done.append(now)
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                raw = text.encode()
                for role, content in parse(raw):
                    now[1] += 1
                    now[2].update(role + b"\n" + content + b"\n")
                loss = _ESCAPED.sub(rb"\1", raw[start:end])
                now[3] += len(loss.decode())
                now[4].update(loss)
                now[5] += len(text)
            if done:
                yield close(done)
        if now is not None:
            yield close([now])

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.select("conv_id", "formatted", "loss_start", "loss_end").mapInArrow(
        run, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
             "formatted_chars bigint")
