"""Sorted runs of byte strings: front coding, and merging that knows common prefixes.

A run is sorted and stores of every string only what follows the prefix it shares with
the one before. Runs are merged by a loser tree whose contestants carry the length of
the prefix they share with the last string put out. Of two, the one that shares more
is smaller; only when both share the same length are bytes compared, from there on.
The merge gives the shared prefix of every two neighbours as a by-product.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_STRIDE = 32


def shared(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known to be equal."""
    end = min(len(a), len(b))
    at = known
    while at + _STRIDE <= end and a[at:at + _STRIDE] == b[at:at + _STRIDE]:
        at += _STRIDE
    while at < end and a[at] == b[at]:
        at += 1
    return at


def front_code(strings: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """(shared prefix, rest length, rests) of sorted strings."""
    common = np.zeros(len(strings), np.int32)
    for i in range(1, len(strings)):
        common[i] = shared(strings[i - 1], strings[i])
    rests = [s[c:] for s, c in zip(strings, common.tolist())]
    return common, np.fromiter(map(len, rests), np.int32, len(rests)), b"".join(rests)


def front_decode(common: np.ndarray, lengths: np.ndarray, rests: bytes) -> list[bytes]:
    out, last, at = [], b"", 0
    for c, n in zip(common.tolist(), lengths.tolist()):
        last = last[:c] + rests[at:at + n]
        at += n
        out.append(last)
    return out


def merge(runs: Sequence[tuple[Sequence[bytes], Sequence[int]]]) -> tuple[np.ndarray, np.ndarray]:
    """Merged order of sorted runs, and the prefix each string shares with the one before it.

    A run is (strings, shared prefixes with their predecessors). Strings are numbered
    through all runs. Equal strings come by the number of their run.
    """
    runs = [(list(s), [int(c) for c in p]) for s, p in runs]
    total = sum(len(s) for s, _ in runs)
    base = np.cumsum([0] + [len(s) for s, _ in runs]).tolist()
    size = 1
    while size < len(runs):
        size *= 2
    at = [0] * size
    strings = [s for s, _ in runs] + [[]] * (size - len(runs))
    prefixes = [p for _, p in runs] + [[]] * (size - len(runs))
    ends = [len(s) for s in strings]
    # What the head of a run shares with the last string put out; -1 when the run is over.
    heads = [0 if e else -1 for e in ends]
    losers = [-1] * size

    def play(one: int, other: int) -> tuple[int, int]:
        """(winner, loser); the loser then shares heads[loser] with the winner."""
        h, g = heads[one], heads[other]
        if h != g:
            return (one, other) if h > g else (other, one)
        if h < 0:
            return (one, other) if one < other else (other, one)
        a, b = strings[one][at[one]], strings[other][at[other]]
        c = shared(a, b, h)
        if c == len(a) and c == len(b):
            first = one < other
        else:
            first = c == len(a) or (c < len(b) and a[c] < b[c])
        won, lost = (one, other) if first else (other, one)
        heads[lost] = c
        return won, lost

    winners = [-1] * size + list(range(size))
    for node in range(size - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    won = winners[1]

    order, common = np.empty(total, np.int64), np.empty(total, np.int32)
    for k in range(total):
        order[k], common[k] = base[won] + at[won], heads[won]
        at[won] += 1
        heads[won] = prefixes[won][at[won]] if at[won] < ends[won] else -1
        node = (won + size) >> 1
        while node:
            won, losers[node] = play(won, losers[node])
            node >>= 1
    if total:
        common[0] = 0
    return order, common
