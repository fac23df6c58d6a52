import hashlib
import math
import zlib
from collections import defaultdict
from random import Random

import pytest

from carelattice.llm import turn_trie
from tests.llm.helpers import CLASHING, by_id

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append(c)
        ends[tuple(whole)].append(c)
    for n in members:
        if n:
            children[n[:-1]].append(n)
    below, out = {}, []
    for n in sorted(members, key=len, reverse=True):
        saved = (len(members[n]) - 1) * len(n[-1][1].encode()) if n else 0
        below[n] = (sum(below[c][0] for c in children[n]) or 1, saved + sum(below[c][1] for c in children[n]))
        out.append((min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), len(children[n]), *below[n],
                    hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations():
    rng = Random(3)
    rows = []
    for c in [*range(60), -7, -5, -3, 1000, 1004, 77777]:
        for t in range(rng.choice([1, 2, 3, 4, 8, 12, 20])):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "é", "", None])))
    rows += [(None, 1, "user", "x"), (90, 0, "user", "a"), (90, 0, "user", "a"), (4_000_000_000, 0, "user", "long " * 200_000)]
    # Prefixes of one another, copies, and a common start of six turns.
    rows += [(200 + 5 * i, t, "user", f"t{t}") for i in range(30) for t in range(i + 1)]
    rows += [(500 + 5 * i, t, "user", f"t{t}") for i in range(30) for t in range(20)]
    rows += [(1500 + 5 * i, t, "user", f"t{t}" if t < 6 else f"{i}") for i in range(30) for t in range(9)]
    return rows


@pytest.mark.parametrize("group, block", [(1000, 1024), (20, 7), (3, 1)])
def test_equals_brute_force(spark, monkeypatch, group, block):
    monkeypatch.setattr(turn_trie, "GROUP", group)
    monkeypatch.setattr(turn_trie, "ID_BLOCK", block)
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr(
        "*", *[f"cast(null as string) as `{c}`" for c in (*CLASHING, "path", "sizes", "family", "digest", "size")])
    assert by_id(turn_trie.trie(turn_trie.rebuilt(df)), *COLUMNS) == brute(rows)


def test_empty_and_turnless(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    rows = [(c, 0, "user", "x") for c in (1, 2, 3, 4)]
    assert any(zlib.crc32(str(c).encode()) % 9 for c, *_ in rows)
    df = spark.createDataFrame(rows, schema)
    assert by_id(turn_trie.trie(turn_trie.rebuilt(df)), *COLUMNS) == brute(rows)
    assert turn_trie.trie(turn_trie.rebuilt(df.limit(0))).collect() == []
    assert turn_trie.trie(turn_trie.rebuilt(spark.createDataFrame([(None, 0, "user", "x")], schema))).collect() == []
