import hashlib
import subprocess
import sys

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from carelattice.llm import chat
from tests.llm.helpers import by_id

PIECES = st.lists(st.sampled_from(["<turn ", "</turn>", "</turn>\n", "\\", "<", "<t", "urn", ">\n", "é", "a", "", "🙂", "\\\\", "/turn"]),
                  max_size=8).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(PIECES, PIECES), min_size=1, max_size=6))
def test_round_trip(turns):
    roles, texts = zip(*turns)
    formatted, first, end = chat.assemble(pa.array(roles, pa.string()), pa.array(texts, pa.string()))
    whole = b""
    for row, role, text, s, e in zip(formatted.to_pylist(), roles, texts, first, end):
        raw = row.encode()
        assert chat.parse(raw) == [(role.encode(), text.encode())]
        assert chat._ESCAPED.sub(rb"\1", raw[s:e]) == text.encode()
        whole += raw
    assert chat.parse(whole) == [(r.encode(), t.encode()) for r, t in turns]


def test_blocks_and_slices(monkeypatch):
    monkeypatch.setattr(chat, "_BLOCK", 7)
    texts = ["</turn>" * 5, "", "\\a\\", "<turn" * 4 + "x" * 20]
    column = pa.array(["skipped", *texts], pa.string()).slice(1)
    formatted, _, _ = chat.assemble(pa.array(["user"] * 4, pa.string()), column)
    assert chat.parse("".join(formatted.to_pylist()).encode()) == [(b"user", t.encode()) for t in texts]


def test_broken_bytes_are_refused():
    for raw in (b"x", b"<turn user>\nabc", b"<turn user>\na</turn>\nrest"):
        with pytest.raises(ValueError, match="no turn"):
            chat.parse(raw)


def test_conversations_equal_brute_force(spark):
    rows = [(1, 2, "assistant", "b</turn>"), (1, 0, "system", "s"), (1, 1, "user", None), (2, 0, None, "x"), (2, 0, None, "x"),
            (None, 1, "assistant", "n"), (None, None, "assistant", "first"), (3, 5, "assistant", ""), (1, 3, "assistant", "é\\"),
            (4, 0, "assistant", "long " * 200_000), (2, None, "user", "null turn first")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr(
        "*", "1 as formatted", "2 as loss_start")
    want = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        c = want.setdefault(conv, [0, "", ""])
        c[0] += 1
        c[1] += f"{role or ''}\n{text or ''}\n"
        c[2] += (text or "") if role == "assistant" else ""
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    formatted = chat.format_turns(df)
    got = by_id(chat.digests(formatted), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert got == sorted(((c, n, sha(t), len(x), sha(x)) for c, (n, t, x) in want.items()), key=repr)
    assert chat.digests(chat.format_turns(df.limit(0))).collect() == []
    size = sum(len(r["formatted"]) for r in formatted.collect())
    assert sum(r["formatted_chars"] for r in chat.digests(formatted).collect()) == size


def test_one_very_long_turn_is_read_in_little_memory():
    """In a process of its own, whose peak is known: 64 MB of text, of which a quarter is escaped."""
    code = """
import resource
import pyarrow as pa
from carelattice.llm import chat
text = "x\\\\<turn y" * (64 * 1024 * 1024 // 8)
formatted, first, end = chat.assemble(pa.array(["assistant"]), pa.array([text], pa.large_string()))
raw = formatted[0].as_buffer().to_pybytes()
del formatted
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
found = chat._TURN.match(raw)
assert found and found.end() == len(raw)
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout) < 100 * 1024
