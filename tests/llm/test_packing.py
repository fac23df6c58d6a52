import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from carelattice.llm import packing
from carelattice.llm.queries import tokenizer_path
from tests.llm.helpers import documents


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(tokenizer_path())


ODD = ["", " \n\t ", "Hello, World. It's I'll 123 a.b. x,. .", "ÀÉÎ ß İstanbul ΣΑΣ ς ǅ", "a b\u0085c d​e",
       "\x1c\x1d\x1e\x1f a\x1cb", "é ́x", "<|endoftext|> a<|startoftext|>b <|x|>", "日本語 テスト🙂🏽",
       "word. Word, WORD word.. w. ,", "a\x00b", "x" * 5000, "ª. º, ²", "don't DON'T we've", "﻿a"]


def test_words_encode_as_whole_texts(reference):
    words = packing.WordEncoder(tokenizer_path())
    for text in ODD:
        want = np.array(reference.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert words.encode([text.encode()])[0] == want, text


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_any_text(text):
    words = packing.encoder(tokenizer_path())
    want = words.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(words.encode([text.encode("utf-8", "replace")])[0], "<u4").tolist() == (
        want if text.encode("utf-8", "replace").decode() == text else words.tokenizer.encode(
            text.encode("utf-8", "replace").decode(), add_special_tokens=False).ids)


def read_back(pieces):
    """Ids by document from pieces, with the checks that hold for any packing."""
    windows = {}
    texts = {}
    for r in pieces:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] > 0
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["window"]))
        texts.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], ids.tolist()))
    for rows in windows.values():
        at = 0
        for offset, length, window in sorted(rows):
            assert offset == at
            at += length
        assert at == rows[0][2] and (at == 4096 or at & (at - 1) == 0) and at <= 4096
    return texts


def test_round_trip(spark, reference):
    rng = np.random.default_rng(0)
    texts = ODD + [" ".join(f"w{x}" for x in rng.integers(0, 99, int(n))) for n in rng.integers(1, 3000, 120)] + [
        "long " * 30_000, None]
    docs = documents(spark, texts).repartition(3)
    got = packing.pack(docs, tokenizer_path(), group_tokens=8192).collect()
    found = read_back(got)
    assert len(found) == len(texts)
    for (doc, total), parts in found.items():
        ids = [i for start, part in sorted(parts) for i in part]
        assert [s for s, _ in sorted(parts)] == np.cumsum([0, *[len(p) for _, p in sorted(parts)][:-1]]).tolist()
        assert ids == reference.encode(texts[doc] or "", add_special_tokens=False).ids + [2] and len(ids) == total
    groups = {}
    for s, w, g in {(r["sequence_id"], r["window"], r["step_group"]) for r in got}:
        groups.setdefault(g, []).append(w)
    sizes = [sum(w) for w in groups.values()]
    assert max(sizes) == 8192 and sum(s < 8192 for s in sizes) <= 3
    assert len({r["window"] for r in got}) >= 3


def test_many_tiny_documents_wait_for_a_full_window():
    out = []
    packer = packing.Packer(lambda window, pieces: out.append((window, pieces)), (512, 1024), waiting=4)
    for i in range(5000):
        packer.add(i, b"\0\0\0\0")
    packer.close()
    assert sum(w for w, _ in out) == 5000 and all(sum(p[0] for p in ps) == w for w, ps in out)


def test_nulls_repeats_empty(spark):
    docs = documents(spark, [(None, "a b"), (1, "a b"), (1, "a b"), (2, None)])
    got = packing.pack(docs, tokenizer_path()).collect()
    assert sum(r["length"] for r in got) == 3 + 3 + 3 + 1
    assert packing.pack(docs.limit(0), tokenizer_path()).collect() == []
