import hashlib

import numpy as np
import pytest

from carelattice.llm import substring
from tests.llm.helpers import by_id, documents


def brute(pairs, size):
    words = [(i, (t or "").encode().split()) for i, t in pairs]
    first = {}
    for i, w in words:
        if i is not None:
            for k in range(len(w) - size + 1):
                key = tuple(w[k:k + size])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if i is not None and first[tuple(w[k:k + size])] < i:
                gone[k:k + size] = [True] * size
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest(), b" ".join(kept).decode()))
    return sorted(out, key=repr)


def check(spark, pairs):
    docs = documents(spark, pairs)
    found = substring.repeated_words(docs)
    want = brute(pairs, substring.WINDOW)
    assert by_id(found, "doc_id", "n_words", "n_removed", "kept_sha256") == [w[:4] for w in want]
    texts = by_id(substring.without_spans(docs, found), "doc_id", "text")
    assert texts == sorted(((w[0], w[4]) for w in want), key=repr)
    return want


def test_planted_passages_equal_brute_force(spark):
    rng = np.random.default_rng(0)

    def prose(n, vocabulary=400):
        return [f"w{x}" for x in rng.integers(0, vocabulary, n)]

    passage, other = prose(70), prose(50)
    docs = []
    for i in range(40):
        text = prose(int(rng.integers(5, 300)))
        if i % 3 == 0:
            text[3:3] = passage[int(rng.integers(0, 12)):]
        if i % 7 == 0:
            text += other
        docs.append((i * 2 % 41, " ".join(text)))
    docs += [(100, docs[5][1]), (-1, docs[7][1]), (101, docs[5][1].replace(" ", "\n\t")), (102, " ".join(prose(49))),
             (103, docs[0][1] + " end"), (104, " ".join(["the"] * 400)), (105, " ".join(["the"] * 300)),
             (106, None), (107, ""), (108, " \n "), (None, docs[5][1]), (109, docs[5][1]), (109, docs[5][1]),
             (110, "ä ö " * 60), (111, "x " + "ä ö " * 60)]
    want = check(spark, docs)
    assert sum(w[2] for w in want) > 1000


def test_steps_do_not_change_long_texts(spark, monkeypatch):
    rng = np.random.default_rng(1)
    words = [f"w{x}" for x in rng.integers(0, 30, 3000)]
    pairs = [(1, " ".join(words)), (2, " ".join(words[100:2000] + ["x"] + words[1500:])), (3, "a b")]
    monkeypatch.setattr(substring, "_STEP", 64)
    monkeypatch.setattr(substring, "_hasher", None)
    hasher = substring.Hasher()
    long = [w.encode() for w in words]
    keys = np.concatenate([k for _, _, k in hasher.steps(long)])
    one = np.concatenate([hasher.windows(h)[0] for _, h, _ in hasher.steps(long)])
    monkeypatch.setattr(substring, "_STEP", 1 << 19)
    whole = substring.Hasher()
    [(_, hashes, all_keys)] = whole.steps(long)
    assert (keys == all_keys).all() and (one == whole.windows(hashes)[0]).all()
    check(spark, pairs)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 41])
def test_sliding_minimum(size):
    values = np.random.default_rng(size).integers(0, 1000, 60).astype(np.uint64)
    assert (substring._sliding_minimum(values, size) == [values[i:i + size].min() for i in range(61 - size)]).all()


def test_sketch_never_underestimates(spark, monkeypatch):
    """With very few cells nearly everything passes, and the result is the same."""
    monkeypatch.setattr(substring, "WIDTH_BITS", 3)
    rng = np.random.default_rng(2)
    passage = " ".join(f"p{x}" for x in range(60))
    pairs = [(i, " ".join(f"w{x}" for x in rng.integers(0, 999, 80)) + " " + (passage if i % 4 == 0 else "")) for i in range(20)]
    check(spark, pairs)


def test_empty_table(spark):
    assert substring.repeated_words(documents(spark, ["a"]).limit(0)).collect() == []
