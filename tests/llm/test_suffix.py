import hashlib
from collections import Counter
from os.path import commonprefix
from random import Random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from carelattice.llm import suffix_dedup, suffix_sort
from tests.llm.helpers import by_id, documents

RUN = st.lists(st.binary(max_size=90).map(lambda b: bytes(x & 1 for x in b)), max_size=12).map(sorted)


@settings(max_examples=150, deadline=None)
@given(st.lists(RUN, max_size=9))
def test_merge(runs):
    coded = [suffix_sort.front_code(r) for r in runs]
    assert [suffix_sort.front_decode(*c) for c in coded] == runs
    order, common = suffix_sort.merge([(r, c[0]) for r, c in zip(runs, coded)])
    flat = [s for r in runs for s in r]
    assert sorted(order.tolist()) == list(range(len(flat)))
    merged = [flat[i] for i in order]
    assert merged == sorted(flat)
    assert common.tolist()[1:] == [len(commonprefix(pair)) for pair in zip(merged, merged[1:])]


def test_merge_does_not_compare_known_prefixes(monkeypatch):
    seen = []
    plain = suffix_sort.shared
    monkeypatch.setattr(suffix_sort, "shared", lambda a, b, known=0: seen.append(plain(a, b, known) - known) or plain(a, b, known))
    runs = [sorted(b"p" * 1000 + bytes([x, k]) for x in range(40)) for k in range(8)]
    coded = [suffix_sort.front_code(r) for r in runs]
    seen.clear()
    suffix_sort.merge([(r, c[0]) for r, c in zip(runs, coded)])
    # Seven comparisons build the tree; later ones start behind the common prefix.
    assert sum(n >= 1000 for n in seen) <= 7 and sum(seen) < 7 * 1002 + 2 * 40 * 8 * 3


def brute(texts):
    texts = [(t or "").encode() for t in texts]
    starts = Counter(t[i:i + 200] for t in texts for i in range(len(t) - 199))
    out = []
    for t in texts:
        gone, reach = np.zeros(len(t) + 1, bool), 0
        for i in range(len(t) - 199):
            if starts[t[i:i + 200]] > 1:
                gone[max(i, reach):i + 200] = True
                reach = i + 200
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), int((np.diff(gone.astype(int)) > 0).sum() + gone[0]), hashlib.sha256(kept).hexdigest()))
    return out


def corpus():
    rng = Random(5)

    def prose(n):
        return "".join(rng.choices("abcdefghij é", k=n))

    base, line = prose(3000), prose(230)
    texts = [base, base, base[:1000], "x" + base[500:1500] + prose(100), "a" * 5000, "ab" * 700, "lorem " * 100, None, "", "short",
             "short", base[100:299], base[100:300], base[1000:1200], "q" * 199, "q" * 199, "zz" + "q" * 200, "z" * 199 + "y" + "z" * 199]
    for cut in (line, line[:205], line[10:215], line[:199]):
        texts += [prose(rng.randint(0, 300)) + cut + prose(rng.randint(0, 300)) for _ in range(25)]
    return texts + [base[:i] + "#" + base[i:] for i in range(0, 3000, 211)] + [prose(20_000)]


# Crowded anchors beyond a few places, many ranges, small runs.
@pytest.mark.parametrize("crowd, per_range, run_bytes", [(20_000, 50_000, 32 << 20), (5, 40, 20_000), (30, 200, 50_000)])
def test_equals_brute_force(spark, monkeypatch, crowd, per_range, run_bytes):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    monkeypatch.setattr(suffix_dedup, "RANGE", per_range)
    monkeypatch.setattr(suffix_dedup, "RUN_BYTES", run_bytes)
    texts = corpus()
    docs = documents(spark, texts).repartition(4)
    found = suffix_dedup.repeated_bytes(docs).selectExpr("doc_id", "n_bytes", "n_removed", "size(spans) as n", "kept_sha256")
    want = brute(texts)
    assert sum(w[1] for w in want) > 40_000
    assert by_id(found, "*") == sorted(((i, *w) for i, w in enumerate(want)), key=repr)


def test_repeated_and_missing_ids(spark):
    text = "".join(Random(1).choices("abcdef", k=400))
    docs = documents(spark, [(None, text), (None, text), (1, text[:250]), (1, "z" * 10), (1, "z" * 10), (2, None), (None, None)])
    got = by_id(suffix_dedup.repeated_bytes(docs), "doc_id", "n_bytes", "n_removed")
    assert got == sorted([(None, 400, 400), (None, 400, 400), (1, 250, 250), (1, 10, 0), (1, 10, 0), (2, 0, 0), (None, 0, 0)], key=repr)
    assert suffix_dedup.repeated_bytes(docs.limit(0)).collect() == []


@pytest.mark.parametrize("step", [1, 100, 1 << 20])
def test_every_window_has_one_anchor(monkeypatch, step):
    monkeypatch.setattr(suffix_dedup, "_STEP", step)
    rng = Random(3)
    for text in (bytes(rng.choices(b"ab", k=700)), b"a" * 500, b"abc" * 200, bytes(rng.choices(b"abcdefgh", k=200)), b"a" * 199,
                 b"x" * 300 + bytes(rng.choices(b"abcdefgh", k=400)) + b"x" * 300):
        anchor = {}
        for places, firsts, lasts, grams in suffix_dedup.anchors(text):
            for p, a, b, g in zip(places.tolist(), firsts.tolist(), lasts.tolist(), grams.tolist()):
                for w in range(a, b + 1):
                    assert w not in anchor and w <= p <= w + 200 - suffix_dedup.GRAM
                    anchor[w] = (p - w, g)
        assert sorted(anchor) == list(range(max(0, len(text) - 199)))
        same = {}
        for w, a in anchor.items():
            assert same.setdefault(text[w:w + 200], a) == a


def test_offsets_without_suffixes():
    """Ranges of offsets need not touch: between them there is nothing to compare."""
    order = (np.array([0, 1, 2]), np.array([0, 208, 208]))
    low, high = np.array([3, 3, 9]), np.array([4, 4, 9])
    smallest, largest = suffix_dedup.repeated_offsets(order, order, low, high, np.zeros(3, bool))
    assert smallest.tolist() == [3, 3, 1] and largest.tolist() == [4, 4, 0]


def test_ranges_are_about_equal(spark):
    """Anchors have the smallest fingerprint of their window, which lie in a small part of all numbers."""
    rng = Random(3)
    texts = ["".join(rng.choices("abcdefgh ", k=4_000)) for _ in range(40)]
    grams = [np.unique(np.concatenate([g for *_, g in suffix_dedup.anchors(t.encode())])).view(np.int64).tolist() for t in texts]
    rows = [(bytes([i]) * 16, t, g) for i, (t, g) in enumerate(zip(texts, grams))]
    runs = suffix_dedup.sorted_runs(spark.createDataFrame(rows, "key binary, text string, grams array<bigint>"), 16, 1 << 20)
    sizes = Counter()
    for r in runs.select("part", "low").collect():
        sizes[r["part"]] += len(r["low"]) // 4
    assert len(sizes) == 16 and max(sizes.values()) < 2 * sum(sizes.values()) / 16
