from fractions import Fraction
from itertools import permutations
from math import factorial
from random import Random

import pytest

from carelattice.llm import filter_audit
from tests.llm.helpers import by_id

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def failures(rows):
    """The failed filters of every (doc_id, text, lang), plainly."""
    out = []
    for i, text, lang in rows:
        text = text or ""
        words = [w.decode() for w in text.encode().split()]
        failed = set()
        if len(words) < 100:
            failed.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            failed.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text):
            failed.add("C")
        if set(text) & set("#$%&*|"):
            failed.add("D")
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows):
            failed.add("E")
        out.append((i, lang or "", failed))
    return out


def brute(rows, labels):
    good, toxic = ({i for i, *x in labels if x[k] == 1} - {None} for k in (0, 1))
    docs, out = failures(rows), []
    for part in {p for _, p, _ in docs}:
        own = [(i, f) for i, p, f in docs if p == part]
        found = []
        for order in permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                gone = [d for d in left if name in d[1]]
                left = [d for d in left if name not in d[1]]
                found.append([part, "".join(order), step, len(left), len(gone), sum(name in f for _, f in own) - len(gone),
                              sum(f == {name} for _, f in own), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)])
        totals = {}
        for r in found:
            totals[r[1][r[2] - 1]] = totals.get(r[1][r[2] - 1], 0) + r[4]
        out += [(*r, totals[r[1][r[2] - 1]]) for r in found]
    return sorted(out, key=repr)


def frames(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").selectExpr(
        "*", "1 as n", "'x' as part", "2 as failed", "3 as good", "4 as text_key", "5 as is_first")
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").selectExpr("*", "1 as good", "2 as text")


def test_equals_brute_force(spark):
    rng = Random(2)
    words = ["Alpha", "beta", "GAMMA", "d#", "e", "é", "ß|", "Z"] + [f"w{i}" for i in range(150)]
    texts = [" ".join(rng.choices(words[:rng.choice([3, 8, 158])], k=rng.choice([0, 1, 40, 99, 100, 101, 130]))) for _ in range(40)]
    texts += [" ".join(f"w{i}" for i in range(100)), " ".join(f"w{i}" for i in range(99)), "A" + "b" * 9, "AB" + "b" * 17,
              " ".join(f"u{i % 80}" for i in range(100)), " ".join(f"u{i % 79}" for i in range(100)), None, "", "\x0b \t", "x\xa0y", "long " * 300_000]
    rows = [(rng.choice([i, i, rng.randrange(60), None]), t, rng.choice(["en", "de", None, ""]))
            for i, t in enumerate(texts + rng.choices(texts[:-1], k=60))]
    rows += [(7, "same", "en"), (7, "same", "en"), (3, "same", "fr"), (None, "same", "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(60) if i % 3] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (900, 1, 1)]
    docs, marks = frames(spark, rows, labels)
    assert by_id(filter_audit.audit(filter_audit.failed_sets(docs, marks)), *COLUMNS) == brute(rows, labels)


def test_empty_tables(spark):
    docs, marks = frames(spark, [(1, "a", None)], [(1, 1, 1)])
    assert filter_audit.audit(filter_audit.failed_sets(docs.limit(0), marks)).collect() == []
    found = filter_audit.audit(filter_audit.failed_sets(docs, marks.limit(0)))
    assert by_id(found, *COLUMNS) == brute([(1, "a", None)], []) and found.count() == 600


def test_least_squares_give_shapley_values():
    rng = Random(1)
    for players in range(2, 7):
        values = [0] + [rng.randrange(1000) for _ in range((1 << players) - 1)]
        shares = [Fraction(0)] * players
        for order in permutations(range(players)):
            before = 0
            for i in order:
                shares[i] += Fraction(values[before | 1 << i] - values[before], factorial(players))
                before |= 1 << i
        assert filter_audit.KernelSolver(players)(values) == shares


def test_other_filters(spark):
    """Any number of filters up to the limit, from counts made elsewhere."""
    sets = spark.createDataFrame([("p", 3, True, False, 5), ("p", 0, False, False, 2), ("p", 1, False, True, 1)],
                                 "part string, failed int, good boolean, toxic boolean, n bigint")
    got = by_id(filter_audit.audit(sets, "XY"), *COLUMNS)
    assert got == [("p", "XY", 1, 2, 6, 0, 1, 5, 1, 7), ("p", "XY", 2, 2, 0, 5, 0, 0, 0, 5),
                   ("p", "YX", 1, 3, 5, 0, 0, 5, 0, 5), ("p", "YX", 2, 2, 1, 5, 1, 0, 1, 7)]
    for letters in ("A", "ABCDEFG"):
        with pytest.raises(ValueError, match="filters"):
            filter_audit.audit(sets, letters)
