import re

import numpy as np

from carelattice.llm import decontaminate as D
from tests.llm.helpers import by_id, documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(pairs, items, size=13):
    windows = {}
    for item, text in items:
        w = words(text)
        if item is not None and w:
            for k in range(max(1, len(w) - size + 1)):
                windows.setdefault(tuple(w[k:k + size]), set()).add(str(item))
    out = []
    for i, text in pairs:
        w = words(text)
        hit, found = set(), set()
        for phrase, names in windows.items():
            for k in range(len(w) - len(phrase) + 1):
                if tuple(w[k:k + len(phrase)]) == phrase:
                    hit |= set(range(k, k + len(phrase)))
                    found |= names
        out.append((i, len(w), len(hit), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def judged(spark, pairs, items, **options):
    bench = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 as phrase", "2 as term")
    got = by_id(D.contamination(documents(spark, pairs), bench, **options),
                "doc_id", "n_words", "n_hit", "item_ids", "contaminated")
    return sorted(((a, b, c, tuple(d), e) for a, b, c, d, e in got), key=repr)


def case():
    rng = np.random.default_rng(0)

    def prose(n, k=60):
        return [f"w{x}" for x in rng.integers(0, k, n)]

    items = [(i, " ".join(prose(int(rng.integers(10, 40))))) for i in range(12)]
    items += [(20, "Short One!"), (21, "the the the the"), (22, None), (23, ""), (24, "?!"), (None, "w1 w2"), (20, "w5 w6 w7 w8"),
              (25, items[0][1]), (26, " ".join(["the"] * 20)), (27, "É 日本 x1")]
    pairs = []
    for i in range(30):
        text = prose(int(rng.integers(0, 200)))
        if i % 3 == 0:
            text[5:5] = items[i % 12][1].split()[:int(rng.integers(8, 40))]
        if i % 5 == 0:
            text += ["SHORT-one", "the " * int(rng.integers(1, 30))]
        pairs.append((i, " ,".join(text)))
    pairs += [(40, None), (41, ""), (42, items[3][1].upper()), (43, "the " * 500), (None, items[4][1]), (42, items[5][1]),
              (44, items[3][1]), (44, items[3][1]), (45, "É 日本 x1"), (46, "É 日本 x1"), (47, "a " * 50_000 + items[1][1])]
    return pairs, items


def test_equals_brute_force(spark):
    pairs, items = case()
    want = brute(pairs, items)
    assert sum(r[4] for r in want) > 8
    assert judged(spark, pairs, items) == want


def test_blocks_of_the_benchmark_give_the_same(spark):
    pairs, items = case()
    assert judged(spark, pairs, items, block=60) == brute(pairs, items)


def test_empty_tables(spark):
    assert judged(spark, [(1, "a b")], []) == [(1, 2, 0, (), False)]
    bench = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert D.contamination(documents(spark, ["a"]).limit(0), bench).collect() == []


def test_near_matches(spark):
    docs = documents(spark, ["x alpha y beta z gamma", "gamma q q q q q q q q q alpha beta", "alpha beta gamma", "beta"])
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id bigint, text string")
    corpus = D._corpus(docs, "doc_id", "text")
    phrases = D.windows_of(bench).select("phrase")
    chosen = D.rarest_terms(phrases, D.term_counts(corpus, phrases), rarest=3)
    index = D.postings(corpus, chosen)

    def ids(slop):
        return sorted({r["doc_id"] for r in D.near_matches(index, chosen, slop).collect()})

    assert ids(0) == [2] and ids(2) == [0, 2] and ids(20) == [0, 1, 2]
    assert [r["doc_id"] for r in D.exact_matches(index, chosen).collect()] == [2]


def test_passages_of_unnamed_items(spark):
    """They are found where the caller wants them, and put no name in the list."""
    passage = " ".join(f"p{i}" for i in range(15))
    pairs, items = [(1, f"a {passage} b"), (2, "a b c")], [(None, passage), (5, "b c d")]
    assert judged(spark, pairs, items) == [(1, 17, 0, (), False), (2, 3, 0, (), False)]
    assert judged(spark, pairs, items, unnamed=True) == [(1, 17, 15, (), True), (2, 3, 0, (), False)]
    assert judged(spark, pairs, [*items, (6, passage)], unnamed=True)[0] == (1, 17, 15, ("6",), True)
