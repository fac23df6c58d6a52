import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from carelattice.llm import simhash
from tests.llm.helpers import by_id, documents


def naive(text, shingle=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcA \t\n\x0bÄ \x1c", max_size=60))
def test_fingerprint(text):
    assert simhash.text_fingerprint(text) == naive(text)


def test_jvm_hash_is_the_same(spark):
    row = spark.sql("select xxhash64('abc def') as h").first()
    assert row.h % (1 << 64) == xxhash.xxh64_intdigest(b"abc def", 42)


def near(value, bits, rng):
    for b in rng.choice(64, bits, replace=False):
        value ^= 1 << int(b)
    return value


def brute(prints, most):
    values = np.array(sorted(prints), np.uint64)
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    apart = np.bitwise_count(values[:, None] ^ values[None, :])
    for i, j in zip(*np.nonzero(np.triu(apart <= most, 1))):
        a, b = root(int(i)), root(int(j))
        parent[max(a, b)] = min(a, b)
    return {int(v): int(values[root(i)]) for i, v in enumerate(values)}


def test_ball_links_connect_what_brute_force_connects(spark, monkeypatch):
    rng = np.random.default_rng(0)
    base = [int(x) for x in rng.integers(0, 1 << 63, 60, dtype=np.uint64) * 2]
    prints = set(base) | {0, (1 << 64) - 1}
    for v in base:
        prints |= {near(v, int(rng.integers(1, 7)), rng) for _ in range(4)}
    prints |= {near(base[0], 2, rng) for _ in range(150)}  # a crowd around one print
    want = brute(prints, 4)
    frame = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fingerprint bigint")
    # The second forces deep splits, the others longer keys and keys cut between batches.
    for limit, prefix, crowd, held in ((simhash._VARIANTS, 20, simhash.CROWD, 200_000), (3_000, 8, 100_000, 200_000),
                                       (100_000, 8, 5, 50), (100_000, 20, 0, 7)):
        monkeypatch.setattr(simhash, "_VARIANTS", limit)
        monkeypatch.setattr(simhash, "_MESSAGES", held)
        links = [(a % (1 << 64), b % (1 << 64)) for a, b in simhash.ball_links(frame, 4, prefix, crowd).collect()]
        assert all(0 < (a ^ b).bit_count() <= 4 for a, b in links)
        parent = {p: p for p in prints}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in links:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
        assert {p: root(p) for p in prints} == want


def test_splits_in_the_task_lose_no_variant():
    rng = np.random.default_rng(3)
    own = np.array([near(12345, int(rng.integers(0, 5)), rng) for _ in range(80)], np.uint64)
    own = np.unique(own)
    used = np.zeros(len(own), np.int64)

    def linked(limit):
        pairs = [p for found in simhash._meet(own, own.copy(), used, 0, 2, limit) for p in found.tolist()]
        graph = {int(v): int(v) for v in own}

        def root(x):
            while graph[x] != x:
                x = graph[x]
            return x

        for a, b in pairs:
            a, b = root(a), root(b)
            graph[max(a, b)] = min(a, b)
        return {v: root(v) for v in graph}

    assert linked(10_000_000) == linked(500) == brute({int(v) for v in own}, 4)


def test_nulls_repeats_and_empty_table(spark):
    long = "word " * 300_000
    docs = documents(spark, [(5, "a b c d e"), (3, "A b C d  e"), (3, "a b c d e"), (7, None), (6, " \n"), (None, ""),
                             (9, long), (10, long + "x"), (None, "only me here"), (11, "w")])
    got = by_id(simhash.simhash_classes(docs), "id", "component_id", "fingerprint")
    assert [(i, c) for i, c, _ in got] == [(10, 9), (11, 11), (3, 3), (3, 3), (5, 3), (6, 6), (7, 6), (9, 9), (None, 6), (None, None)]
    assert all(f == 0 for i, c, f in got if c == 6)
    assert simhash.simhash_classes(docs.limit(0)).collect() == []
