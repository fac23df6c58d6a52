import numpy as np

from carelattice.llm import pq_dedup
from tests.llm.helpers import by_id


def brute(rows, cosine=0.93):
    usable = [r[2] is not None and r[1] is not None and len(r[1]) > 0 and all(x is not None and np.isfinite(x) for x in r[1])
              and any(r[1]) for r in rows]
    n = len(rows)
    links = [set() for _ in rows]
    for i in range(n):
        for j in range(n):
            if i != j and usable[i] and usable[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= cosine:
                    links[i].add(j)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for k in links[todo.pop()] - seen:
                seen.add(k)
                todo.append(k)
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        least = min(ids) if ids else None
        out.append((rows[i][0], len(links[i]), least, rows[i][0] == least))
    return sorted(out, key=repr)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    return df.selectExpr("*", "1 as cid", "2 as list", "3 as block", "4 as home", "5 as kind", "6 as n_links")


def as_float(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], c) for i, v, c in rows]


def test_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(120):
        v = rng.normal(size=12)
        rows.append((3 * i, v.tolist(), int(rng.integers(0, 3))))
        for k in range(int(rng.integers(0, 4))):
            rows.append((3 * i + 1000 * (k + 1), (v + rng.normal(size=12) * 0.12 * k).tolist(), rows[-1][2]))
    rows += [(-5, rows[0][1], rows[0][2]), (-5, rows[0][1], rows[0][2]), (77777, rows[4][1], None)]
    rows = as_float(rows)
    want = brute(rows)
    assert sum(r[1] for r in want) > 200
    for options in ({}, {"block": 7, "lists": 5}, {"sample": 10, "lists": 3}):
        got = pq_dedup.near_duplicates(frame(spark, rows), **options)
        assert by_id(got, "vec_id", "n_links", "component_id", "kept") == want


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 1), (2, None, 1), (3, [], 1), (4, [0.0, 0.0, 0.0], 1), (5, [1.0, None, 3.0], 1),
            (6, [1.0, float("nan"), 3.0], 1), (7, [float("inf"), 2.0, 3.0], 1), (8, v + [0.0], 1), (9, v, 2),
            (10, [2.0, 4.0, 6.0], 1), (11, [-0.0, 0.0, 1e-30], 1), (12, [0.0, 0.0, 1e30], 1), (None, v, 1), (13, v, None)]
    got = by_id(pq_dedup.near_duplicates(frame(spark, rows)), "vec_id", "n_links", "component_id", "kept")
    found = {r[0]: r[1:] for r in got}
    assert found[1] == (2, 1, True) and found[10] == (2, 1, False) and found[None] == (2, 1, False)
    assert found[11] == (1, 11, True) and found[12] == (1, 11, False)
    for i in (2, 3, 4, 5, 6, 7, 8, 9, 13):
        assert found[i] == (0, i, True)
    assert pq_dedup.near_duplicates(frame(spark, rows).limit(0)).collect() == []
    assert pq_dedup.near_duplicates(frame(spark, [(1, None, 1)])).count() == 1


def test_chain_and_copies(spark):
    """A crowd of copies and a chain of neighbours, longer than a block."""
    chain = [(i, [float(np.cos(0.3 * i / 2)), float(np.sin(0.3 * i / 2))], 0) for i in range(12)]
    crowd = [(100 + i, [5.0, -5.0], 1) for i in range(50)]
    rows = as_float(chain + crowd)
    got = by_id(pq_dedup.near_duplicates(frame(spark, rows), block=4), "vec_id", "n_links", "component_id", "kept")
    assert got == brute(rows)


def test_table_distances_are_distances_to_the_coded_vectors():
    rng = np.random.default_rng(0)
    units = pq_dedup._unit(rng.normal(size=(200, 16)))
    index = pq_dedup.fit_index(units, lists=4, subspaces=4, codes=8)
    lists, codes, errors = index.encode(units)
    one = int(lists[0])
    mine = np.flatnonzero(lists == one)
    coded = index.centres[one] + np.concatenate([b[codes[mine, m]] for m, b in enumerate(index.books)], axis=1)
    assert np.allclose(index.table_distances(units[:9], one, codes[mine]), pq_dedup.distances(units[:9], coded))
    assert np.allclose(errors[mine], np.linalg.norm(units[mine] - coded, axis=1))
