"""Split routes give what the plain join and window give."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from carelattice.operators import skew
from carelattice.operators.enrich import JoinSpec, enrich, fan_out
from carelattice.operators.visits import with_visit_gap


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the left rows on key a, a third of the right rows on key b, NULL keys on both."""
    left = [("a" if i % 3 == 0 else None if i % 7 == 0 else f"k{i % 40}" if i % 5 else "b", i) for i in range(600)]
    right = [("b" if i % 3 == 0 else None if i % 11 == 0 else f"k{i % 25}" if i % 4 else "c", i) for i in range(500)]
    return (
        spark.createDataFrame(left, "k string, l int").repartition(5),
        spark.createDataFrame(right, "k string, r int").repartition(5),
    )


@pytest.mark.parametrize("rows_per_task", [1, 7, 100, 4_000_000])
def test_any_target_gives_the_left_join(sides, rows, rows_per_task):
    left, right = sides
    expected = rows(left.join(right, "k", "left"), "k", "l", "r")
    cells = skew.heavy_cells(left, [right], ["k"], rows_per_task)
    assert rows(skew.balanced_left_join(left, right, ["k"], cells), "k", "l", "r") == expected


def test_cells_follow_the_product(sides):
    left, right = sides
    n = {r["k"]: r["count"] for r in left.groupBy("k").count().collect()}
    m = {r["k"]: r["count"] for r in right.where("k is not null").groupBy("k").count().collect()}
    cells = {r["_heavy_k"]: (r["_a1"], r["_b1"]) for r in skew.heavy_cells(left, [right], ["k"], 50).collect()}
    assert set(cells) == {k for k in n if n[k] * max(1, m.get(k, 0)) > 50}
    for k, (a, b) in cells.items():
        assert n[k] / a * max(1, m.get(k, 1) / b) <= 50 * 1.01
    assert cells["a"][1] == 1 and cells["b"][0] > 1 and cells["b"][1] > 1
    assert skew.heavy_cells(left, [right], ["k"]).count() == 0


def test_cells_of_one_key_are_bounded(spark, sides, rows):
    """A key with many rows on both sides: cells, and so the rows repeated in them, do not grow with their product."""
    many = spark.range(3_000).select(F.lit("a").alias("k"))
    found = skew.heavy_cells(many, [many], ["k"], 1).first()
    assert 1_000 < found["_a1"] * found["_b1"] <= 1.1 * skew.MOST_CELLS
    left, right = sides
    cells = skew.heavy_cells(left, [right], ["k"], 1, most_cells=6)
    assert max(r["_a1"] * r["_b1"] for r in cells.collect()) <= 12
    assert rows(skew.balanced_left_join(left, right, ["k"], cells), "k", "l", "r") == rows(left.join(right, "k", "left"), "k", "l", "r")


def test_enrich_chain_with_heavy_keys(sides, rows):
    left, right = sides[0].where("l < 90"), sides[1].where("r < 80")
    third = right.select("k", (F.col("r") * 2).alias("s")).where("s % 3 = 0")
    specs = [JoinSpec(right, ("k",), ("r",)), JoinSpec(third, ("k",), ("s",), {"s": "t"})]
    expected = left.join(right, "k", "left").join(third.withColumnRenamed("s", "t"), "k", "left")
    kept = {("k",): skew.heavy_cells(left, [right, third], ["k"], 20)}
    for options in ({}, {"rows_per_task": 5}, {"cells": kept}):
        found = enrich(left, specs, **options)
        assert found.columns == ["k", "l", "r", "t"]
        assert rows(found) == rows(expected, "k", "l", "r", "t")
    counted = fan_out(left, specs)
    assert rows(counted, "k", "l", "_rows") == rows(expected.groupBy("k", "l").count())


def test_plan_splits_and_forms_no_job(spark, sides):
    left, right = sides
    plan = enrich(left, [JoinSpec(right, ("k",), ("r",))])._jdf.queryExecution().executedPlan().toString()
    assert "_i" in plan and "_j" in plan and "BroadcastExchange" in plan


def test_enrich_refuses_duplicate_names(sides):
    left, right = sides
    with pytest.raises(ValueError, match="duplicate output columns: l"):
        enrich(left, [JoinSpec(right, ("k",), ("r",), {"r": "l"})])


def test_repeat_rows(spark, rows):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 25)], "k string, n bigint")
    found = skew.repeat_rows(df, "n", chunk=10)
    assert rows(found.groupBy("k").count()) == [("b", 1), ("c", 25)]


def test_visit_gap_of_heavy_patients(spark, rows):
    rng = random.Random(7)
    data = []
    for i in range(900):
        patient = "hot" if i % 3 == 0 else None if i % 10 == 0 else f"p{rng.randrange(30)}"
        start = None if i % 50 == 0 else datetime(2020, 1, 1) + timedelta(hours=rng.randrange(24 * 60))
        # Some visits come twice, one often.
        data += [(patient, f"e{i:04d}", start)] * (1 + (i % 13 == 0) + 40 * (i in (3, 100)))
    visits = spark.createDataFrame(data, "p string, e string, s timestamp_ntz").repartition(4)
    plain = with_visit_gap(visits, "p", "s", ["e"])
    for rows_per_task in (1, 50):
        assert rows(with_visit_gap(visits, "p", "s", ["e"], rows_per_task=rows_per_task)) == rows(plain)

    # Brute force over the rows in order.
    last, expected = {}, []
    for p, e, s in sorted(data, key=lambda r: (r[2] is None, r[2] or datetime.max, r[1])):
        previous = last.get(p, "none")
        known = previous != "none" and previous is not None and s is not None
        expected.append((p, e, s, (s.date() - previous.date()).days if known else None))
        last[p] = s
    assert rows(plain) == sorted(expected, key=repr)


def test_days_beyond_midnight(spark, rows):
    visits = spark.createDataFrame(
        [("p", "1", datetime(2024, 1, 1, 23, 50)), ("p", "2", datetime(2024, 1, 2, 0, 10))],
        "p string, e string, s timestamp_ntz",
    )
    assert rows(with_visit_gap(visits, "p", "s", ["e"]), "e", "days_since_last_visit") == [("1", None), ("2", 1)]
