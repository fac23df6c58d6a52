"""Marts against brute force in plain Python, and the shape of their plans."""

import random
import statistics
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest

from carelattice.operators.histogram import describe, histogram
from carelattice.harness import bindings, catalog
from carelattice.plans import marts
from pyspark.sql import functions as F


def test_describe_against_statistics(spark):
    rng = random.Random(3)
    data = [(f"g{i % 4}" if i % 9 else None, rng.choice([None, *range(-5, 40)])) for i in range(500)]
    data += [("single", 7), ("empty", None), ("huge", 4_000_000_000), ("huge", 4_000_000_001)]
    df = spark.createDataFrame(data, "g string, v bigint")
    groups = defaultdict(list)
    for g, v in data:
        groups[g].append(v)
    for order, pick in (("desc", lambda c: -c), ("asc", lambda c: c)):
        found = {r["g"]: r for r in describe(histogram(df, ["g"], F.col("v")), ["g"], mode_order=order).collect()}
        assert set(found) == set(groups)
        for g, values in groups.items():
            known, r = [v for v in values if v is not None], found[g]
            assert r["total"] == len(values)
            if known:
                assert r["mean"] == pytest.approx(statistics.mean(known))
                assert r["median"] == statistics.median(known)
                assert (r["min"], r["max"]) == (min(known), max(known))
            if len(known) > 1:
                assert r["stddev"] == pytest.approx(statistics.stdev(known))
            else:
                assert r["stddev"] is None
            counts = Counter(values)
            best = min(counts, key=lambda v: (pick(counts[v]), v is None, v or 0))
            assert r["mode"] == (None if g is None else best)


def test_weighted_histogram_equals_repeated_rows(spark, rows):
    df = spark.createDataFrame([("a", 1, 3), ("a", 2, 1), ("a", 2, 4), ("a", None, 2)], "g string, v bigint, w bigint")
    repeated = df.select("g", "v", F.explode(F.sequence(F.lit(1), F.col("w").cast("int"))))
    weighted = describe(histogram(df, ["g"], F.col("v"), weight=F.col("w")), ["g"])
    assert rows(weighted) == rows(describe(histogram(repeated, ["g"], F.col("v")), ["g"]))


def clinic(spark):
    """A small clinic where one patient and one encounter own a third of the rows, with NULL keys."""
    rng = random.Random(11)
    def visit(i):
        return "E0" if i % 3 == 0 else None if i % 17 == 0 else f"E{rng.randrange(1, 40)}"
    def patient(e):
        return None if e is None else "P0" if int(e[1:]) % 3 == 0 else f"P{int(e[1:]) % 7}"
    encounters = []
    for i in range(40):
        e = f"E{i}"
        start = datetime(2024, 1, 1) + timedelta(days=rng.randrange(90), hours=rng.randrange(24))
        encounters.append((e, patient(e), f"T{i % 3}", None if i == 5 else start, start + timedelta(minutes=rng.randrange(400))))
    conditions = [(e := visit(i), patient(e), None if i % 23 == 0 else f"C{i % 5}") for i in range(200)]
    medications = [(e := visit(i), patient(e), f"M{i % 6}") for i in range(150)]
    claims = [(f"E{i % 12}",) for i in range(30)]
    procedures = [(f"E{i % 9}",) for i in range(20)]
    make = spark.createDataFrame
    return {
        "encounters": encounters, "conditions": conditions, "medications": medications,
        "claims": claims, "procedures": procedures,
        "encounter": make(encounters, "encounter_id string, patient_id string, encounter_type string, "
                                      "start_date timestamp_ntz, end_date timestamp_ntz"),
        "condition": make(conditions, "encounter_id string, patient_id string, condition_name string"),
        "medication": make(medications, "encounter_id string, patient_id string, medication_name string"),
        "claim": make(claims, "encounter_id string"),
        "procedure": make(procedures, "encounter_id string"),
    }


def test_medication_patterns_brute_force(spark, rows):
    c = clinic(spark)
    total, patients = Counter(), defaultdict(set)
    for e, p, m in c["medications"]:
        partners = [n for e2, p2, n in c["conditions"] if e is not None and p is not None and (e2, p2) == (e, p)]
        for name in partners or [None]:
            total[m, name] += 1
            patients[m, name].add(p)
    expected = [
        (m, n, len(patients[m, n] - {None}), t, 1 + sum(t2 > t for (_, n2), t2 in total.items() if n2 == n))
        for (m, n), t in total.items()
    ]
    found = marts.medication_patterns(c["medication"], c["condition"])
    assert rows(found, "medication_name", "condition_name", "patients_count", "total_prescriptions", "rn") == sorted(expected, key=repr)


def test_medication_patterns_pairs_in_more_tasks(spark, rows, monkeypatch):
    c = clinic(spark)
    before = marts.medication_patterns(c["medication"], c["condition"])
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = c["medication"].count() + c["condition"].count()
    monkeypatch.setattr(marts, "ROWS_PER_PAIRING_TASK", -(-n // (most + 3)))
    after = marts.medication_patterns(c["medication"], c["condition"])
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (before, after)]
    assert [p.count("REPARTITION_BY_NUM") for p in plans] == [0, 2]
    assert rows(after) == rows(before)


def test_length_of_stay_brute_force(spark):
    c = clinic(spark)
    stays = defaultdict(list)
    for e, p, kind, start, end in c["encounters"]:
        minutes = None
        if start is not None:
            minutes = int((end.replace(second=0) - start.replace(second=0)).total_seconds() // 60)
        names = [n for e2, p2, n in c["conditions"] if (e2, p2) == (e, p)] or [None]
        for n in names:
            stays[kind, n].append(minutes)
    found = {(r["encounter_type"], r["condition_name"]): r
             for r in marts.length_of_stay(c["encounter"], c["condition"], with_total=True).collect()}
    assert set(found) == set(stays)
    for key, values in stays.items():
        known = [v for v in values if v is not None]
        assert found[key]["total_encounters"] == len(values)
        assert found[key]["median_stay"] == statistics.median(known)
        assert found[key]["mean_stay"] == pytest.approx(statistics.mean(known))
        if len(known) > 1:
            assert found[key]["stddev_stay"] == pytest.approx(statistics.stdev(known), abs=0.006)


def test_readmissions_per_billed_row_brute_force(spark, rows):
    c = clinic(spark)
    claims, procedures = Counter(e for (e,) in c["claims"]), Counter(e for (e,) in c["procedures"])
    by_patient = defaultdict(list)
    for e, p, kind, start, _ in c["encounters"]:
        for _ in range(max(1, claims[e]) * max(1, procedures[e])):
            by_patient[p].append((start, e, kind))
    expected = []
    for p, visits in by_patient.items():
        visits.sort(key=lambda v: (v[0] is None, v[0] or datetime.max, v[1]))
        for before, now in zip(visits, visits[1:]):
            if before[0] and now[0] and (now[0].date() - before[0].date()).days < 30:
                expected.append((p, now[1], now[2], now[0], (now[0].date() - before[0].date()).days))
    for options in ({}, {"rows_per_task": 1}):
        found = marts.readmissions_per_billed_row(c["encounter"], c["claim"], c["procedure"], **options)
        assert rows(found) == sorted(expected, key=repr)


def test_prevalence_brute_force(spark, rows):
    patients = [("p1", 30, "f", "r"), ("p2", 30, "f", "r"), ("p2", 30, "f", "r"), ("p3", 30, None, "r"),
                ("p4", None, "m", "r"), ("p5", 80, "m", "r"), ("p6", 31, "f", "r")]
    conditions = [("p1", "A"), ("p1", "A"), ("p1", "B"), ("p2", "A"), ("p2", None), ("p3", "A"), ("p4", "A"),
                  ("p5", "B"), (None, "A"), ("p9", "A")]
    patient = spark.createDataFrame(patients, "patient_id string, age int, gender string, race string")
    condition = spark.createDataFrame(conditions, "patient_id string, condition_name string")
    expected = {("A", "18-34", "f", 2): 2, ("B", "18-34", "f", 1): 2, (None, "18-34", "f", 1): 2,
                ("A", "75+", "m", 1): 2, ("B", "75+", "m", 1): 2}
    for denominator, more in (("conditioned", 0), ("population", 1)):
        found = marts.prevalence(condition, patient, denominator=denominator)
        assert rows(found) == sorted(
            ((n, a, g, "r", k, t + (more if g == "f" else 0), round(100 * k / (t + (more if g == "f" else 0)), 2))
             for (n, a, g, k), t in expected.items()), key=repr)


def test_prevalence_is_a_share(spark, sf_dir):
    patient, condition = (bindings.staged(spark, sf_dir, n) for n in ("patient", "condition"))
    worst = marts.prevalence(condition, patient).agg(
        F.min("prevalence_percentage").alias("low"), F.max("prevalence_percentage").alias("high")).first()
    assert 0 < worst["low"] and worst["high"] <= 100


def test_presentation_order(spark, sf_dir):
    mart = catalog.QUERIES["medication_patterns"](spark, sf_dir)
    ranks = [r["rn"] for r in marts.present(mart, "medication_patterns").collect()]
    assert ranks == sorted(ranks) and ranks[0] == 1


@pytest.mark.parametrize("name", ["readmissions", "prevalence", "length_of_stay", "medication_patterns",
                                  "enrich_encounter_claim", "fhir_patient", "incremental_merge", "stage_observation"])
def test_plan_shape(spark, sf_dir, name):
    plan = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Exchange SinglePartition"):
        assert unwanted not in plan


def test_scan_reads_only_used_columns(spark, sf_dir):
    plan = catalog.QUERIES["readmissions"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert all("o_totalprice" not in s and "o_orderstatus" not in s for s in scans)


def test_places_are_not_numbered_by_one_task(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    placed = catalog._placed(rows.repartitionByRange(5, "v").sortWithinPartitions("v"))
    assert [(r["v"], r["place"]) for r in placed.orderBy("v").collect()] == [(i, i + 1) for i in range(1000)]
    plan = catalog.QUERIES["present_prevalence"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "row_number" not in plan
