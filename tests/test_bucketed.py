"""Enrichments over staging tables laid out by visit."""

import pytest
from pyspark.sql import functions as F

from carelattice.harness import bindings
from carelattice.plans import bucketed, enrichment

MODELS = {"encounter_claim": ("encounter", "claim", "procedure"), "encounter_condition": ("encounter", "condition"),
          "medication_condition": ("medication_request", "condition")}


@pytest.fixture(scope="module")
def staged(spark, sf_dir):
    tables = {n: bindings.staged(spark, sf_dir, n) for n in ("encounter", "claim", "procedure", "condition", "medication_request")}
    # A third of all claims on one visit, rows without a visit or patient.
    number = F.substring("claim_id", 2, 20).cast("bigint")
    tables["claim"] = tables["claim"].withColumn("encounter_id", F.when(number % 3 == 0, "1").when(number % 50 == 1, None).otherwise(F.col("encounter_id")))
    tables["condition"] = tables["condition"].withColumn("patient_id", F.when(F.crc32(F.col("condition_id").cast("binary")) % 9 > 0, F.col("patient_id")))
    return tables


@pytest.fixture(scope="module")
def laid(staged):
    return bucketed.by_visit(staged, buckets=4)


@pytest.mark.parametrize("name", MODELS)
@pytest.mark.parametrize("rows_per_task", [50, 10**9])
def test_equal_to_the_plain_models(staged, laid, rows, name, rows_per_task):
    assert rows(bucketed.enriched(name, laid, rows_per_task)) == rows(enrichment.model(name, {n: staged[n] for n in MODELS[name]}))


@pytest.mark.parametrize("name", MODELS)
def test_buckets_are_joined_where_they_lie(spark, laid, name):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        calm, heavy = bucketed.parts(name, laid, rows_per_task=50)
        plan = calm._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
        assert heavy.count() > 300 or name != "encounter_claim"
    finally:
        spark.conf.set(key, before)


def test_other_models_are_refused(laid, spark, sf_dir):
    with pytest.raises(ValueError, match="by visit"):
        bucketed.parts("encounter_patient", {**laid, "patient": bindings.staged(spark, sf_dir, "patient")})
