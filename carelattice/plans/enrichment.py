"""Inlined enrichment models: LEFT JOIN chains over staging tables.

They are functions from DataFrames to a DataFrame, so Catalyst inlines them and
prunes the columns a consumer does not read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from carelattice.operators.enrich import JoinSpec, enrich

# The columns each joined table contributes.
PERSON = ("first_name", "last_name", "gender", "age", "race", "ethnicity", "birth_date")
PERSON_AND_PLACE = (*PERSON, "city", "postal_code", "marital_status")
CLAIM = ("claim_id", "status", "claim_type", "payer", "total_amount", "service_code",
         "service_desc", "created_date")
PROCEDURE = ("procedure_code", "procedure_name", "procedure_system", "performed_start",
             "performed_end")
DIAGNOSIS = ("condition_code", "condition_name", "condition_system", "clinical_status")
DATED_DIAGNOSIS = (*DIAGNOSIS, "onset_date", "recorded_date")


def _specs(s: Mapping[str, DataFrame]) -> dict[str, tuple[str, list[JoinSpec]]]:
    """Per model the table it starts from and what is joined to it."""
    def join(table: str, on: tuple[str, ...], columns: tuple[str, ...], **rename: str) -> JoinSpec:
        return JoinSpec(s[table], on, columns, rename)

    visit, both = ("encounter_id",), ("encounter_id", "patient_id")
    wanted = {
        "condition_patient": ("condition", [("patient", ("patient_id",), PERSON, {})]),
        "encounter_claim": ("encounter", [("claim", visit, CLAIM, {"status": "claim_status"}),
                                          ("procedure", visit, PROCEDURE, {})]),
        "encounter_condition": ("encounter", [("condition", both, DATED_DIAGNOSIS, {})]),
        "encounter_patient": ("encounter", [("patient", ("patient_id",), PERSON_AND_PLACE, {})]),
        "medication_condition": ("medication_request", [("condition", both, DIAGNOSIS, {})]),
    }
    return {
        name: (base, [join(t, on, columns, **rename) for t, on, columns, rename in joins])
        for name, (base, joins) in wanted.items()
        if base in s and all(t in s for t, *_ in joins)
    }


def joins(name: str, staged: Mapping[str, DataFrame]) -> tuple[DataFrame, list[JoinSpec]]:
    """The table a model starts from and what is joined to it."""
    base, specs = _specs(staged)[name]
    return staged[base], specs


def model(name: str, staged: Mapping[str, DataFrame], **options) -> DataFrame:
    """One enriched model over the staged tables it needs."""
    base, specs = joins(name, staged)
    return enrich(base, specs, **options)


def fan_outs(base: str, staged: Mapping[str, DataFrame]) -> dict[str, list[JoinSpec]]:
    """The models that start from ``base``, with what they join."""
    return {name: specs for name, (start, specs) in _specs(staged).items() if start == base}


def condition_patient(condition: DataFrame, patient: DataFrame, **options) -> DataFrame:
    """Every condition with its patient's demographics."""
    return model("condition_patient", {"condition": condition, "patient": patient}, **options)


def encounter_claim(encounter: DataFrame, claim: DataFrame, procedure: DataFrame, **options) -> DataFrame:
    """Every encounter with its claims and procedures, one row per combination.

    The claim's own status is called ``claim_status``.
    """
    tables = {"encounter": encounter, "claim": claim, "procedure": procedure}
    return model("encounter_claim", tables, **options)


def encounter_condition(encounter: DataFrame, condition: DataFrame, **options) -> DataFrame:
    """Every encounter with the conditions diagnosed in it."""
    return model("encounter_condition", {"encounter": encounter, "condition": condition}, **options)


def encounter_patient(encounter: DataFrame, patient: DataFrame, **options) -> DataFrame:
    """Every encounter with its patient's demographics and place of living."""
    return model("encounter_patient", {"encounter": encounter, "patient": patient}, **options)


def medication_condition(medication: DataFrame, condition: DataFrame, **options) -> DataFrame:
    """Every medication request with the conditions of the same encounter and patient."""
    tables = {"medication_request": medication, "condition": condition}
    return model("medication_condition", tables, **options)
