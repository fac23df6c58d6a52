"""The declared assertions on raw, staging and enriched tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelattice.operators.enrich import ROWS, fan_out
from carelattice.operators.quality import Check, Scan
from carelattice.plans import enrichment
from carelattice.plans.staging import stage, staged_columns

# Accepted codes, checked with a warning only.
CLAIM_STATUS = ("ACTIVE", "CANCELLED", "DRAFT", "ENTERED-IN-ERROR")
ENCOUNTER_CLASS = ("AMB", "IMP", "EMER", "VR", "HH")
PATIENT_GENDER = ("male", "female", "other", "unknown")


def _present_key(table: str, key: str) -> list[Check]:
    return [Check(table, key, "not_null"), Check(table, key, "unique")]


def _present(table: str, *columns: str) -> list[Check]:
    return [Check(table, c, "not_null") for c in columns]


# Which columns are asserted.
RAW_CHECKS = [
    *_present_key("raw_claim", "claim_id"), *_present("raw_claim", "created_date"),
    *_present_key("raw_encounter", "encounter_id"), *_present("raw_encounter", "start_date"),
    *_present_key("raw_patient", "patient_id"),
    *_present_key("raw_condition", "condition_id"),
    *_present_key("raw_medication_request", "medication_id"),
    *_present_key("raw_procedure", "procedure_id"),
    *_present_key("raw_observation", "observation_id"),
]

STAGING_CHECKS = [
    *_present_key("claim", "claim_id"),
    *_present("claim", "patient_id", "encounter_id", "created_date"),
    Check("claim", "status", "accepted_values", "warn", CLAIM_STATUS),
    *_present_key("encounter", "encounter_id"), *_present("encounter", "patient_id", "start_date"),
    Check("encounter", "class_code", "accepted_values", "warn", ENCOUNTER_CLASS),
    *_present_key("patient", "patient_id"), *_present("patient", "birth_date"),
    Check("patient", "gender", "accepted_values", "warn", PATIENT_GENDER),
    *_present_key("condition", "condition_id"),
    *_present("condition", "patient_id", "recorded_date"),
    *_present_key("medication_request", "medication_id"),
    *_present("medication_request", "patient_id", "authored_date"),
    *_present_key("procedure", "procedure_id"),
    *_present("procedure", "patient_id", "performed_start"),
    *_present_key("observation", "observation_id"),
    *_present("observation", "patient_id", "effective_date"),
]

# Fan-out makes two of these fail by construction: an encounter repeats per
# claim and procedure, a request per condition.
ENRICHED_CHECKS = [
    *_present_key("condition_patient", "condition_id"), *_present("condition_patient", "patient_id"),
    *_present_key("encounter_claim", "encounter_id"), *_present("encounter_claim", "patient_id"),
    *_present("encounter_condition", "encounter_id", "patient_id"),
    *_present("encounter_patient", "encounter_id", "patient_id"),
    *_present_key("medication_condition", "medication_id"),
    *_present("medication_condition", "patient_id"),
]

ALL_CHECKS = RAW_CHECKS + STAGING_CHECKS + ENRICHED_CHECKS

# References between staging tables.
RELATIONSHIPS = [
    Check(child, column, "relationship", parent=parent, parent_column=column)
    for child, column, parent in [
        ("condition", "patient_id", "patient"),
        ("encounter", "patient_id", "patient"),
        ("claim", "encounter_id", "encounter"),
        ("procedure", "encounter_id", "encounter"),
        ("condition", "encounter_id", "encounter"),
        ("medication_request", "encounter_id", "encounter"),
        ("medication_request", "patient_id", "patient"),
    ]
]


def of_kind(checks: list[Check], kind: str) -> list[Check]:
    return [c for c in checks if c.kind == kind]


# Checks that fail on any data, because these keys repeat in the model by construction.
FAIL_BY_CONSTRUCTION = (
    ("encounter_claim", "encounter_id", "unique"),
    ("medication_condition", "medication_id", "unique"),
)


def _with_models(df: DataFrame, name: str, columns: Mapping[str, Column], staged: Mapping[str, DataFrame],
                 tables: dict[str, Mapping[str, Column]]) -> Scan:
    """A scan of ``df`` that also stands for the enriched models which start from ``name``.

    Only base columns of the models are checked, so instead of forming a model each
    base row gets the number of rows the model makes of it.
    """
    rows = {}
    for model, specs in enrichment.fan_outs(name, staged).items():
        df = fan_out(df, specs).withColumnRenamed(ROWS, f"_rows_{model}")
        tables[model], rows[model] = columns, f"_rows_{model}"
    return Scan(df, tables, rows)


def source_scans(raw: Mapping[str, DataFrame], as_of: date | str) -> list[Scan]:
    """Raw, staged and enriched tables as one scan per source."""
    staged = {name: stage(df, name, as_of) for name, df in raw.items()}
    scans = []
    for name, df in raw.items():
        cleaned = staged_columns(name, as_of)
        side = df.select(*[F.col(c).alias(f"_raw_{c}") for c in df.columns], *[c.alias(n) for n, c in cleaned.items()])
        columns = {c: F.col(c) for c in cleaned}
        tables = {f"raw_{name}": {c: F.col(f"_raw_{c}") for c in df.columns}, name: columns}
        scans.append(_with_models(side, name, columns, staged, tables))
    return scans


def layer_scans(raw: Mapping[str, DataFrame], staged: Mapping[str, DataFrame]) -> list[Scan]:
    """Raw tables, and staged tables kept apart from them with the enriched models over them."""
    scans = [Scan(df, {f"raw_{name}": {c: F.col(c) for c in df.columns}}) for name, df in raw.items()]
    for name, df in staged.items():
        columns = {c: F.col(c) for c in df.columns}
        scans.append(_with_models(df, name, columns, staged, {name: columns}))
    return scans
