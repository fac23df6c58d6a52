"""Cleaning models: raw text tables to typed staging tables.

Each is one projection without a shuffle. Text that fails a gate becomes NULL;
no row is dropped.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame

from carelattice.functions import (
    age_by_calendar_year,
    gate,
    gated_double,
    safe_double,
    safe_timestamp,
    strip_quotes,
    strip_trailing_digits,
    trimmed,
)

# What the text of a gated column looks like, and per table which columns
# there are and how each is cleaned.
SERVICE_TEXT = r"[a-zA-Z()/' ]+"
PERSON_NAME = r"(DR\.|Dr\.)?[a-zA-Z0-9()/' ]+"
OBSERVATION_CODE = r"[0-9]+-[0-9]+"
UNSIGNED_NUMBER = r"[0-9]+(\.[0-9]+)?"
UNIT_TEXT = r"[a-zA-Z%/{]+"


def _trim_all(*names: str) -> dict[str, Column]:
    return {n: trimmed(n) for n in names}


def _claim() -> dict[str, Column]:
    return {
        **_trim_all("claim_id", "patient_id", "encounter_id", "status", "claim_type"),
        "provider_name": strip_quotes("provider_name"),
        "payer": strip_quotes("payer"),
        "created_date": safe_timestamp(strip_quotes("created_date")),
        "total_amount": safe_double("total_amount"),
        **_trim_all("currency", "service_code"),
        "service_desc": gate("service_desc", SERVICE_TEXT),
    }


def _condition() -> dict[str, Column]:
    return {
        **_trim_all("condition_id", "patient_id", "encounter_id", "clinical_status",
                    "condition_code", "condition_system", "condition_name"),
        "onset_date": safe_timestamp(trimmed("onset_date")),
        "recorded_date": safe_timestamp(trimmed("recorded_date")),
    }


def _encounter() -> dict[str, Column]:
    return {
        **_trim_all("encounter_id", "patient_id", "status", "class_code", "encounter_type"),
        "start_date": safe_timestamp(trimmed("start_date")),
        "end_date": safe_timestamp(trimmed("end_date")),
        "provider_name": strip_quotes("provider_name"),
        "practitioner": gate("practitioner", PERSON_NAME),
    }


def _medication_request() -> dict[str, Column]:
    return {
        **_trim_all("medication_id", "patient_id", "encounter_id", "status", "medication_code"),
        "medication_name": strip_quotes("medication_name"),
        "authored_date": safe_timestamp(trimmed("authored_date")),
        "requester": gate("requester", PERSON_NAME),
    }


def _observation() -> dict[str, Column]:
    return {
        **_trim_all("observation_id", "patient_id", "encounter_id", "status"),
        "obs_code": gate("obs_code", OBSERVATION_CODE, tested=trimmed("obs_code")),
        "obs_system": trimmed("obs_system"),
        "obs_name": strip_quotes("obs_name"),
        "effective_date": safe_timestamp(strip_quotes("effective_date")),
        "value": gated_double("value", UNSIGNED_NUMBER),
        "unit": gate("unit", UNIT_TEXT, tested=trimmed("unit")),
    }


def _patient(as_of: date | str) -> dict[str, Column]:
    birth = safe_timestamp(trimmed("birth_date"))
    return {
        "patient_id": trimmed("patient_id"),
        "first_name": strip_trailing_digits("first_name"),
        "last_name": strip_trailing_digits("last_name"),
        "gender": trimmed("gender"),
        "birth_date": birth,
        "age": age_by_calendar_year(birth, as_of),
        **_trim_all("race", "ethnicity"),
        "birth_place": strip_quotes("birth_place"),
        **_trim_all("city", "state", "postal_code", "marital_status", "language"),
    }


def _procedure() -> dict[str, Column]:
    return {
        **_trim_all("procedure_id", "patient_id", "encounter_id", "status", "procedure_code"),
        "procedure_system": strip_quotes("procedure_system"),
        "procedure_name": strip_quotes("procedure_name"),
        "performed_start": safe_timestamp("performed_start"),
        "performed_end": safe_timestamp("performed_end"),
    }


_COLUMNS: dict[str, Callable[..., dict[str, Column]]] = {
    "claim": _claim,
    "condition": _condition,
    "encounter": _encounter,
    "medication_request": _medication_request,
    "observation": _observation,
    "patient": _patient,
    "procedure": _procedure,
}


def staged_columns(table: str, as_of: date | str) -> dict[str, Column]:
    """The columns of the staging model of ``table`` over its raw columns."""
    return _COLUMNS[table](as_of) if table == "patient" else _COLUMNS[table]()


def stage(raw: DataFrame, table: str, as_of: date | str) -> DataFrame:
    """The staging model of ``table``. ``as_of`` is the day ages refer to."""
    return raw.select(*[c.alias(n) for n, c in staged_columns(table, as_of).items()])
