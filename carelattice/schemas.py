"""The seven flat tables: columns, keys, watermarks, and the FHIR shapes they come from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    """One raw table. Every raw column is text."""

    name: str
    resource_type: str
    description: str
    key: str
    watermark: str | None
    columns: tuple[str, ...]

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.columns])


def _spec(name, resource_type, description, key, watermark, columns) -> TableSpec:
    return TableSpec(name, resource_type, description, key, watermark, columns)


# Table names, columns, merge keys and watermark columns.
TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in [
        _spec("patient", "Patient", "Patient demographics", "patient_id", None,
              ("patient_id", "first_name", "last_name", "gender", "birth_date", "race", "ethnicity",
               "birth_place", "city", "state", "postal_code", "country", "marital_status", "language")),
        _spec("encounter", "Encounter", "Clinical encounters", "encounter_id", "start_date",
              ("encounter_id", "patient_id", "status", "class_code", "encounter_type", "start_date",
               "end_date", "provider_name", "practitioner")),
        _spec("claim", "Claim", "Insurance claims", "claim_id", "created_date",
              ("claim_id", "patient_id", "encounter_id", "status", "claim_type", "created_date",
               "provider_name", "payer", "total_amount", "currency", "service_code", "service_desc")),
        _spec("condition", "Condition", "Diagnosed conditions", "condition_id", "recorded_date",
              ("condition_id", "patient_id", "encounter_id", "clinical_status", "condition_code",
               "condition_system", "condition_name", "onset_date", "recorded_date")),
        _spec("procedure", "Procedure", "Clinical procedures", "procedure_id", "performed_start",
              ("procedure_id", "patient_id", "encounter_id", "status", "procedure_code",
               "procedure_system", "procedure_name", "performed_start", "performed_end")),
        _spec("observation", "Observation", "Vitals and laboratory results", "observation_id",
              "effective_date",
              ("observation_id", "patient_id", "encounter_id", "status", "obs_code", "obs_system",
               "obs_name", "effective_date", "value", "unit")),
        _spec("medication_request", "MedicationRequest", "Medication requests", "medication_id",
              "authored_date",
              ("medication_id", "patient_id", "encounter_id", "status", "intent", "medication_code",
               "medication_name", "authored_date", "requester")),
    ]
}

# The fields read from each resource, as DDL. Numbers are kept as they are written.
RESOURCE_DDL: dict[str, str] = {
    "Patient": (
        "id string, gender string, birthDate string, "
        "name array<struct<given:array<string>,family:string>>, "
        "address array<struct<city:string,state:string,postalCode:string,country:string>>, "
        "maritalStatus struct<text:string>, "
        "communication array<struct<language:struct<text:string>>>, "
        "extension array<struct<url:string,valueAddress:struct<city:string,state:string>,"
        "extension:array<struct<url:string,valueString:string>>>>"
    ),
    "Encounter": (
        "id string, status string, class struct<code:string>, type array<struct<text:string>>, "
        "period struct<start:string,end:string>, "
        "participant array<struct<individual:struct<display:string>>>, "
        "serviceProvider struct<display:string>"
    ),
    "Claim": (
        "id string, status string, created string, type struct<coding:array<struct<code:string>>>, "
        "provider struct<display:string>, insurance array<struct<coverage:struct<display:string>>>, "
        "total struct<value:variant,currency:string>, "
        "item array<struct<encounter:array<struct<reference:string>>,"
        "productOrService:struct<text:string,coding:array<struct<code:string>>>>>"
    ),
    "Condition": (
        "id string, clinicalStatus struct<coding:array<struct<code:string>>>, "
        "code struct<text:string,coding:array<struct<code:string,system:string>>>, "
        "encounter struct<reference:string>, onsetDateTime string, recordedDate string"
    ),
    "Procedure": (
        "id string, status string, "
        "code struct<text:string,coding:array<struct<code:string,system:string>>>, "
        "encounter struct<reference:string>, performedPeriod struct<start:string,end:string>"
    ),
    "Observation": (
        "id string, status string, "
        "code struct<text:string,coding:array<struct<code:string,system:string>>>, "
        "encounter struct<reference:string>, effectiveDateTime string, "
        "valueQuantity struct<value:variant,unit:string>, valueCodeableConcept struct<text:string>"
    ),
    "MedicationRequest": (
        "id string, status string, intent string, "
        "medicationCodeableConcept struct<text:string,coding:array<struct<code:string>>>, "
        "encounter struct<reference:string>, authoredOn string, requester struct<display:string>"
    ),
}
