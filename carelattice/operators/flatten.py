"""One projection per resource type: nested FHIR JSON to a flat text row.

Input rows hold ``resource`` (one resource as a VARIANT, as JSON text, or read into
the declared fields already) and ``bundle_patient_id``. The declared fields are taken out at once, the rest is path
access, evaluated in the JVM. Missing elements give NULL, and so does an empty array.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelattice.schemas import RESOURCE_DDL, TABLES


def reference_id(reference: Column) -> Column:
    """The id a reference ends with: the text after its last colon."""
    return F.element_at(F.split(reference, ":"), -1)


def _first(items: Column) -> Column:
    return F.get(items, F.lit(0))


def _last(items: Column) -> Column:
    return F.try_element_at(items, F.lit(-1))


def _number_text(value: Column) -> Column:
    """A JSON number as text: with a decimal point where it was written with one."""
    written_with_point = F.schema_of_variant(value).startswith("DECIMAL")
    return F.when(written_with_point, F.try_variant_get(value, "$", "double").cast("string")).otherwise(
        F.try_variant_get(value, "$", "string"))


def _blank_to_null(c: Column) -> Column:
    """Empty text is absent, as it is after a pass through CSV."""
    return F.nullif(c, F.lit(""))


# What the URL of a patient extension contains.
RACE_URL = "us-core-race"
ETHNICITY_URL = "us-core-ethnicity"
BIRTH_PLACE_URL = "birthPlace"


def _extension_text(extensions: Column, matches: Callable[[Column], Column]) -> Column:
    """Text of the last ``text`` sub-extension among the matching extensions."""
    nested = F.flatten(
        F.transform(
            F.filter(extensions, lambda e: matches(e["url"])),
            lambda e: F.filter(F.coalesce(e["extension"], F.array()), lambda s: s["url"] == "text"),
        )
    )
    return _last(nested)["valueString"]


# The path each column is read from, per resource type.


def _patient(r: Column) -> dict[str, Column]:
    race = lambda u: u.contains(RACE_URL)
    ethnicity = lambda u: u.contains(ETHNICITY_URL) & ~race(u)
    place = lambda u: u.contains(BIRTH_PLACE_URL) & ~u.contains(RACE_URL) & ~u.contains(ETHNICITY_URL)
    ext = r["extension"]
    born = _last(F.filter(ext, lambda e: place(e["url"])))
    name, address = _first(r["name"]), _first(r["address"])
    return {
        "patient_id": r["id"],
        "first_name": F.array_join(name["given"], " "),
        "last_name": name["family"],
        "gender": r["gender"],
        "birth_date": r["birthDate"],
        "race": _extension_text(ext, race),
        "ethnicity": _extension_text(ext, ethnicity),
        "birth_place": F.when(
            born.isNotNull(),
            F.concat(
                F.coalesce(born["valueAddress"]["city"], F.lit("")),
                F.lit(", "),
                F.coalesce(born["valueAddress"]["state"], F.lit("")),
            ),
        ),
        "city": address["city"],
        "state": address["state"],
        "postal_code": address["postalCode"],
        "country": address["country"],
        "marital_status": r["maritalStatus"]["text"],
        "language": _first(r["communication"])["language"]["text"],
    }


def _encounter(r: Column) -> dict[str, Column]:
    return {
        "encounter_id": r["id"],
        "status": r["status"],
        "class_code": r["class"]["code"],
        "encounter_type": _first(r["type"])["text"],
        "start_date": r["period"]["start"],
        "end_date": r["period"]["end"],
        "provider_name": r["serviceProvider"]["display"],
        "practitioner": _first(r["participant"])["individual"]["display"],
    }


def _claim(r: Column) -> dict[str, Column]:
    item = _first(r["item"])
    service = item["productOrService"]
    return {
        "claim_id": r["id"],
        "encounter_id": reference_id(_last(item["encounter"])["reference"]),
        "status": r["status"],
        "claim_type": _first(r["type"]["coding"])["code"],
        "created_date": r["created"],
        "provider_name": r["provider"]["display"],
        "payer": _first(r["insurance"])["coverage"]["display"],
        "total_amount": _number_text(r["total"]["value"]),
        "currency": r["total"]["currency"],
        "service_code": _first(service["coding"])["code"],
        "service_desc": service["text"],
    }


def _condition(r: Column) -> dict[str, Column]:
    coding = _first(r["code"]["coding"])
    return {
        "condition_id": r["id"],
        "encounter_id": reference_id(r["encounter"]["reference"]),
        "clinical_status": _first(r["clinicalStatus"]["coding"])["code"],
        "condition_code": coding["code"],
        "condition_system": coding["system"],
        "condition_name": r["code"]["text"],
        "onset_date": r["onsetDateTime"],
        "recorded_date": r["recordedDate"],
    }


def _procedure(r: Column) -> dict[str, Column]:
    coding = _first(r["code"]["coding"])
    return {
        "procedure_id": r["id"],
        "encounter_id": reference_id(r["encounter"]["reference"]),
        "status": r["status"],
        "procedure_code": coding["code"],
        "procedure_system": coding["system"],
        "procedure_name": r["code"]["text"],
        "performed_start": r["performedPeriod"]["start"],
        "performed_end": r["performedPeriod"]["end"],
    }


def _observation(r: Column, zero_as_missing: bool = False) -> dict[str, Column]:
    coding = _first(r["code"]["coding"])
    quantity = _number_text(r["valueQuantity"]["value"])
    if zero_as_missing:
        quantity = F.when(quantity.try_cast("double") != 0, quantity)
    return {
        "observation_id": r["id"],
        "encounter_id": reference_id(r["encounter"]["reference"]),
        "status": r["status"],
        "obs_code": coding["code"],
        "obs_system": coding["system"],
        "obs_name": r["code"]["text"],
        "effective_date": r["effectiveDateTime"],
        "value": F.coalesce(_blank_to_null(quantity), r["valueCodeableConcept"]["text"]),
        "unit": r["valueQuantity"]["unit"],
    }


def _medication_request(r: Column) -> dict[str, Column]:
    concept = r["medicationCodeableConcept"]
    return {
        "medication_id": r["id"],
        "encounter_id": reference_id(r["encounter"]["reference"]),
        "status": r["status"],
        "intent": r["intent"],
        "medication_code": _first(concept["coding"])["code"],
        "medication_name": concept["text"],
        "authored_date": r["authoredOn"],
        "requester": r["requester"]["display"],
    }


_PATHS: dict[str, Callable[..., dict[str, Column]]] = {
    "patient": _patient,
    "encounter": _encounter,
    "claim": _claim,
    "condition": _condition,
    "procedure": _procedure,
    "observation": _observation,
    "medication_request": _medication_request,
}


def flatten(resources: DataFrame, table: str, **options: bool) -> DataFrame:
    """The raw rows of ``table`` from an exploded resource DataFrame.

    Rows of other types are filtered out. Every non-patient row carries the id
    of its bundle's first patient; the resource's own subject is not consulted.
    """
    spec = TABLES[table]
    fields = RESOURCE_DDL[spec.resource_type]
    kind = resources.schema["resource"].dataType.typeName()
    if kind == "struct":
        read = F.col("resource")
    elif kind == "variant":
        read = F.try_variant_get("resource", "$", T.StructType.fromDDL(fields).simpleString())
    else:
        read = F.from_json("resource", fields)
    parsed = resources.where(F.col("resource_type") == spec.resource_type).select("bundle_patient_id", read.alias("r"))
    columns = _PATHS[table](F.col("r"), **options)
    columns.setdefault("patient_id", F.col("bundle_patient_id"))
    return parsed.select(*[_blank_to_null(columns[c]).alias(c) for c in spec.columns])
