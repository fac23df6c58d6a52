"""FHIR bundle text rendered from the raw tables, as input for the flattener.

One bundle per row: an entry of a type nobody reads, the patient, for other
types a second patient that must be ignored, and the resource itself.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CODING = "array(named_struct('code', {code}, 'system', {system}))"


def _code(code: str, system: str, text: str) -> str:
    return f"named_struct('text', {text}, 'coding', {_CODING.format(code=code, system=system)})"


_ENCOUNTER_REF = "named_struct('reference', concat('urn:uuid:', encounter_id))"

# Fields of each resource as SQL over the raw columns.
_RESOURCE: dict[str, dict[str, str]] = {
    "patient": {
        "resourceType": "'Patient'",
        "id": "patient_id",
        "gender": "gender",
        "birthDate": "birth_date",
        "name": "array(named_struct('given', split(first_name, ' '), 'family', last_name), "
                "named_struct('given', array('Nick'), 'family', 'Name'))",
        "address": "array(named_struct('city', city, 'state', state, 'postalCode', postal_code, 'country', country))",
        "maritalStatus": "named_struct('text', marital_status)",
        "communication": "array(named_struct('language', named_struct('text', language)))",
        "extension": """array(
            named_struct('url', 'http://hl7.org/fhir/us/core/StructureDefinition/us-core-race',
              'extension', array(named_struct('url', 'text', 'valueString', 'superseded')),
              'valueAddress', cast(null as struct<city:string,state:string>)),
            named_struct('url', 'http://hl7.org/fhir/us/core/StructureDefinition/us-core-race',
              'extension', array(named_struct('url', 'text', 'valueString', race),
                                 named_struct('url', 'ombCategory', 'valueString', 'code')),
              'valueAddress', cast(null as struct<city:string,state:string>)),
            named_struct('url', 'http://hl7.org/fhir/us/core/StructureDefinition/us-core-ethnicity',
              'extension', array(named_struct('url', 'text', 'valueString', ethnicity)),
              'valueAddress', cast(null as struct<city:string,state:string>)),
            named_struct('url', 'http://hl7.org/fhir/StructureDefinition/patient-birthPlace',
              'extension', cast(null as array<struct<url:string,valueString:string>>),
              'valueAddress', named_struct('city', city, 'state', 'X')))""",
    },
    "encounter": {
        "resourceType": "'Encounter'",
        "id": "encounter_id",
        "status": "status",
        "class": "named_struct('code', class_code)",
        "type": "array(named_struct('text', encounter_type))",
        "period": "named_struct('start', start_date, 'end', end_date)",
        "participant": "array(named_struct('individual', named_struct('display', practitioner)))",
        "serviceProvider": "named_struct('display', provider_name)",
    },
    "claim": {
        "resourceType": "'Claim'",
        "id": "claim_id",
        "status": "status",
        "created": "created_date",
        "type": "named_struct('coding', array(named_struct('code', claim_type)))",
        "provider": "named_struct('display', provider_name)",
        "insurance": "array(named_struct('coverage', named_struct('display', payer)))",
        "total": "named_struct('value', try_cast(total_amount as double), 'currency', currency)",
        "item": f"""array(named_struct(
            'encounter', array(named_struct('reference', 'urn:uuid:superseded'), {_ENCOUNTER_REF}),
            'productOrService', named_struct('text', service_desc,
              'coding', array(named_struct('code', service_code)))))""",
    },
    "condition": {
        "resourceType": "'Condition'",
        "id": "condition_id",
        "clinicalStatus": "named_struct('coding', array(named_struct('code', clinical_status)))",
        "code": _code("condition_code", "condition_system", "condition_name"),
        "encounter": _ENCOUNTER_REF,
        "onsetDateTime": "onset_date",
        "recordedDate": "recorded_date",
    },
    "procedure": {
        "resourceType": "'Procedure'",
        "id": "procedure_id",
        "status": "status",
        "code": _code("procedure_code", "procedure_system", "procedure_name"),
        "encounter": _ENCOUNTER_REF,
        "performedPeriod": "named_struct('start', performed_start, 'end', performed_end)",
    },
    "observation": {
        "resourceType": "'Observation'",
        "id": "observation_id",
        "status": "status",
        "code": _code("obs_code", "obs_system", "obs_name"),
        "encounter": _ENCOUNTER_REF,
        "effectiveDateTime": "effective_date",
        "valueQuantity": "named_struct('value', case when value not like '-%' then cast(value as double) end, 'unit', unit)",
        "valueCodeableConcept": "named_struct('text', value)",
    },
    "medication_request": {
        "resourceType": "'MedicationRequest'",
        "id": "medication_id",
        "status": "status",
        "intent": "intent",
        "medicationCodeableConcept": "named_struct('text', medication_name, "
                                     "'coding', array(named_struct('code', medication_code)))",
        "encounter": _ENCOUNTER_REF,
        "authoredOn": "authored_date",
        "requester": "named_struct('display', requester)",
    },
}


def _entry(fields: dict[str, str]) -> str:
    body = ", ".join(f"'{k}', {v}" for k, v in fields.items())
    return f"to_json(named_struct('resource', named_struct({body})))"


def bundles(raw: DataFrame, table: str) -> DataFrame:
    """(bundle_id, value) for every row of the raw table."""
    entries = [_entry({"resourceType": "'Organization'", "id": "'org'"})]
    if table != "patient":
        entries.append(_entry({"resourceType": "'Patient'", "id": "patient_id"}))
        entries.append(_entry({"resourceType": "'Patient'", "id": "'second'"}))
    entries.append(_entry(_RESOURCE[table]))
    listed = F.concat_ws(",", *[F.expr(e) for e in entries])
    return raw.select(
        F.concat_ws("/", F.lit(table), F.col(raw.columns[0])).alias("bundle_id"),
        F.concat(F.lit('{"resourceType":"Bundle","entry":['), listed, F.lit("]}")).alias("value"),
    )


def _entries(raw: Mapping[str, DataFrame]) -> DataFrame:
    """(patient_id, table_name, row_id, rank, entry): every resource of all tables, patients with the lowest rank."""
    return reduce(DataFrame.unionByName, [
        df.select("patient_id", F.lit(name).alias("table_name"), F.col(df.columns[0]).alias("row_id"),
                  F.lit(int(name != "patient")).alias("rank"), F.expr(_entry(_RESOURCE[name])).alias("entry"))
        for name, df in raw.items()])


def bundles_by_patient(raw: Mapping[str, DataFrame], files: int = 64, most: int = 1_000) -> DataFrame:
    """(file, value): bundles of one patient each, the patient first, then resources of all types.

    A patient with more than ``most`` resources has several bundles of about that many,
    each with the patient's entry. Who is no patient in the raw table gets a patient
    entry with nothing but the id. ``file`` spreads the bundles.
    """
    entries = _entries(raw)
    many = entries.groupBy("patient_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select(
        "patient_id", F.ceil(F.col("n") / most).alias("parts"))
    # The patient's own entry goes into all of its bundles.
    parts = F.coalesce("parts", F.lit(1))
    own = F.when(F.col("rank") == 0, F.sequence(F.lit(0).cast("bigint"), parts - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("entry"), parts)))
    listed = F.array_sort(F.collect_list(F.struct("rank", "entry")))
    bare = F.expr(_entry({"resourceType": "'Patient'", "id": "patient_id"}))
    grouped = (
        entries.join(many, "patient_id", "left").select("patient_id", "rank", "entry", F.explode(own).alias("part"))
        .groupBy("patient_id", "part").agg(listed.alias("listed"), F.min("rank").alias("first"))
    )
    head = F.when(F.col("first") > 0, F.concat(bare, F.lit(","))).otherwise(F.lit(""))
    return grouped.select(
        F.pmod(F.xxhash64("patient_id", "part"), F.lit(files)).alias("file"),
        F.concat(F.lit('{"resourceType":"Bundle","entry":['), head, F.concat_ws(",", "listed.entry"), F.lit("]}")).alias("value"))


def write_large_bundles(raw: Mapping[str, DataFrame], folder: str, files: int = 4) -> None:
    """``files`` bundles with all resources of all types, as one file each, below ``folder``.

    A row belongs to the bundle that the last character of its key tells. The first
    patient of bundle k is ``bundle-k``. Files are streamed entry by entry, with links
    and text before the entries that must not be taken for some.
    """
    number = F.pmod(F.ascii(F.substring("row_id", -1, 1)), F.lit(files))
    body = _entries(raw).select(number.alias("file"), F.lit(1).alias("rank"), F.concat(F.lit(","), "entry").alias("value"))
    spark = body.sparkSession
    each = spark.range(files).select(F.col("id").cast("int").alias("file"))
    first = F.concat(
        F.lit('{"resourceType":"Bundle","meta":{"note":"\\"entry\\":[{\\"resource"},"link":[{"resource":{"resourceType":"Patient"}}],\n'
              '"tag":["resource", "}"], "entry" : [{"fullUrl":"x","resource":{"resourceType":"Patient","id":"bundle-'),
        F.col("file").cast("string"), F.lit('"}}'))
    head = each.select("file", F.lit(0).alias("rank"), first.alias("value"))
    tail = each.select("file", F.lit(2).alias("rank"), F.lit('],"total":1}').alias("value"))
    (
        head.unionByName(body).unionByName(tail).repartition("file").sortWithinPartitions("file", "rank")
        .select("file", "value").write.partitionBy("file").text(folder)
    )
