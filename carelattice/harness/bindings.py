"""The seven raw tables derived from the star-schema parquet tables.

Customers play patients, orders encounters and claims, line items conditions,
procedures and medication requests, events observations. Everything is rendered
to text, partly unclean, so the staging models have something to do.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelattice.plans.staging import stage
from carelattice.schemas import TABLES

AS_OF = date(2024, 1, 1)

# Text of each raw column as SQL over the source tables named in _FROM.
_COLUMNS: dict[str, dict[str, str]] = {
    "patient": {
        "patient_id": "c_custkey",
        "first_name": "c_name",
        "last_name": "concat('Family', c_custkey)",
        "gender": "case when c_custkey % 3 = 0 then 'male' when c_custkey % 3 = 1 then ' female ' else 'unknown' end",
        "birth_date": "date_add(date'1930-01-01', cast((c_custkey * 97) % 30000 as int))",
        "race": "c_mktsegment",
        "ethnicity": "n_name",
        "birth_place": "concat('\"', n_name, ', X\"')",
        "city": "n_name",
        "state": "concat('S', n_regionkey)",
        "postal_code": "concat('Z', c_custkey % 1000)",
        "country": "'US'",
        "marital_status": "case when c_custkey % 4 = 0 then 'M' when c_custkey % 4 = 1 then 'S' end",
        "language": "'English '",
    },
    "encounter": {
        "encounter_id": "o_orderkey",
        "patient_id": "o_custkey",
        "status": "o_orderstatus",
        "class_code": "case o_orderkey % 5 when 0 then 'AMB' when 1 then 'IMP' when 2 then 'EMER' when 3 then 'VR' else 'ZZ' end",
        "encounter_type": "o_orderpriority",
        "start_date": "o_orderdate",
        "end_date": "o_orderdate + make_dt_interval(0, 0, (o_orderkey * 37) % 2880)",
        "provider_name": "concat(' \"Clinic ', o_custkey % 7, '\"')",
        "practitioner": "case when o_orderkey % 11 = 0 then 'Dr_x' else concat('Dr. A', o_custkey % 9) end",
    },
    "claim": {
        "claim_id": "concat('C', o_orderkey)",
        "patient_id": "o_custkey",
        "encounter_id": "o_orderkey",
        "status": "o_orderstatus",
        "claim_type": "'professional'",
        "created_date": "o_orderdate",
        "provider_name": "concat('Clinic ', o_custkey % 7)",
        "payer": "concat('\"', o_orderpriority, '\" ')",
        "total_amount": "case when o_orderkey % 13 = 0 then 'n/a' else cast(o_totalprice as string) end",
        "currency": "' USD'",
        "service_code": "concat('SV', o_orderkey % 50)",
        "service_desc": "case when o_orderkey % 2 = 0 then 'General exam (adult)' else 'Exam #2' end",
    },
    "condition": {
        "condition_id": "concat(l_orderkey, '-', l_linenumber)",
        "patient_id": "o_custkey",
        "encounter_id": "l_orderkey",
        "clinical_status": "l_linestatus",
        "condition_code": "p_brand",
        "condition_system": "'http://snomed.info/sct'",
        "condition_name": "p_type",
        "onset_date": "l_shipdate",
        "recorded_date": "l_shipdate",
    },
    "procedure": {
        "procedure_id": "concat(l_orderkey, '-', l_linenumber, '-', l_suppkey)",
        "patient_id": "o_custkey",
        "encounter_id": "l_orderkey",
        "status": "l_linestatus",
        "procedure_code": "l_suppkey",
        "procedure_system": "'\"http://snomed.info/sct\"'",
        "procedure_name": "s_name",
        "performed_start": "l_shipdate",
        "performed_end": "l_shipdate + make_dt_interval(0, 0, cast(l_quantity as int))",
    },
    "medication_request": {
        "medication_id": "concat(l_orderkey, '-', l_linenumber, '-', l_partkey)",
        "patient_id": "o_custkey",
        "encounter_id": "l_orderkey",
        "status": "l_linestatus",
        "intent": "'order'",
        "medication_code": "p_brand",
        "medication_name": "p_name",
        "authored_date": "l_shipdate",
        "requester": "concat('Dr. A', o_custkey % 9)",
    },
    "observation": {
        "observation_id": "event_id",
        "patient_id": "user_id",
        "encounter_id": "user_id",
        "status": "'final'",
        "obs_code": "concat(' ', user_id, '-', event_id % 10)",
        "obs_system": "'http://loinc.org'",
        "obs_name": "props",
        "effective_date": "ts",
        "value": "concat(case when event_id % 7 = 0 then '-' else '' end, cast(value as string))",
        "unit": "case when event_id % 5 = 0 then 'mm[Hg]' else event_type end",
    },
}

_FROM: dict[str, tuple[str, ...]] = {
    "patient": ("customer", "nation"),
    "encounter": ("orders",),
    "claim": ("orders",),
    "condition": ("lineitem", "orders", "part"),
    "procedure": ("lineitem", "orders", "supplier"),
    "medication_request": ("lineitem", "orders", "part"),
    "observation": ("events",),
}

_ON = {
    "nation": ("c_nationkey", "n_nationkey"),
    "orders": ("l_orderkey", "o_orderkey"),
    "part": ("l_partkey", "p_partkey"),
    "supplier": ("l_suppkey", "s_suppkey"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(raw: DataFrame, name: str) -> DataFrame:
    """The rows of the raw table ``name`` dealt over all tasks.

    A table read from one source comes in as many tasks as its files have splits, which
    for few and narrow rows is one: too few for work that takes long per row. A table
    joined from large ones has left its splits already.
    """
    return raw if "lineitem" in _FROM[name] else raw.repartition(*raw.columns)


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The raw table ``name``, every column text."""
    first, *rest = _FROM[name]
    source = table(spark, sf_dir, first)
    for other in rest:
        a, b = _ON[other]
        source = source.join(table(spark, sf_dir, other), F.col(a) == F.col(b))
    columns = _COLUMNS[name]
    return source.select(*[F.expr(columns[c]).cast("string").alias(c) for c in TABLES[name].columns])


def staged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The staging model over the raw table ``name``."""
    return stage(raw(spark, sf_dir, name), name, AS_OF)
