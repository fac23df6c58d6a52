"""Every operator as a query over the given parquet tables, with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelattice import functions as fn
from carelattice.operators import incremental, quality, sketches
from carelattice.operators.flatten import flatten
from carelattice.harness import bindings, bundle_text, oracle
from carelattice.plans import bucketed, checks, enrichment, marts, refresh
from carelattice.schemas import TABLES
from carelattice.session import freed_shuffles, settings, side_by_side, work_path, written
from carelattice.sources import bundles, landing, registry
from carelattice.sources.snapshots import SnapshotTable
from carelattice.streaming import ingest, stateful

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return query

    return add


def _staged(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [bindings.staged(spark, sf_dir, n) for n in names]


# ---- raw tables and staging

def _raw_query(name: str) -> Query:
    return lambda spark, sf_dir: bindings.raw(spark, sf_dir, name)


def _stage_query(name: str) -> Query:
    return lambda spark, sf_dir: bindings.staged(spark, sf_dir, name)


for _name in TABLES:
    register(f"raw_{_name}", oracle.rows_of(f"raw_{_name}"))(_raw_query(_name))
    register(f"stage_{_name}", oracle.rows_of(_name))(_stage_query(_name))


# ---- enrichment

# Small tables need a small target to be split.
_SMALL_TASKS = 2_000

_ENRICHMENTS = {
    "condition_patient": (enrichment.condition_patient, "condition", "patient"),
    "encounter_claim": (enrichment.encounter_claim, "encounter", "claim", "procedure"),
    "encounter_condition": (enrichment.encounter_condition, "encounter", "condition"),
    "encounter_patient": (enrichment.encounter_patient, "encounter", "patient"),
    "medication_condition": (enrichment.medication_condition, "medication_request", "condition"),
}


def _enrich_query(name: str) -> Query:
    model, *inputs = _ENRICHMENTS[name]
    return lambda spark, sf_dir: model(*_staged(spark, sf_dir, *inputs))


for _name in _ENRICHMENTS:
    register(f"enrich_{_name}", oracle.rows_of(_name))(_enrich_query(_name))


def _bucketed_query(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The model over staging tables laid out by visit."""
        inputs = _ENRICHMENTS[name][1:]
        laid = bucketed.by_visit(dict(zip(inputs, _staged(spark, sf_dir, *inputs))))
        return bucketed.enriched(name, laid, rows_per_task=_SMALL_TASKS)

    return query


for _name in ("encounter_claim", "encounter_condition", "medication_condition"):
    register(f"bucketed_{_name}", oracle.rows_of(_name))(_bucketed_query(_name))


def _renumbered(df: DataFrame, number: str, cases: dict[str, str], columns: tuple[str, ...]) -> DataFrame:
    """``df`` with ``columns`` set to a value wherever a condition on ``number`` (called n) holds."""
    choice = F.expr("case " + " ".join(f"when {c} then '{v}'" for c, v in cases.items()) + " end")
    own = df.withColumn("n", F.expr(number))
    return own.withColumns({c: F.coalesce(choice, F.col(c)) for c in columns}).select(*df.columns)


# A third of all claims, requests or visits on one encounter or patient, and a second
# encounter with many rows on both sides.
_FIRST_NUMBER = "cast(split({0}, '-')[0] as bigint)"


@register("enrich_encounter_claim_skewed", oracle.ENCOUNTER_CLAIM_SKEWED)
def enrich_encounter_claim_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    encounter, claim, procedure = _staged(spark, sf_dir, "encounter", "claim", "procedure")
    claim = _renumbered(claim, "cast(substring(claim_id, 2) as bigint)",
                        {"n % 3 = 0": "1", "n % 100 = 7": "7"}, ("encounter_id",))
    procedure = _renumbered(procedure, _FIRST_NUMBER.format("procedure_id"), {"n % 40 = 7": "7"}, ("encounter_id",))
    return enrichment.encounter_claim(encounter, claim, procedure, rows_per_task=_SMALL_TASKS)


@register("enrich_medication_condition_skewed", oracle.MEDICATION_CONDITION_SKEWED)
def enrich_medication_condition_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    medication, condition = _staged(spark, sf_dir, "medication_request", "condition")
    both = ("encounter_id", "patient_id")
    medication = _renumbered(medication, _FIRST_NUMBER.format("medication_id"), {"n % 3 = 0": "1", "n % 60 = 7": "7"}, both)
    condition = _renumbered(condition, _FIRST_NUMBER.format("condition_id"), {"n % 5000 = 1": "1", "n % 300 = 7": "7"}, both)
    return enrichment.medication_condition(medication, condition, rows_per_task=_SMALL_TASKS)


# ---- marts

@register("readmissions_skewed", oracle.READMISSIONS_SKEWED)
def readmissions_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    (encounter,) = _staged(spark, sf_dir, "encounter")
    encounter = _renumbered(encounter, "cast(encounter_id as bigint)", {"n % 3 = 0": "1"}, ("patient_id",))
    return marts.readmissions(encounter, rows_per_task=_SMALL_TASKS // 10)


@register("readmissions", oracle.READMISSIONS)
def readmissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.readmissions(*_staged(spark, sf_dir, "encounter"))


@register("readmissions_inpatient", oracle.READMISSIONS_INPATIENT)
def readmissions_inpatient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.readmissions(
        *_staged(spark, sf_dir, "encounter"), inclusive=True, class_code="IMP"
    )


@register("readmissions_literal", oracle.READMISSIONS_PER_BILLED_ROW)
def readmissions_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.readmissions_per_billed_row(
        *_staged(spark, sf_dir, "encounter", "claim", "procedure")
    )


@register("readmission_flag", oracle.READMISSION_FLAG)
def readmission_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.readmission_flags(*_staged(spark, sf_dir, "encounter"))


@register("fn_re_admission", oracle.READMISSION_FLAG)
def fn_re_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    (encounter,) = _staged(spark, sf_dir, "encounter")
    flag = fn.re_admission("start_date", "patient_id", 30, ["encounter_id"])
    return encounter.select(
        "patient_id", "encounter_id", "encounter_type", "start_date", flag.alias("is_readmission")
    )


@register("prevalence", oracle.prevalence("diagnosed", 100, "prevalence_percentage"))
def prevalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.prevalence(*_staged(spark, sf_dir, "condition", "patient"))


@register("prevalence_per_1000_population", oracle.prevalence("demographics", 1000, "prevalence_rate"))
def prevalence_per_1000_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.prevalence(
        *_staged(spark, sf_dir, "condition", "patient"), scale=1000, denominator="population"
    )


@register("length_of_stay", oracle.length_of_stay("DESC", "ASC NULLS LAST"))
def length_of_stay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.length_of_stay(*_staged(spark, sf_dir, "encounter", "condition"))


@register("length_of_stay_literal_mode", oracle.length_of_stay("ASC", "ASC NULLS LAST"))
def length_of_stay_literal_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.length_of_stay(*_staged(spark, sf_dir, "encounter", "condition"), mode_order="asc")


@register("medication_patterns", oracle.MEDICATION_PATTERNS)
def medication_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.medication_patterns(*_staged(spark, sf_dir, "medication_request", "condition"))


@register("medication_patterns_top3", oracle.MEDICATION_PATTERNS_TOP3)
def medication_patterns_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.medication_patterns(
        *_staged(spark, sf_dir, "medication_request", "condition"), top_k=3
    )


@register("medication_patterns_crowded", oracle.MEDICATION_PATTERNS_CROWDED)
def medication_patterns_crowded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all diagnoses is one condition with very many medications; no task ranks it alone."""
    medication, condition = _staged(spark, sf_dir, "medication_request", "condition")
    crowd = F.expr(_FIRST_NUMBER.format("condition_id")) % 3 == 0
    many = F.concat_ws("/", "medication_name", F.expr(_FIRST_NUMBER.format("medication_id")) % 2000)
    return marts.medication_patterns(
        medication.withColumn("medication_name", many),
        condition.withColumn("condition_name", F.when(crowd, "CROWD").otherwise(F.col("condition_name"))), crowded=True)


@register("prevalence_estimated", oracle.PREVALENCE_ESTIMATED)
def prevalence_estimated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts from monthly sketches beside the exact ones: all within five standard errors."""
    condition, patient = _staged(spark, sf_dir, "condition", "patient")
    estimates = marts.estimated_prevalence(marts.patient_sketches(condition, patient))
    group, counts = ["condition_name", *marts.DEMOGRAPHICS], ["patients_with_condition", "total_group_patients"]
    both = marts.prevalence(condition, patient).join(
        estimates.withColumnsRenamed({c: f"estimated_{c}" for c in counts}), group, "full")
    bound = 5 * sketches.relative_error()
    near = [F.coalesce(F.abs(F.col(c) - F.col(f"estimated_{c}")) <= F.greatest(F.lit(1.0), F.col(c) * bound), F.lit(False))
            .alias(f"{c}_near") for c in counts]
    return both.select(*group, *counts, *near)


# A presented mart with the place of each row, since rows of a result have no order of their own.
_PRESENTED = {"prevalence": prevalence, "length_of_stay": length_of_stay, "medication_patterns": medication_patterns}


def _placed(ordered: DataFrame) -> DataFrame:
    """Sorted rows with their places: rows before the partition, and place in it.

    Partitions of a sorted result are ordered, and so are the rows in them. They are
    written once, so that counts and rows come from the same partitions.
    """
    spark, path = ordered.sparkSession, work_path(ordered.sparkSession, "placed")
    # The id holds the partition above 33 bits of the row's number in it.
    numbered = ordered.withColumn("_at", F.monotonically_increasing_id())
    numbered.write.parquet(path)
    rows = spark.read.schema(numbered.schema).parquet(path).withColumn("_part", F.shiftright("_at", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    at = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(F.broadcast(offsets), "_part").select(
        *ordered.columns, (F.col("_before") + at + 1).cast("bigint").alias("place"))


def _presented_query(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _placed(marts.present(_PRESENTED[name](spark, sf_dir), name))

    return query


for _name in _PRESENTED:
    register(f"present_{_name}", oracle.PRESENTED[_name])(_presented_query(_name))


@register("prevalence_keyed", oracle.PREVALENCE_KEYED)
def prevalence_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.with_surrogate_key(
        prevalence(spark, sf_dir), ["condition_name", *marts.DEMOGRAPHICS]
    )


# ---- incremental loads

def _claim_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Claims up to the end of 1999, and claims since June 1999 with a raised amount."""
    (claim,) = _staged(spark, sf_dir, "claim")
    created = F.col("created_date")
    early = claim.where(created <= F.lit("1999-12-31").cast("timestamp_ntz"))
    late = claim.where(created >= F.lit("1999-06-01").cast("timestamp_ntz"))
    return early, late.withColumn("total_amount", F.col("total_amount") + 1)


_CLAIM_ORDER = ["patient_id", "total_amount"]


@register("incremental_filter", oracle.INCREMENTAL_FILTER)
def incremental_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, late = _claim_batches(spark, sf_dir)
    return incremental.incremental_filter(late, early, "created_date")


@register("incremental_filter_lookback", oracle.INCREMENTAL_LOOKBACK)
def incremental_filter_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, late = _claim_batches(spark, sf_dir)
    return incremental.incremental_filter(late, early, "created_date", lookback="90 days")


@register("incremental_merge", oracle.INCREMENTAL_MERGE)
def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, late = _claim_batches(spark, sf_dir)
    order = incremental.newest_first("created_date", _CLAIM_ORDER)
    return incremental.upsert(early, late, "claim_id", order)


@register("merge_dedup", oracle.MERGE_DEDUP)
def merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    (condition,) = _staged(spark, sf_dir, "condition")
    order = incremental.newest_first(
        "recorded_date", ["patient_id", "condition_code", "condition_name", "clinical_status"]
    )
    return incremental.deduplicate(condition, "condition_id", order)


def _raw_claim_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The raw rows behind :func:`_claim_batches`."""
    claim = bindings.raw(spark, sf_dir, "claim")
    raised = (F.col("total_amount").try_cast("double") + 1).cast("string")
    return (
        claim.where(F.col("created_date") <= "1999-12-31 00:00:00"),
        claim.where(F.col("created_date") >= "1999-06-01 00:00:00").withColumn("total_amount", raised),
    )


@register("incremental_load", oracle.INCREMENTAL_LOAD)
def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the staging load into a written snapshot: full, then beyond the mark."""
    snapshot = refresh.staging_snapshot(spark, work_path(spark, "incremental_load"), "claim", "year")
    for batch in _raw_claim_batches(spark, sf_dir):
        result = refresh.load_increment(
            snapshot, refresh.stage(batch, "claim", bindings.AS_OF), "claim"
        )
    return result


@register("incremental_load_rerun", oracle.INCREMENTAL_LOAD)
def incremental_load_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same load, every run twice: the repeated ones change nothing."""
    snapshot = refresh.staging_snapshot(spark, work_path(spark, "incremental_load"), "claim", "year")
    for batch in _raw_claim_batches(spark, sf_dir):
        for _ in range(2):
            result = refresh.load_increment(
                snapshot, refresh.stage(batch, "claim", bindings.AS_OF), "claim", lookback=None
            )
    return result


@register("load_one_day", oracle.INCREMENTAL_MERGE)
def load_one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landed days of claims loaded day by day, the older one again at the end."""
    root = work_path(spark, "load_day")
    snapshot = refresh.staging_snapshot(spark, root, "claim", "year")
    early, late = _raw_claim_batches(spark, sf_dir)
    landing.land(early.where("created_date < '1999-06-01 00:00:00'"), f"{root}/landed", "claim", date(2024, 6, 7))
    landing.land(late, f"{root}/landed", "claim", date(2024, 6, 8))
    for day in (7, 8, 7):
        result = refresh.load_day(snapshot, f"{root}/landed", "claim", date(2024, 6, day), bindings.AS_OF)
    return result


# ---- column functions

_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@register("fn_surrogate_key", oracle.FN["fn_surrogate_key"])
def fn_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    (claim,) = _staged(spark, sf_dir, "claim")
    key = fn.surrogate_key(["claim_id", F.nullif("status", F.lit("F")), "service_desc"])
    return claim.select("claim_id", key.alias("claim_key"))


@register("fn_age", oracle.FN["fn_age"])
def fn_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    (patient,) = _staged(spark, sf_dir, "patient")
    return patient.select(
        "patient_id",
        fn.age_by_calendar_year("birth_date", bindings.AS_OF).alias("age_by_calendar_year"),
        fn.age_in_years("birth_date", bindings.AS_OF).alias("age_in_years"),
    )


@register("fn_age_bucket", oracle.FN["fn_age_bucket"])
def fn_age_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    (patient,) = _staged(spark, sf_dir, "patient")
    some_missing = F.nullif("age", F.lit(50))
    return patient.select(
        "patient_id",
        fn.age_bucket("age").alias("age_group"),
        fn.age_bucket(some_missing, null_label="unknown").alias("age_group_labelled"),
    )


@register("fn_safe_divide", oracle.FN["fn_safe_divide"])
def fn_safe_divide(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = bindings.table(spark, sf_dir, "lineitem")
    return line.select(*_LINE, fn.safe_divide("l_extendedprice", "l_tax").alias("price_per_tax"))


@register("fn_nullif_zero", oracle.FN["fn_nullif_zero"])
def fn_nullif_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = bindings.table(spark, sf_dir, "lineitem")
    return line.select(*_LINE, fn.nullif_zero("l_discount").alias("discount"))


@register("fn_days_between", oracle.FN["fn_days_between"])
def fn_days_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = bindings.table(spark, sf_dir, "lineitem")
    orders = bindings.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    end = F.expr("l_shipdate + make_dt_interval(0, 0, cast(l_quantity as int))")
    return line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        *_LINE,
        fn.days_between("o_orderdate", "l_shipdate").cast("bigint").alias("days_to_ship"),
        fn.minute_boundaries("o_orderdate", end).alias("minutes_to_ship"),
    )


@register("fn_round", oracle.FN["fn_round"])
def fn_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = bindings.table(spark, sf_dir, "lineitem")
    return line.select(*_LINE, fn.round_to("l_extendedprice", 1).alias("rounded"))


# ---- FHIR bundles

def _fhir_query(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        text = bundle_text.bundles(bindings.spread(bindings.raw(spark, sf_dir, name), name), name)
        return flatten(bundles.explode_bundles(text, name), name)

    return query


for _name in TABLES:
    register(f"fhir_{_name}", oracle.FHIR[_name])(_fhir_query(_name))


@register("fhir_quarantine", oracle.FHIR_QUARANTINE)
def fhir_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents are no bundles and are set aside; event properties are JSON without entries."""
    prose = bindings.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("document/"), "doc_id").alias("bundle_id"), F.col("text").alias("value")
    )
    props = bindings.table(spark, sf_dir, "events").select(
        F.concat(F.lit("event/"), "event_id").alias("bundle_id"), F.col("props").alias("value")
    )
    return bundles.quarantine(prose.unionByName(props)).select("bundle_id", "reason")


def _by_patient(spark: SparkSession, sf_dir: str, share: int = 0, shares: int = 1) -> DataFrame:
    """The bundles of all patients, or of those whose id falls into one of several shares."""
    mine = F.pmod(F.xxhash64("patient_id"), F.lit(shares)) == share
    raw = {n: bindings.raw(spark, sf_dir, n) for n in TABLES}
    return bundle_text.bundles_by_patient(raw if shares == 1 else {n: df.where(mine) for n, df in raw.items()})


def _ids_of_all(landed: DataFrame, repeated_patients: bool = True) -> DataFrame:
    """Table, key, patient and visit of every flattened row of the seven types.

    A patient with several bundles has an entry in each, and is one row.
    """
    parts = []
    for name, spec in TABLES.items():
        visit = "encounter_id" if "encounter_id" in spec.columns else F.lit(None).cast("string").alias("encounter_id")
        rows = flatten(landed, name).select(
            F.lit(name).alias("table_name"), F.col(spec.key).alias("row_id"), "patient_id", visit)
        parts.append(rows.distinct() if name == "patient" and repeated_patients else rows)
    return reduce(DataFrame.unionByName, parts)


@contextmanager
def _small_ranges(spark: SparkSession, size: str = "1m") -> Iterator[None]:
    """Small tables read in as many ranges as large ones; holds for what is computed inside."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@register("fhir_large_bundles", oracle.FHIR_LARGE)
def fhir_large_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four files with a quarter of all resources in one bundle each, every file read in many ranges."""
    folder = work_path(spark, "large-bundles")
    with settings(spark, freed_shuffles()):
        bundle_text.write_large_bundles({n: bindings.raw(spark, sf_dir, n) for n in TABLES}, folder)
    with _small_ranges(spark), settings(spark, freed_shuffles()):
        resources, unreadable = bundles.read_resources(spark, f"{folder}/*", "part-*", large_file=0)
        landed = bundles.land_resources(resources, work_path(spark, "resources"))
        refused = unreadable.select(F.lit("unreadable").alias("table_name"), F.lit(None).cast("string").alias("row_id"),
                                    F.lit(None).cast("string").alias("patient_id"), F.lit(None).cast("string").alias("encounter_id"))
        return written(_ids_of_all(landed, repeated_patients=False).unionByName(refused), "large-bundles")


# Shares of all patients whose bundles are landed in a run each. Every run reads the tables anew.
_SHARES = 2


@register("fhir_landed_resources", oracle.FHIR_ALL)
def fhir_landed_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bundles with all types exploded once, landed by type, then flattened from there.

    Patients are landed in shares, one after the other: text that is grouped by patient
    takes several times the disk of what is landed, and that of a share is deleted
    before the next begins.
    """
    path = work_path(spark, "resources")
    for share in range(_SHARES):
        text = _by_patient(spark, sf_dir, share, _SHARES).withColumn("bundle_id", F.xxhash64("value").cast("string"))
        landed = bundles.land_resources(bundles.explode_bundles(text), path, "overwrite" if share == 0 else "append")
    return _ids_of_all(landed)


# For very many small files: tasks move their own files into place, not the driver one after
# the other. On a local disk, where every file made starts a process that sets its
# permissions, no second one is made for its checksum; gzip has one of its own.
_MANY_FILES = {
    "mapreduce.fileoutputcommitter.algorithm.version": "2",
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
}


@register("fhir_files_roundtrip", oracle.FHIR_ALL)
def fhir_files_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bundle per patient with all seven types, written as files of one bundle each, read back and flattened."""
    folder = work_path(spark, "bundles")
    text = _by_patient(spark, sf_dir)
    # A file holds one bundle whoever writes it, so the text need not be shuffled again.
    with settings(spark, freed_shuffles()):
        text.write.partitionBy("file").options(maxRecordsPerFile=1, compression="gzip", **_MANY_FILES).text(folder)
    return _ids_of_all(bundles.land_resources(
        bundles.explode_bundles(bundles.read_bundles(spark, f"{folder}/*", pattern="part-*")),
        work_path(spark, "resources")))


@register("fhir_misshapen", oracle.FHIR_MISSHAPEN)
def fhir_misshapen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resources of a declared type in which a field has another shape: claims with text for their total."""
    claim = bindings.raw(spark, sf_dir, "claim")
    total = F.expr("case when cast(substring(claim_id, 2) as bigint) % 13 = 0 then concat('[', char(34), 'x', char(34), ']') "
                   "else '{}' end")
    resources = claim.select(
        F.col("claim_id").alias("bundle_id"), F.lit(None).cast("string").alias("bundle_patient_id"),
        F.lit(0).alias("position"), F.lit("Claim").alias("resource_type"),
        F.concat(F.lit('{"resourceType":"Claim","id":"'), "claim_id", F.lit('","total":'), total, F.lit("}")).alias("resource"))
    return bundles.misshapen(resources).select("bundle_id", "resource_type", "reason")


# ---- quality

def _checked(spark: SparkSession, sf_dir: str, wanted: list[quality.Check]) -> DataFrame:
    raw = {n: bindings.raw(spark, sf_dir, n) for n in TABLES}
    return quality.run_checks(checks.source_scans(raw, bindings.AS_OF), wanted)


def _quality_query(wanted: list[quality.Check]) -> Query:
    return lambda spark, sf_dir: _checked(spark, sf_dir, wanted)


for _name, _checks in {
    "quality_not_null": checks.of_kind(checks.ALL_CHECKS, "not_null"),
    "quality_unique": checks.of_kind(checks.ALL_CHECKS, "unique"),
    "quality_accepted_values": checks.of_kind(checks.ALL_CHECKS, "accepted_values"),
    "quality_relationship": checks.RELATIONSHIPS,
    "quality_staging": checks.STAGING_CHECKS,
}.items():
    register(_name, oracle.checks(_checks))(_quality_query(_checks))


# ---- landing, whole refresh and streams

@register("land_roundtrip", oracle.LAND_ROUNDTRIP)
def land_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days of claims landed as CSV, the first landed twice, all read back."""
    root = work_path(spark, "landing")
    early, late = _raw_claim_batches(spark, sf_dir)
    for df, day in ((late, 7), (early, 7), (late, 8)):
        landing.land(df, root, "claim", date(2024, 6, day))
    return landing.read_landed(spark, root, "claim")


@register("land_one_day", oracle.rows_of("raw_encounter"))
def land_one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encounters landed as CSV on one of two days, that day read alone."""
    root = work_path(spark, "landing")
    encounter = bindings.raw(spark, sf_dir, "encounter")
    landing.land(encounter, root, "encounter", date(2024, 6, 7))
    landing.land(encounter, root, "encounter", date(2024, 6, 8))
    return landing.read_landed(spark, root, "encounter", date(2024, 6, 7))


@register("land_multiline", oracle.LAND_MULTILINE)
def land_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims with line breaks, quotes and commas inside two fields, landed as CSV and read in byte ranges."""
    root = work_path(spark, "landing")
    n = F.col("claim_id").substr(2, 20).cast("bigint")
    broken = F.when(n % 3 == 0, F.concat("service_desc", F.lit('\n"line", 2\r\n\n'), "claim_id")).otherwise(F.col("service_desc"))
    claim = bindings.raw(spark, sf_dir, "claim").withColumns({
        "service_desc": broken, "status": F.when(n % 7 == 0, F.concat(F.lit('a "'), "status", F.lit('"\n'))).otherwise(F.col("status"))})
    landing.land(claim, root, "claim", date(2024, 6, 7))
    with _small_ranges(spark):
        return written(landing.read_landed(spark, root, "claim", multiline=True), "multiline")


@register("land_replaced_day", oracle.rows_of("raw_encounter"))
def land_replaced_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day landed again without rows is empty; another day stays."""
    root = work_path(spark, "landing")
    encounter = bindings.raw(spark, sf_dir, "encounter")
    for df, day in ((encounter, 7), (encounter, 8), (encounter.limit(0), 7)):
        landing.land(df, root, "encounter", date(2024, 6, day))
    return landing.read_landed(spark, root, "encounter").select(*TABLES["encounter"].columns)


@register("land_flat", oracle.rows_of("raw_patient"))
def land_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patients written as flat CSV with a header and read back as text; an empty table is not written."""
    folder = work_path(spark, "flat")
    patient = bindings.raw(spark, sf_dir, "patient")
    written = landing.write_flat({"patient": patient, "claim": bindings.raw(spark, sf_dir, "claim").limit(0)}, folder)
    assert written == ["patient"]
    return spark.read.options(header="true", escape='"').schema(TABLES["patient"].raw_schema).csv(f"{folder}/patient")


@register("registry", oracle.REGISTRY)
def registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry beside the number of rows of every raw table, read by name from a written copy."""
    root = work_path(spark, "registry")
    counts = []
    for name in TABLES:
        bindings.raw(spark, sf_dir, name).write.parquet(f"{root}/{name}")
        counts.append(registry.raw_table(spark, root, name).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows"))
    return registry.describe(spark).join(reduce(DataFrame.unionAll, counts), "table_name").select(
        "table_name", "key", "watermark", "n_columns", "n_rows")


# Keys of the given tables that repeat in the raw rows.
REPEATED_RAW_KEYS = tuple(
    (f"raw_{t}", TABLES[t].key, "unique") for t in ("condition", "procedure", "medication_request"))


def _refreshed(spark: SparkSession, sf_dir: str) -> refresh.Refreshed:
    raw = {n: bindings.raw(spark, sf_dir, n) for n in TABLES}
    return refresh.refresh(spark, raw, work_path(spark, "refresh"), bindings.AS_OF, "year", REPEATED_RAW_KEYS)


@register("refresh_report", oracle.REFRESH_REPORT)
def refresh_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 60 checks and 7 relationships of a refresh; the batch stops if another than the known ones fails."""
    return _refreshed(spark, sf_dir).report


def _refreshed_mart_query(name: str) -> Query:
    return lambda spark, sf_dir: _refreshed(spark, sf_dir).marts[name]


for _name in ("readmissions", "prevalence", "length_of_stay"):
    register(f"refresh_{_name}", oracle.REFRESHED[_name])(_refreshed_mart_query(_name))


@register("refresh_medication_patterns", oracle.REFRESH_MEDICATION_PATTERNS)
def refresh_medication_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The medication mart after a whole refresh, whose staging tables are unique by key."""
    return _refreshed(spark, sf_dir).marts["medication_patterns"]


@register("refresh_one_day", oracle.REFRESH_MEDICATION_PATTERNS)
def refresh_one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits and what belongs to them landed on one of two days, the later day refreshed first: the medication mart after both."""
    root = work_path(spark, "refresh-day")
    landings = {}
    for name in TABLES:
        raw = bindings.raw(spark, sf_dir, name)
        early = F.lit(True) if name == "patient" else F.coalesce(F.crc32(F.col("encounter_id").cast("binary")) % 2 == 0, F.lit(True))
        for day, rows in ((7, raw.where(early)), (8, raw.where(~early))):
            landings[f"{name} {day}"] = partial(landing.land, rows, f"{root}/landed", name, date(2024, 6, day), compression="gzip")
    with settings(spark, freed_shuffles()):
        side_by_side(spark, landings, 2)
    for day in (8, 7):
        result = refresh.refresh_day(
            spark, f"{root}/landed", f"{root}/clinic", date(2024, 6, day), bindings.AS_OF, "year", REPEATED_RAW_KEYS)
    return result.marts["medication_patterns"]


@register("stream_upsert", oracle.STREAM_UPSERT)
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings of claims merged by two runs of the stream over one checkpoint."""
    root = work_path(spark, "stream")
    snapshot = refresh.staging_snapshot(spark, root, "claim", "year")
    for number, batch in enumerate(_raw_claim_batches(spark, sf_dir)):
        landing.land(batch, f"{root}/landed", "claim", date(2024, 6, 7 + number), fmt="parquet")
        ingest.upsert_available(
            ingest.landed_stream(spark, f"{root}/landed", "claim"),
            snapshot, "claim", f"{root}/checkpoint", bindings.AS_OF,
        )
    return snapshot.read()


@register("stream_readmission_flag", oracle.READMISSION_FLAG)
def stream_readmission_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encounters in three landings that are not ordered by date; some come twice, first with another start."""
    root = work_path(spark, "stream")
    encounter = bindings.raw(spark, sf_dir, "encounter")
    n = F.col("encounter_id").cast("bigint")
    moved = encounter.where(n % 17 == 0).withColumn("start_date", F.lit("1998-03-04 00:00:00"))
    visits = SnapshotTable(spark, f"{root}/state", "visits", "start_date", "year")
    landings = (
        encounter.where((n % 3 == 0) & (n % 17 != 0)).unionByName(moved),
        encounter.where((n % 3 == 1) | (n % 17 == 0)),
        encounter.where((n % 3 == 2) | (n % 50 == 0)),
    )
    for number, batch in enumerate(landings):
        landing.land(batch, f"{root}/landed", "encounter", date(2024, 6, 7 + number), fmt="parquet")
        ingest.flag_readmissions_available(
            ingest.landed_stream(spark, f"{root}/landed", "encounter"), visits, f"{root}/checkpoint", bindings.AS_OF)
    return visits.read()


@register("stream_readmission_state", oracle.READMISSION_FLAG)
def stream_readmission_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encounters in three landings that are not ordered by date, some twice: flags from state per patient."""
    root = work_path(spark, "stream")
    encounter = bindings.raw(spark, sf_dir, "encounter")
    n = F.col("encounter_id").cast("bigint")
    visits = SnapshotTable(spark, f"{root}/state", "visits", "start_date", "year")
    landings = (
        encounter.where(n % 3 == 0),
        encounter.where((n % 3 == 1) | (n % 50 == 0)),
        encounter.where((n % 3 == 2) | (n % 17 == 0)),
    )
    for number, batch in enumerate(landings):
        landing.land(batch, f"{root}/landed", "encounter", date(2024, 6, 7 + number), fmt="parquet")
        stateful.flag_readmissions_with_state(
            ingest.landed_stream(spark, f"{root}/landed", "encounter"), visits, f"{root}/checkpoint", bindings.AS_OF)
    return visits.read()


@register("stream_unique", oracle.STREAM_UNIQUE)
def stream_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations that arrive newest first, most of them again: late first-seen keys are kept."""
    root = work_path(spark, "stream")
    observation = bindings.raw(spark, sf_dir, "observation")
    late = F.col("observation_id").cast("bigint") % 5 == 0
    snapshot = SnapshotTable(spark, f"{root}/state", "observation", "effective_date", "year")
    for day, batch in ((7, observation.where(~late)), (8, observation)):
        landing.land(batch, f"{root}/landed", "observation", date(2024, 6, day), fmt="parquet")
        ingest.unique_available(
            ingest.landed_stream(spark, f"{root}/landed", "observation"), snapshot, "observation",
            f"{root}/checkpoint", bindings.AS_OF)
    return snapshot.read().select("observation_id", "patient_id", "effective_date", "value")


@register("stream_unique_with_state", oracle.STREAM_UNIQUE)
def stream_unique_with_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations of which most land three times, the last copies in other rows' company: equal rows stop at the state store."""
    root = work_path(spark, "stream")
    observation = bindings.raw(spark, sf_dir, "observation")
    n = F.col("observation_id").cast("bigint")
    snapshot = SnapshotTable(spark, f"{root}/state", "observation", "effective_date", "year", indexed_by="observation_id")
    landings = (observation.where(n % 5 != 0), observation.where(n % 5 != 1), observation)
    for number, batch in enumerate(landings):
        landing.land(batch, f"{root}/landed", "observation", date(2024, 6, 7 + number), fmt="parquet")
        ingest.unique_with_state(
            ingest.landed_stream(spark, f"{root}/landed", "observation", landed_at=True), snapshot, "observation",
            f"{root}/checkpoint", bindings.AS_OF)
    return snapshot.read().select("observation_id", "patient_id", "effective_date", "value")
