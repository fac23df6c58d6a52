"""The four clinical questions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelattice.functions import (
    age_bucket,
    day_boundaries,
    minute_boundaries,
    round_to,
    safe_divide,
    surrogate_key,
)
from carelattice.operators import sketches, skew
from carelattice.operators.histogram import describe, histogram
from carelattice.operators.ranking import rank_within
from carelattice.operators.visits import GAP, with_visit_gap

DEMOGRAPHICS = ("age_group", "gender", "race")
_VISIT = ("patient_id", "encounter_id", "encounter_type", "start_date")


def with_surrogate_key(mart: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Prefix the mart with an MD5 key over its dimension columns."""
    return mart.select(surrogate_key(cols).alias("surrogate_key"), *mart.columns)


def _within(days: int, inclusive: bool):
    return F.col(GAP) <= days if inclusive else F.col(GAP) < days


def readmissions(encounter: DataFrame, days: int = 30, inclusive: bool = False,
                 class_code: str | None = None, **options) -> DataFrame:
    """Encounters that start less than ``days`` days after the patient's previous one.

    Reads one row per encounter, so the enrichment joins, which add no column
    this question needs, are not run. ``class_code="IMP"`` restricts it to
    inpatient visits.
    """
    visits = encounter if class_code is None else encounter.where(F.col("class_code") == class_code)
    gaps = with_visit_gap(visits.select(*_VISIT), "patient_id", "start_date", ["encounter_id"], **options)
    return gaps.where(_within(days, inclusive))


def readmissions_per_billed_row(encounter: DataFrame, claim: DataFrame, procedure: DataFrame,
                                days: int = 30, inclusive: bool = False, **options) -> DataFrame:
    """The same question over encounters joined to claims and procedures.

    There an encounter with c claims and p procedures counts c x p times, and
    every repetition is a return after 0 days. The repetitions are counted per
    encounter rather than joined: the LAG runs over one row per encounter, and
    rows are repeated only on output.
    """
    def per_encounter(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("encounter_id").agg(F.count(F.lit(1)).alias(name))

    billed = (
        encounter.select(*_VISIT)
        .join(per_encounter(claim, "_claims"), "encounter_id", "left")
        .join(per_encounter(procedure, "_procedures"), "encounter_id", "left")
        .select(
            *_VISIT,
            (F.coalesce("_claims", F.lit(1)) * F.coalesce("_procedures", F.lit(1))).alias("_rows"),
        )
    )
    gaps = with_visit_gap(
        billed, "patient_id", "start_date", ["encounter_id"], counted=encounter, **options
    )
    repeated = F.when(F.col("start_date").isNotNull(), F.lit(0)).cast("bigint")
    kinds = F.array(
        F.struct(F.col(GAP).alias(GAP), F.lit(1).cast("bigint").alias("copies")),
        F.struct(repeated.alias(GAP), (F.col("_rows") - 1).alias("copies")),
    )
    rows = gaps.select(*_VISIT, F.inline(kinds)).where(_within(days, inclusive))
    return skew.repeat_rows(rows, "copies")


def readmission_flags(encounter: DataFrame, days: int = 30, **options) -> DataFrame:
    """Every encounter with whether the patient's previous one is at most ``days`` days back."""
    gaps = with_visit_gap(
        encounter.select(*_VISIT), "patient_id", "start_date", ["encounter_id"], **options
    )
    flag = F.coalesce(F.col(GAP) <= days, F.lit(False))
    return gaps.select(*_VISIT, flag.alias("is_readmission"))


def prevalence(condition: DataFrame, patient: DataFrame, scale: int = 100,
               denominator: str = "conditioned") -> DataFrame:
    """Share of a demographic group's patients that have each condition, times ``scale``.

    The group is every patient with any condition, or with
    ``denominator="population"`` every patient. Groups with an unknown
    demographic drop out. Conditions shrink to distinct (patient, condition)
    pairs before they meet the patients, which bounds what a patient with very
    many records can bring to one task by the number of condition names.
    """
    if denominator not in ("conditioned", "population"):
        raise ValueError("denominator is 'conditioned' or 'population'")
    people = patient.select(
        "patient_id", age_bucket("age").alias("age_group"), "gender", "race"
    ).na.drop(subset=["patient_id", *DEMOGRAPHICS])
    pairs = condition.select("patient_id", "condition_name").distinct()
    known = pairs.join(people, "patient_id", "inner").distinct()
    # A patient is marked on one of their conditions, so one pass yields both
    # counts: all rows per condition, and the marked ones per group.
    one_of = Window.partitionBy("patient_id", *DEMOGRAPHICS).orderBy("condition_name")
    counts = (
        known.withColumn("_first", F.row_number().over(one_of) == 1)
        .groupBy("condition_name", *DEMOGRAPHICS)
        .agg(
            F.count(F.lit(1)).alias("patients_with_condition"),
            F.count_if("_first").alias("_firsts"),
        )
    )
    if denominator == "conditioned":
        in_group = F.sum("_firsts").over(Window.partitionBy(*DEMOGRAPHICS))
        counts = counts.withColumn("total_group_patients", in_group)
    else:
        groups = people.groupBy(*DEMOGRAPHICS).agg(
            F.count_distinct("patient_id").alias("total_group_patients")
        )
        counts = counts.join(groups, list(DEMOGRAPHICS), "inner")
    share = safe_divide("patients_with_condition", "total_group_patients") * scale
    return counts.select(
        "condition_name",
        *DEMOGRAPHICS,
        "patients_with_condition",
        "total_group_patients",
        round_to(share, 2).alias("prevalence_percentage" if scale == 100 else "prevalence_rate"),
    )


def patient_sketches(condition: DataFrame, patient: DataFrame) -> DataFrame:
    """(period, condition_name, demographics, ids): a sketch of the patients per month of record and group.

    Sketches of a month never change once it is over, so a refresh makes those of new
    months only. Groups with an unknown demographic drop out, as in :func:`prevalence`.
    """
    people = patient.select("patient_id", age_bucket("age").alias("age_group"), "gender", "race").na.drop()
    month = F.date_trunc("month", "recorded_date")
    pairs = condition.select("patient_id", "condition_name", "recorded_date").withColumn("month", month).drop("recorded_date").distinct()
    return sketches.sketch(
        pairs.join(people, "patient_id"), F.col("month"), ["condition_name", *DEMOGRAPHICS], "patient_id")


def estimated_prevalence(patients: DataFrame) -> DataFrame:
    """The counts of :func:`prevalence` from :func:`patient_sketches` of any months, as estimates.

    Their relative standard error is :func:`sketches.relative_error`.
    """
    sick = sketches.estimated(sketches.merged(patients, ["condition_name", *DEMOGRAPHICS]), "patients_with_condition")
    groups = sketches.estimated(sketches.merged(patients, DEMOGRAPHICS), "total_group_patients")
    return sick.join(groups, list(DEMOGRAPHICS)).select(
        "condition_name", *DEMOGRAPHICS, "patients_with_condition", "total_group_patients")


_VISIT_KEY = ["encounter_id", "patient_id"]
# Requests and diagnoses that one task pairs: some 300 MB of memory.
ROWS_PER_PAIRING_TASK = 500_000


def _named_per_visit(df: DataFrame, name: str, count: str) -> DataFrame:
    """How often each name occurs within an encounter of a patient."""
    return df.groupBy(*_VISIT_KEY, name).agg(F.count(F.lit(1)).alias(count))


def _dealt_by_visit(requests: DataFrame, diagnoses: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join by visit, dealt to more tasks than Spark shuffles into if ``rows`` need them.

    A task sorts its part of both sides and counts what they pair to in memory; with a
    fixed number of tasks that grows with the tables.
    """
    parts = -(-rows // ROWS_PER_PAIRING_TASK)
    if parts <= int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return requests, diagnoses
    return requests.repartition(parts, *_VISIT_KEY), diagnoses.repartition(parts, *_VISIT_KEY)


def length_of_stay(encounter: DataFrame, condition: DataFrame, unit: str = "minute",
                   mode_order: str = "desc", with_total: bool = False) -> DataFrame:
    """Stay statistics per encounter type and condition, over encounters joined to conditions.

    Equal conditions of an encounter are counted before the join, so an
    encounter with very many of them brings only its distinct names to one task.
    """
    stay = {"minute": minute_boundaries, "day": day_boundaries}[unit]("start_date", "end_date")
    group = ["encounter_type", "condition_name"]
    stays = encounter.select("encounter_id", "patient_id", "encounter_type", stay.cast("bigint").alias("stay"))
    joined = stays.join(_named_per_visit(condition, "condition_name", "_diagnoses"), _VISIT_KEY, "left")
    weight = F.coalesce("_diagnoses", F.lit(1))
    stats = describe(histogram(joined, group, F.col("stay"), weight=weight), group, mode_order=mode_order)
    return stats.select(
        *group,
        F.col("mode").alias("mode_stay"),
        F.col("median").alias("median_stay"),
        F.col("mean").alias("mean_stay"),
        F.col("min").alias("min_stay"),
        F.col("max").alias("max_stay"),
        round_to("stddev", 2).alias("stddev_stay"),
        *([F.col("total").alias("total_encounters")] if with_total else []),
    )


def medication_patterns(medication: DataFrame, condition: DataFrame,
                        top_k: int | None = None, crowded: bool = False) -> DataFrame:
    """Medications per condition by number of prescriptions, ranked with gaps on ties.

    Prescriptions count every pairing of a request with a condition of the same
    encounter and patient; unpaired requests form the NULL condition. Neither
    side is paired row by row: equal names within an encounter are counted
    first and the counts multiplied, so an encounter with very many rows brings
    only its distinct names to the join. Conditions are ranked by a window each, or
    with ``crowded`` all together by :func:`rank_within`, which writes the counts once
    and needs no task that holds a whole condition. The rows of both sides are counted
    when this is called, since the tasks that pair them must grow in number with them.
    """
    requests, diagnoses = _dealt_by_visit(
        _named_per_visit(medication, "medication_name", "_requests"),
        _named_per_visit(condition, "condition_name", "_diagnoses"),
        medication.count() + condition.count())
    counts = requests.join(diagnoses, _VISIT_KEY, "left").groupBy("medication_name", "condition_name").agg(
        F.count_distinct("patient_id").alias("patients_count"),
        F.sum(F.col("_requests") * F.coalesce("_diagnoses", F.lit(1))).alias("total_prescriptions"),
    )
    if crowded:
        ranked = rank_within(counts, "condition_name", "total_prescriptions")
    else:
        order = Window.partitionBy("condition_name").orderBy(F.col("total_prescriptions").desc())
        ranked = counts.withColumn("rn", F.rank().over(order).cast("bigint"))
    return ranked if top_k is None else ranked.where(F.col("rn") <= top_k)


# How each mart is sorted for presentation, with a full tie-break.
_PRESENTATION = {
    "prevalence": (["patients_with_condition"], ["condition_name", *DEMOGRAPHICS]),
    "length_of_stay": (["mean_stay"], ["encounter_type", "condition_name"]),
    "medication_patterns": ([], ["rn", "condition_name", "medication_name"]),
}


def present(mart: DataFrame, name: str) -> DataFrame:
    """Sort a mart for reading. A global sort; leave it out before a write."""
    descending, ascending = _PRESENTATION[name]
    return mart.orderBy(
        *[F.col(c).desc_nulls_first() for c in descending],
        *[F.col(c).asc_nulls_last() for c in ascending],
    )
