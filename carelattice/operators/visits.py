"""Distance from a patient's previous visit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelattice.operators import skew

GAP = "days_since_last_visit"


def with_visit_gap(visits: DataFrame, patient: str, start: str, tie_break: Sequence[str],
                   rows_per_task: int = skew.ROWS_PER_TASK, counted: DataFrame | None = None) -> DataFrame:
    """Add ``days_since_last_visit``: day boundaries since the patient's previous visit.

    Visits are ordered by ``start`` (missing last), then ``tie_break``; of rows
    equal in all of these any one counts as the earlier. NULL for a first visit
    and for a visit without a start. One shuffle on the patient and a LAG; patients
    with more than ``rows_per_task`` visits go through :func:`_gap_by_day` instead.
    ``counted`` is a cheaper DataFrame with the same patients to count them in.
    """
    heavy = skew.heavy_keys(visits if counted is None else counted, [patient], rows_per_task)
    calm, hot = skew.split_heavy(visits, [patient], heavy)
    return _gap_by_lag(calm, patient, start, tie_break).unionByName(_gap_by_day(hot, patient, start, tie_break))


def _gap_by_lag(visits: DataFrame, patient: str, start: str, tie_break: Sequence[str]) -> DataFrame:
    order = [F.col(start).asc_nulls_last(), *[F.col(t).asc_nulls_last() for t in tie_break]]
    previous = F.lag(start).over(Window.partitionBy(patient).orderBy(*order))
    return visits.withColumn(GAP, F.datediff(F.col(start), previous).cast("bigint"))


def _gap_by_day(visits: DataFrame, patient: str, start: str, tie_break: Sequence[str]) -> DataFrame:
    """The same gap without gathering one patient's visits in a task.

    A visit that is not the first of its day has its predecessor on that day, so
    its gap is 0. The first visit of a day is found by an aggregate that combines
    before the shuffle, and its gap needs only the patient's list of days, which
    the calendar bounds.
    """
    day, first = "_day", "_first"
    order = [start, *tie_break]
    # Missing tie-break values sort last, as in the LAG route.
    rank = F.struct(
        F.col(start), *[x for t in tie_break for x in (F.col(t).isNull(), F.col(t))]
    )
    firsts = (
        visits.where(F.col(start).isNotNull())
        .groupBy(patient, F.to_date(start).alias(day))
        .agg(F.min_by(F.struct(*order), rank).alias(first))
    )
    by_day = Window.partitionBy(patient).orderBy(day)
    firsts = firsts.select(
        F.col(patient).alias("_patient"),
        *[F.col(first)[c].alias(f"_{c}") for c in order],
        F.datediff(F.col(day), F.lag(day).over(by_day)).cast("bigint").alias("_gap"),
        F.lit(True).alias("_is_first"),
    )
    same = F.col(patient).eqNullSafe(F.col("_patient"))
    for c in order:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    # Of rows equal in patient and order only one is the first. Equal rows are counted
    # before they are shuffled, and written out again as often as they came.
    columns = visits.columns
    counted = visits.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    one = Window.partitionBy(patient, *order).orderBy(*[c for c in columns if c not in (patient, *order)] or [F.lit(0)])
    numbered = counted.withColumn("_copy", F.row_number().over(one))
    is_first = F.col("_is_first") & (F.col("_copy") == 1)
    gap = F.when(is_first, F.col("_gap")).when(F.col(start).isNotNull(), F.lit(0)).cast("bigint")
    again = F.when(F.col(start).isNotNull(), F.lit(0)).cast("bigint")
    kinds = F.array(F.struct(gap.alias(GAP), F.lit(1).cast("bigint").alias("_copies")),
                    F.struct(again.alias(GAP), (F.col("_copies") - 1).alias("_copies")))
    found = numbered.join(firsts, same, "left").select(*columns, F.inline(kinds))
    return skew.repeat_rows(found, "_copies").select(*columns, GAP)
