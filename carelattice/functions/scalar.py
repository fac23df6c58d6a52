"""Reusable scalar functions over columns.

Date differences count calendar boundaries crossed, not whole units elapsed:
23:50 to 00:10 is one day boundary and twenty minute boundaries.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

# Exclusive upper age of each band and its label.
AGE_BANDS = ((18, "0-17"), (35, "18-34"), (55, "35-54"), (75, "55-74"))
OLDEST_BAND = "75+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _as_date(d: Column | date | str) -> Column:
    return d if isinstance(d, Column) else F.lit(str(d)).cast("date")


def age_bucket(age: Column | str, null_label: str | None = OLDEST_BAND) -> Column:
    """Label of the age band. A missing age falls in the oldest band unless ``null_label`` differs."""
    age = _col(age)
    banded = F.when(age.isNull(), F.lit(null_label))
    for upper, label in AGE_BANDS:
        banded = banded.when(age < upper, F.lit(label))
    return banded.otherwise(F.lit(OLDEST_BAND))


def age_by_calendar_year(birth: Column | str, as_of: Column | date | str) -> Column:
    """Number of new years between birth and ``as_of``."""
    return (F.year(_as_date(as_of)) - F.year(_col(birth))).cast("int")


def age_in_years(birth: Column | str, as_of: Column | date | str) -> Column:
    """Whole years lived, from days over 365.25."""
    days = F.datediff(_as_date(as_of), _col(birth))
    return F.floor(days / F.lit(365.25)).cast("int")


def day_boundaries(start: Column | str, end: Column | str) -> Column:
    """Midnights crossed from start to end."""
    return F.datediff(_col(end), _col(start))


def days_between(start: Column | str, end: Column | str) -> Column:
    """Day difference, NULL when either side is NULL."""
    return day_boundaries(start, end)


def minute_boundaries(start: Column | str, end: Column | str) -> Column:
    """Minute marks crossed from start to end.

    Built from calendar fields, so no session time zone or clock change enters.
    """
    start, end = _col(start), _col(end)
    days = F.datediff(end, start).cast("bigint")
    return days * 1440 + (F.hour(end) - F.hour(start)) * 60 + (F.minute(end) - F.minute(start))


def re_admission(visit: Column | str, patient: Column | str, days: int = 30,
                 tie_break: Sequence[Column | str] = ()) -> Column:
    """Whether the patient's previous visit lies at most ``days`` day boundaries back.

    A plain window expression for use inside ``select``. For data where one
    patient may own a large share of the visits use
    :func:`carelattice.operators.visits.with_visit_gap`, which splits that patient.
    """
    visit = _col(visit)
    order = [visit.asc_nulls_last(), *[_col(t).asc_nulls_last() for t in tie_break]]
    previous = F.lag(visit).over(Window.partitionBy(_col(patient)).orderBy(*order))
    return F.coalesce(F.datediff(visit, previous) <= F.lit(days), F.lit(False))


def round_to(c: Column | str, places: int = 2) -> Column:
    """Round half away from zero to ``places`` decimals (a plain round, not a ceiling)."""
    return F.round(_col(c), places)


def surrogate_key(cols: Sequence[Column | str]) -> Column:
    """MD5 over the text of the columns joined by ``-``, with NULL spelled ``NULL``.

    Format doubles and timestamps to text first where the key must be stable
    across engines.
    """
    parts = [F.coalesce(_col(c).cast("string"), F.lit("NULL")) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as double, 0 where the denominator is 0."""
    n, d = _col(numerator).cast("double"), _col(denominator).cast("double")
    return F.when(d == 0, F.lit(0.0)).otherwise(n / d)


def nullif_zero(c: Column | str) -> Column:
    """NULL where the value is 0."""
    return F.nullif(_col(c), F.lit(0))
