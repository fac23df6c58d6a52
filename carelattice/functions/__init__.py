"""Column functions: cleaning primitives and reusable clinical scalars."""

from carelattice.functions.cleaning import (
    gate,
    gated_double,
    safe_double,
    safe_timestamp,
    strip_quotes,
    strip_trailing_digits,
    trimmed,
)
from carelattice.functions.scalar import (
    age_bucket,
    age_by_calendar_year,
    age_in_years,
    day_boundaries,
    days_between,
    minute_boundaries,
    nullif_zero,
    re_admission,
    round_to,
    safe_divide,
    surrogate_key,
)

__all__ = [
    "age_bucket",
    "age_by_calendar_year",
    "age_in_years",
    "day_boundaries",
    "days_between",
    "gate",
    "gated_double",
    "minute_boundaries",
    "nullif_zero",
    "re_admission",
    "round_to",
    "safe_divide",
    "safe_double",
    "safe_timestamp",
    "strip_quotes",
    "strip_trailing_digits",
    "surrogate_key",
    "trimmed",
]
