"""Cleaning primitives, each ``Column -> Column`` and free of Python UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that a 64-bit float column accepts. Spark's own cast would also take a
# type suffix such as "1.0d", which is not a number in a text column.
FLOAT_TEXT = r"\A\s*(?:[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)\s*\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: Column | str) -> Column:
    """Remove leading and trailing spaces (spaces only, not tabs or newlines)."""
    return F.trim(_col(c))


def strip_quotes(c: Column | str) -> Column:
    """Trim, then delete every double quote."""
    return F.replace(F.trim(_col(c)), F.lit('"'), F.lit(""))


def safe_timestamp(c: Column | str) -> Column:
    """Text to a zone-less timestamp; unreadable text becomes NULL, an offset is dropped."""
    return _col(c).try_cast("timestamp_ntz")


def safe_double(c: Column | str) -> Column:
    """Text to double; anything that is not a plain number becomes NULL."""
    c = _col(c)
    return F.when(c.rlike(FLOAT_TEXT), c.try_cast("double"))


def gate(c: Column | str, pattern: str, tested: Column | None = None) -> Column:
    """The trimmed value where the whole text matches ``pattern``, NULL elsewhere.

    ``tested`` is the text the pattern is applied to, the untrimmed value by
    default. ``\\z`` rather than ``$`` so a trailing newline does not slip through.
    """
    c = _col(c)
    tested = c if tested is None else tested
    return F.when(tested.rlike(rf"\A(?:{pattern})\z"), F.trim(c))


def gated_double(c: Column | str, pattern: str) -> Column:
    """A double where the trimmed text matches ``pattern``, NULL elsewhere."""
    c = _col(c)
    return F.when(F.trim(c).rlike(rf"\A(?:{pattern})\z"), F.trim(c).try_cast("double"))


def strip_trailing_digits(c: Column | str) -> Column:
    """Drop the digits that end the text, then trim."""
    return F.trim(F.regexp_replace(_col(c), r"[0-9]+\z", ""))
