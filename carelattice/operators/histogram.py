"""Distribution statistics from one value histogram.

Counting equal values first shrinks the data before anything else happens: the
shuffle carries (group, value, count), and every statistic is derived from it.
A group of any size costs no task more than its number of distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_EXACT = "decimal(38,0)"


def histogram(df: DataFrame, group: Sequence[str], value: Column, name: str = "value",
              weight: Column | None = None) -> DataFrame:
    """Rows per (group, value); NULL values are a value of their own."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(*group, value.alias(name)).agg(n.alias("n"))


def describe(hist: DataFrame, group: Sequence[str], name: str = "value",
             mode_order: str = "desc") -> DataFrame:
    """Total, mean, median, min, max, sample deviation and mode of an integer value per group.

    ``total`` counts NULL values, the other statistics ignore them, but NULL may
    be the mode. ``mode_order`` "desc" takes the most frequent value, "asc" the
    rarest; ties go to the smallest value, NULL last. A group with a NULL in its
    key has no mode.
    """
    if mode_order not in ("asc", "desc"):
        raise ValueError("mode_order is 'asc' or 'desc'")
    v, n = F.col(name), F.col("n")
    known = F.when(v.isNotNull(), n)
    frequency = -n if mode_order == "desc" else n
    sums = hist.groupBy(*group).agg(
        F.sum(n).alias("total"),
        F.sum(known).alias("_n"),
        F.sum(known.cast(_EXACT) * v.cast("decimal(19,0)")).cast(_EXACT).alias("_s1"),
        F.sum(known.cast(_EXACT) * v.cast("decimal(19,0)") * v.cast("decimal(19,0)"))
        .cast(_EXACT).alias("_s2"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        # Weighted and exact: its state is one entry per distinct value.
        F.percentile(v, 0.5, known).alias("median"),
        F.min(F.struct(frequency.alias("f"), v.isNull().alias("missing"), v.alias("v"))).alias("_mode"),
    )
    # Squares are summed around the integer part of the mean, in whole numbers,
    # so large groups lose no precision.
    q = F.floor(F.col("_s1") / F.col("_n")).cast("decimal(19,0)")
    around_q = F.col("_s2") - 2 * q * F.col("_s1") + q * q * F.col("_n")
    rest = (F.col("_s1") - q * F.col("_n")).cast("double")
    squares = around_q.cast("double") - rest * rest / F.col("_n").cast("double")
    deviation = F.sqrt(F.greatest(squares, F.lit(0.0)) / (F.col("_n") - 1).cast("double"))
    whole_key = F.lit(True)
    for g in group:
        whole_key = whole_key & F.col(g).isNotNull()
    return sums.select(
        *group,
        "total",
        (F.col("_s1").cast("double") / F.col("_n").cast("double")).alias("mean"),
        "median",
        "min",
        "max",
        F.when(F.col("_n") > 1, deviation).alias("stddev"),
        F.when(whole_key, F.col("_mode")["v"]).alias("mode"),
    )
