"""Distinct counts that can be added up: a sketch per period and group.

An exact distinct count of many months needs all months. Sketches of a month are made
once, kept, and united over any months; the result is an estimate whose relative
standard error depends on the sketch's size alone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Binary logarithm of a sketch's number of buckets: 4,096, in at most some 4 KB.
LG_BUCKETS = 12


def relative_error(lg_buckets: int = LG_BUCKETS) -> float:
    """The standard error of an estimate, relative to the count."""
    return 1.04 / math.sqrt(1 << lg_buckets)


def sketch(df: DataFrame, period: Column, group: Sequence[str], counted: str, lg_buckets: int = LG_BUCKETS) -> DataFrame:
    """(period, group, ids): one sketch of the distinct values of ``counted`` per period and group.

    NULL values are not counted. A period or group that is NULL is one of its own.
    """
    return df.groupBy(period.alias("period"), *group).agg(
        F.hll_sketch_agg(F.col(counted).cast("string"), lg_buckets).alias("ids"))


def merged(sketches: DataFrame, group: Sequence[str]) -> DataFrame:
    """(group, ids): sketches united over periods; ``group`` may be coarser than that of the sketches."""
    return sketches.groupBy(*group).agg(F.hll_union_agg("ids").alias("ids"))


def estimated(sketches: DataFrame, name: str) -> DataFrame:
    """``sketches`` with the estimated number of distinct values instead of the sketch."""
    return sketches.withColumn(name, F.hll_sketch_estimate("ids")).drop("ids")
