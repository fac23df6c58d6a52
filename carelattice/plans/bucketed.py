"""Staging tables laid out by visit, and enrichments that join them where they lie.

Every table of a visit is written once in buckets of its encounter, sorted within.
Joins of such tables need neither shuffle nor sort. Visits whose joins make more rows
than a task should hold are known from counts taken on the same layout; they leave
the bucketed joins and go through the split ones of :mod:`operators.skew`.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelattice.operators import skew
from carelattice.operators.enrich import JoinSpec, enrich
from carelattice.plans import enrichment
from carelattice.session import work_path, written

VISIT = "encounter_id"


def by_visit(staged: Mapping[str, DataFrame], buckets: int | None = None) -> dict[str, DataFrame]:
    """The tables of ``staged`` that have a visit, bucketed by it and sorted; others as they are.

    ``buckets`` is the number of files of a table; by default as many as Spark shuffles
    into. The tables live in the session's catalog under new names, their files in the
    shared work folder.
    """
    laid = dict(staged)
    for name, df in staged.items():
        if VISIT not in df.columns:
            continue
        spark, table = df.sparkSession, f"by_visit_{name}_{uuid.uuid4().hex}"
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        df.repartition(n, VISIT).write.bucketBy(n, VISIT).sortBy(VISIT).option(
            "path", work_path(spark, f"by-visit-{name}")).saveAsTable(table)
        laid[name] = spark.table(table)
    return laid


def _heavy_visits(base: DataFrame, specs: list[JoinSpec], rows_per_task: int) -> DataFrame:
    """Visits that make more than ``rows_per_task`` rows; counted bucket by bucket, written once."""
    def counts(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col(VISIT).isNotNull()).groupBy(VISIT).agg(F.count(F.lit(1)).cast("double").alias(name))

    joined = reduce(
        lambda left, i: left.join(counts(specs[i].table, f"n{i}"), VISIT, "left"), range(len(specs)), counts(base, "n"))
    rows = reduce(lambda x, i: x * F.coalesce(f"n{i}", F.lit(1.0)), range(len(specs)), F.col("n"))
    return written(joined.where(rows > rows_per_task).select(F.col(VISIT).alias(f"{skew._KEY}{VISIT}")), "heavy-visits")


def enriched(name: str, laid: Mapping[str, DataFrame], rows_per_task: int = skew.ROWS_PER_TASK) -> DataFrame:
    """Enrichment ``name`` over tables of :func:`by_visit`; rows as those of :func:`enrichment.model`."""
    calm, heavy = parts(name, laid, rows_per_task)
    return calm.unionByName(heavy)


def parts(name: str, laid: Mapping[str, DataFrame], rows_per_task: int = skew.ROWS_PER_TASK) -> tuple[DataFrame, DataFrame]:
    """The rows of the visits that are joined in their buckets, and those of the heavy ones."""
    base, specs = enrichment.joins(name, laid)
    if any(VISIT not in spec.on for spec in specs):
        raise ValueError(f"{name} does not join by visit")
    heavy = _heavy_visits(base, specs, rows_per_task)
    split = [skew.split_heavy(t, [VISIT], heavy) for t in (base, *[s.table for s in specs])]
    calm = split[0][0]
    for i, spec in enumerate(specs):
        right = split[i + 1][0].select(
            *[F.col(c).alias(f"_on_{c}") for c in spec.on], *[F.col(c).alias(spec.rename.get(c, c)) for c in spec.columns])
        same = F.col(VISIT) == F.col(f"_on_{VISIT}")
        for c in spec.on:
            if c != VISIT:
                # Equality as a condition on the pair, so that the buckets' key alone is the join's.
                same = same & F.col(c).between(F.col(f"_on_{c}"), F.col(f"_on_{c}"))
        calm = calm.join(right, same, "left").drop(*[f"_on_{c}" for c in spec.on])
    hot = [JoinSpec(split[i + 1][1], s.on, s.columns, s.rename) for i, s in enumerate(specs)]
    return calm, enrich(split[0][1], hot, rows_per_task)
