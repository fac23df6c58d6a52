"""Ranks inside groups of any size.

A window per group gathers a group in one task. Here rows are sorted over all tasks by
group and value, ties and all, and a row's rank follows from its place in its part of
the sorted table and from what the parts before hold of its group. Only one row per
part and group is compared across parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelattice.session import written


def rank_within(df: DataFrame, group: str, value: str, name: str = "rn", parts: int | None = None) -> DataFrame:
    """``df`` with the rank of every row by ``value``, largest first, within its ``group``.

    Ranks have gaps on ties, as RANK has. NULL groups are one group; NULL values come
    last and tie with each other. The rows are written once to the shared work folder,
    sorted into ``parts`` parts (by default as many as Spark shuffles into); rows equal
    in group and value may lie in several of them.
    """
    part = "_part"
    split = F.xxhash64(*df.columns)
    # NULL values as the least of all: first by whether there is one, then by size.
    order = [F.col(group).asc_nulls_first(), F.col(value).desc_nulls_last(), split]
    sorted_rows = df.repartitionByRange(*([parts] if parts else []), *order)
    rows = written(sorted_rows.withColumn(part, F.spark_partition_id()), "ranked").withColumn(
        "_group", F.struct(group)).withColumn("_value", F.struct(value))

    inside = Window.partitionBy(part, "_group").orderBy(F.col(value).desc_nulls_last())
    counted = rows.groupBy(part, "_group", "_value").agg(F.count(F.lit(1)).alias("_ties"), F.first(value).alias("_v"))
    least = F.struct(F.col("_v").isNull().alias("missing"), (-F.col("_v")).alias("size"))
    held = counted.groupBy(part, "_group").agg(
        F.sum("_ties").alias("_n"), F.max_by("_value", least).alias("_last"), F.max_by("_ties", least).alias("_last_ties"))

    ahead = Window.partitionBy("_group").orderBy(part)
    same = Window.partitionBy("_group", "_last").orderBy(part)
    before = (
        held.withColumn("_run", F.sum("_last_ties").over(same))
        .select(F.col(part).alias("_p"), F.col("_group").alias("_g"),
                F.coalesce(F.sum("_n").over(ahead.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
                F.lag("_last").over(ahead).alias("_tied"), F.lag("_run").over(ahead).alias("_tied_before"))
    )
    ranked = rows.withColumn("_rank", F.rank().over(inside)).join(
        before, (F.col(part) == F.col("_p")) & (F.col("_group") == F.col("_g")))
    # Rows tied with the end of the part before share the rank of the first of them.
    shared = F.when(F.col("_value") == F.col("_tied"), F.col("_tied_before")).otherwise(0)
    return ranked.select(*df.columns, (F.col("_before") + F.col("_rank") - shared).cast("bigint").alias(name))
