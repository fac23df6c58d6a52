"""High-water-mark loads and keyed merges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: the high-water mark of a target without any.
EARLIEST = "1900-01-01"


def incremental_filter(source: DataFrame, target: DataFrame | None, watermark: str,
                       lookback: str | None = None, default: str | None = EARLIEST) -> DataFrame:
    """Source rows strictly later than the target's largest watermark.

    Without a target every row passes, also those without a watermark. On later
    runs rows with an equal, earlier or missing watermark are left out, unless
    ``lookback`` (an interval such as ``"3 days"``) moves the mark back for late
    data. ``default`` stands in for the mark of an empty target; ``None`` lets
    an empty target keep everything out. The mark is a scalar subquery, so the
    comparison is an ordinary filter on the source.
    """
    if target is None:
        return source
    mark = F.max(watermark)
    if default is not None:
        mark = F.coalesce(mark, F.lit(default).cast(target.schema[watermark].dataType))
    if lookback is not None:
        mark = mark - F.expr(f"INTERVAL {lookback}")
    return source.where(F.col(watermark) > target.agg(mark.alias("mark")).scalar())


def deduplicate(df: DataFrame, key: str, order_by: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``order_by``; rows without a key are all kept.

    The ``rank = 1`` filter lets Spark drop the losers of a key before the
    shuffle, so a key with very many copies does not gather in one task. Rows
    without a key get a number of their own and spread over all tasks.
    """
    own = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    order = Window.partitionBy(key, "_own").orderBy(*order_by)
    return (
        df.withColumn("_own", own)
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") == 1)
        .drop("_own", "_rank")
    )


def newest_first(watermark: str, tie_break: Sequence[str]) -> list[Column]:
    """Latest watermark first, then the tie-break columns descending."""
    return [F.col(c).desc_nulls_last() for c in (watermark, *tie_break)]


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def upsert(old: DataFrame | None, new: DataFrame, key: str, order_by: Sequence[Column] | None = None,
           on_duplicate: str = "newest", keep: str = "new") -> DataFrame:
    """Merge ``new`` into ``old``: a known key is replaced whole, an unknown one added.

    Nothing is deleted, and applying the same batch again changes nothing. Copies
    of a key inside ``new`` are settled by ``order_by``, or refused with
    ``on_duplicate="error"``. With ``keep="first"`` the first by ``order_by`` among
    the old row and the new ones stays, so an older row that comes late does not
    replace a newer one; the old row stays on a tie. Rows without a key match no
    other row; equal ones are kept once. A column that only one side has is NULL in
    the other's rows. Only the keys of the batch meet the old table; a batch small
    enough by Spark's own statistics is broadcast, and the old table then passes
    through without a shuffle.
    """
    if on_duplicate == "error":
        example = duplicate_keys(new, key).first()
        if example is not None:
            raise ValueError(f"batch holds {example['n']} rows for {key} = {example[key]!r}")
        winners = new
    elif order_by:
        winners = deduplicate(new, key, order_by)
    else:
        raise ValueError("give order_by, or on_duplicate='error'")
    if old is None:
        return without_repeated_keyless(winners, key)
    if keep == "first":
        winners = first_of_both(old, winners, key, order_by)
    merged = without_keys(old, new, key).unionByName(winners, allowMissingColumns=True)
    return without_repeated_keyless(merged, key)


def without_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``old`` whose key ``new`` does not bring.

    The keys are reduced to distinct ones on the way into the shuffle the join
    needs anyway, so many copies of one key travel as one row per task.
    """
    return old.join(new.select(key).distinct(), key, "left_anti").select(*old.columns)


def first_of_both(old: DataFrame, winners: DataFrame, key: str, order_by: Sequence[Column]) -> DataFrame:
    """Per key of ``winners`` the first by ``order_by`` of that row and the old one; ties keep the old row."""
    met = old.join(winners.select(key).where(F.col(key).isNotNull()), key, "left_semi").select(*old.columns)
    both = met.withColumn("_is_new", F.lit(0)).unionByName(
        winners.withColumn("_is_new", F.lit(1)), allowMissingColumns=True)
    return deduplicate(both, key, [*order_by, F.col("_is_new")]).drop("_is_new")


def without_repeated_keyless(df: DataFrame, key: str) -> DataFrame:
    """``df`` with rows that have no key and are equal in all columns kept once."""
    return df.where(F.col(key).isNotNull()).unionByName(df.where(F.col(key).isNull()).distinct())
