"""Joins and lookups that stay balanced when single keys hold a large share of the rows.

AQE splits an oversized partition on the preserved side of a left join only, and
not where a later join on the same key would need another shuffle. Clinical data
has both problems: one encounter may own a third of all claims, and the claim
table sits on the other side. So rows are counted per key on both sides, and keys
whose join would give one task more than a fixed number of rows are spread over a
grid of cells, a part of each side meeting in each cell. Everything is one lazy
plan of the same shape at every size; counts are combined before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows one task may produce or hold for one key. A key beyond it is split, so there
# are at most (rows produced) / ROWS_PER_TASK such keys, which bounds the broadcast
# of their table: 250,000 keys for a join of 10^12 rows.
ROWS_PER_TASK = 4_000_000
# Cells of one key in one join. With a cells, L left and R right rows, about
# 2 * sqrt(a * L * R) rows are shuffled, so cells without end would cost far more than
# the rows they spread; a cell holds sqrt(L * R / a) rows and streams what it produces.
MOST_CELLS = 1 << 12
_KEY = "_heavy_"


def _same_key(keys: Sequence[str]) -> Column:
    """Equality with the renamed keys of a heavy table; a NULL key is a key of its own."""
    return reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"{_KEY}{k}")) for k in keys])


def heavy_keys(df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows, under their names with a prefix."""
    return (
        df.groupBy(*[F.col(k).alias(f"{_KEY}{k}") for k in keys])
        .agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_task).drop("_n")
    )


def split_heavy(df: DataFrame, keys: Sequence[str], heavy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` whose key is not, and is, in the table of :func:`heavy_keys`."""
    return tuple(df.join(F.broadcast(heavy), _same_key(keys), how) for how in ("left_anti", "left_semi"))


def heavy_cells(base: DataFrame, tables: Sequence[DataFrame], keys: Sequence[str],
                rows_per_task: int = ROWS_PER_TASK, most_cells: int = MOST_CELLS) -> DataFrame:
    """How to split the heavy keys of ``base`` left-joined to each of ``tables`` in turn.

    One row per key that needs it: the key under prefixed names, and for join i the
    number of cells of the left side (``_a<i>``) and of the right side (``_b<i>``).
    With L left and R right rows the grid has about L x R / rows_per_task cells, but
    no more than about ``most_cells``, cut so that few rows are repeated. Keys without a partner on the right are spread on
    the left alone. Keys are counted once for all joins, in one shuffle.
    """
    names = [f"{_KEY}{k}" for k in keys]
    sources = [base, *[t.na.drop(subset=list(keys)) for t in tables]]
    counted = [
        s.select(*[F.col(k).alias(n) for k, n in zip(keys, names)],
                 *[F.lit(int(i == j)).cast("double").alias(f"_n{j}") for j in range(len(sources))])
        for i, s in enumerate(sources)
    ]
    counts = reduce(DataFrame.unionAll, counted).groupBy(*names).agg(
        *[F.sum(f"_n{j}").alias(f"_n{j}") for j in range(len(sources))]).where("_n0 > 0")
    left, cells = F.col("_n0"), []
    for i in range(1, len(sources)):
        right = F.col(f"_n{i}")
        made = left * F.greatest(right, F.lit(1.0))
        limit = F.greatest(F.lit(float(rows_per_task)), made / most_cells)
        side = F.sqrt(limit)
        both = F.ceil(made / limit)
        a = F.when(right <= side, both).when(left <= side, F.lit(1)).otherwise(F.ceil(left / side))
        b = F.when(right <= side, F.lit(1)).when(left <= side, both).otherwise(F.ceil(right / side))
        cells += [a.cast("int").alias(f"_a{i}"), b.cast("int").alias(f"_b{i}")]
        left = made
    found = counts.select(*names, *cells)
    split = reduce(lambda x, y: x | y, [F.col(f"_{x}{i}") > 1 for x in "ab" for i in range(1, len(sources))])
    return found.where(split)


def balanced_left_join(left: DataFrame, right: DataFrame, keys: Sequence[str], cells: DataFrame,
                       number: int = 1) -> DataFrame:
    """``left.join(right, keys, "left")`` with the heavy keys split as ``cells`` says for join ``number``.

    A left row lies in one row of its key's grid and is repeated along it, a right
    row in one column and repeated along that; other keys have a grid of one cell.
    Where the right side is split, a left row finds nothing in some cells; those
    empty results are dropped, since its key is known to have partners. Repeated
    rows never outnumber the join's own output. Rows equal in every column share a
    cell.
    """
    keys = list(keys)
    names = [f"{_KEY}{k}" for k in keys]
    out = [*left.columns, *[c for c in right.columns if c not in keys]]
    grid = F.broadcast(cells.select(*names, F.col(f"_a{number}").alias("_a"), F.col(f"_b{number}").alias("_b")))

    def placed(df: DataFrame, own: str, across: str, mine: str, other: str) -> DataFrame:
        # By content, not at random: a recomputed task must place its rows as before.
        cell = F.when(F.col(own) > 1, F.pmod(F.xxhash64(*df.columns), F.col(own)).cast("int")).otherwise(F.lit(0))
        along = F.when(F.col(across) > 1, F.sequence(F.lit(0), F.col(across) - 1)).otherwise(F.array(F.lit(0)))
        return df.join(grid, _same_key(keys), "left").select("*", cell.alias(mine), F.explode(along).alias(other))

    a = placed(left, "_a", "_b", "_i", "_j").withColumn("_split", F.coalesce(F.col("_b") > 1, F.lit(False)))
    b = placed(right, "_b", "_a", "_j", "_i").withColumn("_found", F.lit(True))
    a = a.select(*left.columns, "_i", "_j", "_split")
    b = b.select(*right.columns, "_i", "_j", "_found")
    joined = a.join(b, [*keys, "_i", "_j"], "left")
    return joined.where(~F.col("_split") | F.col("_found").isNotNull()).select(*out)


def repeat_rows(df: DataFrame, copies: str, chunk: int = 10_000) -> DataFrame:
    """Emit each row ``copies`` times (a bigint column, dropped from the result).

    A row with very many copies is first cut into chunks that shuffle apart, so
    no task has to write them all and no large array is built.
    """
    cols = [c for c in df.columns if c != copies]
    chunks = (
        df.where(F.col(copies) > 0)
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col(copies) - 1) / chunk))))
        .withColumn("_size", F.least(F.lit(chunk), F.col(copies) - F.col("_chunk") * chunk))
        .drop(copies)
    )
    spread = chunks.repartition(*[F.col(c) for c in cols], F.col("_chunk"))
    return spread.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_size")))).select(*cols)
