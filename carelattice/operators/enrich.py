"""Declarative LEFT JOIN chains."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelattice.operators import skew

# How many output rows a base row has, added by :func:`fan_out`.
ROWS = "_rows"


@dataclass(frozen=True)
class JoinSpec:
    """One joined table: equality on ``on``, the columns it adds, and their new names."""

    table: DataFrame
    on: tuple[str, ...]
    columns: tuple[str, ...]
    rename: Mapping[str, str] = field(default_factory=dict)


def enrich(base: DataFrame, specs: Sequence[JoinSpec], rows_per_task: int = skew.ROWS_PER_TASK,
           cells: Mapping[tuple[str, ...], DataFrame] | None = None) -> DataFrame:
    """LEFT JOIN every spec onto ``base`` in order; all base columns are kept.

    Fan-out is honest: a base row appears once per matching combination. Keys
    whose join exceeds ``rows_per_task`` are split, see :mod:`skew`. A caller
    that joins the same tables often may pass ``cells`` by join key, the result
    of :func:`skew.heavy_cells` kept as a table. Two columns of one name are
    refused, rename one of them.
    """
    names = list(base.columns)
    for spec in specs:
        names += [spec.rename.get(c, c) for c in spec.columns]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"duplicate output columns: {', '.join(repeated)}")

    groups: dict[tuple[str, ...], list[DataFrame]] = {}
    for spec in specs:
        groups.setdefault(tuple(spec.on), []).append(spec.table)
    cells = dict(cells or {})
    for on, tables in groups.items():
        if on not in cells:
            cells[on] = skew.heavy_cells(base, tables, on, rows_per_task)
    done = dict.fromkeys(groups, 0)
    result = base
    for spec in specs:
        on = tuple(spec.on)
        done[on] += 1
        right = spec.table.select(
            *on, *[F.col(c).alias(spec.rename.get(c, c)) for c in spec.columns])
        result = skew.balanced_left_join(result, right, on, cells[on], done[on])
    return result.select(*names)


def fan_out(base: DataFrame, specs: Sequence[JoinSpec]) -> DataFrame:
    """``base`` with the number of rows :func:`enrich` makes of each of its rows, without making them.

    Joined tables are reduced to counts per key first.
    """
    result, factors = base, []
    for i, spec in enumerate(specs):
        count = f"_matches{i}"
        result = result.join(
            spec.table.groupBy(*spec.on).agg(F.count(F.lit(1)).alias(count)), list(spec.on), "left")
        factors.append(F.coalesce(count, F.lit(1)))
    rows = reduce(lambda x, y: x * y, factors, F.lit(1).cast("bigint"))
    return result.select(*base.columns, rows.alias(ROWS))
