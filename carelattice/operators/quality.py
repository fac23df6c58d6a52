"""Declared data-quality checks, run as one aggregate per scan."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """One assertion on one column. ``values`` belongs to accepted_values, ``parent`` to relationship."""

    table: str
    column: str
    kind: str
    severity: str = "error"
    values: tuple[str, ...] = ()
    parent: str | None = None
    parent_column: str | None = None


class QualityError(Exception):
    """At least one error-severity check failed."""


@dataclass(frozen=True)
class Scan:
    """One DataFrame that holds the columns of several checked tables.

    ``tables`` gives, per table name, its columns as expressions. ``rows`` may
    name a column that says how many rows of a table a row stands for.
    """

    df: DataFrame
    tables: Mapping[str, Mapping[str, Column]]
    rows: Mapping[str, str] = field(default_factory=dict)


def _row_failure(check: Check, c: Column) -> Column:
    if check.kind == "not_null":
        return c.isNull()
    return c.isNotNull() & ~c.isin(*check.values)


def _counted(scan: Scan, checks: Sequence[Check]) -> DataFrame:
    """All checks of a scan in one pass and, where a key is checked, one shuffle.

    Per row one entry for every checked key: the key, the rows it stands for and the
    failures of the row checks. Keys that are equal in a row, as those of a raw row and
    its cleaned one mostly are, share an entry with counts for each. Entries are
    combined per key before the shuffle; a key that occurs n times travels as at most
    one row per task.
    """
    entries: list[tuple[str, str | None, list[Check]]] = []
    for table in dict.fromkeys(c.table for c in checks):
        mine = [c for c in checks if c.table == table]
        keys = list(dict.fromkeys(c.column for c in mine if c.kind == "unique")) or [None]
        entries += [(table, k, [c for c in mine if c.kind != "unique"] if i == 0 else []) for i, k in enumerate(keys)]
    own = {f"_key{i}": (F.lit(None) if k is None else scan.tables[t][k]).cast("string") for i, (t, k, _) in enumerate(entries)}

    def same(i: int, j: int) -> Column:
        return F.lit(True) if i == j else F.col(f"_key{i}").eqNullSafe(F.col(f"_key{j}"))

    def sums(i: int) -> list[Column]:
        """What the entries with the key of entry ``i`` add to the counts."""
        found = []
        for j, (table, _, rows) in enumerate(entries):
            weight = F.col(scan.rows[table]) if table in scan.rows else F.lit(1).cast("bigint")
            found += [F.when(same(i, j), weight).alias(f"n{j}")] + [
                F.when(same(i, j) & _row_failure(c, scan.tables[table][c.column]), weight).alias(f"p{j}_{k}")
                for k, c in enumerate(rows)]
        return found

    def entry(i: int) -> Column:
        earlier = reduce(lambda x, y: x | y, [same(i, j) for j in range(i)], F.lit(False))
        return F.struct((~earlier).alias("used"), F.col(f"_key{i}").alias("key"), *sums(i))

    spread = scan.df.withColumns(own).select(F.inline(F.array(*[entry(i) for i in range(len(entries))]))).where("used")
    names = [c for c in spread.columns if c not in ("used", "key")]
    per_key = spread.groupBy("key").agg(*[F.sum(c).alias(c) for c in names])
    counts = []
    for i, check in enumerate(checks):
        if check.kind == "unique":
            number = next(k for k, (t, key, _) in enumerate(entries) if (t, key) == (check.table, check.column))
            counts.append(F.count_if(F.col("key").isNotNull() & (F.col(f"n{number}") > 1)).alias(f"c{i}"))
        else:
            number, slot = next((k, r.index(check)) for k, (_, _, r) in enumerate(entries) if check in r)
            counts.append(F.coalesce(F.sum(f"p{number}_{slot}"), F.lit(0)).alias(f"c{i}"))
    return _report(per_key.agg(*counts), checks)


def _relationship(child: DataFrame, parent: DataFrame, check: Check) -> DataFrame:
    """Child rows whose reference has no parent; NULL references pass.

    References are counted per value first, so a popular value is one row.
    """
    refs = (
        child.where(F.col(check.column).isNotNull())
        .groupBy(F.col(check.column).alias("_ref"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    keys = parent.select(F.col(check.parent_column).alias("_ref")).distinct()
    counts = refs.join(keys, "_ref", "left_anti").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("c0"))
    return _report(counts, [check])


def _report(counts: DataFrame, checks: Sequence[Check]) -> DataFrame:
    rows = [
        F.struct(
            F.lit(c.table).alias("table_name"),
            F.lit(c.column).alias("column_name"),
            F.lit(c.kind).alias("check_name"),
            F.lit(c.severity).alias("severity"),
            F.col(f"c{i}").cast("bigint").alias("failures"),
            (F.col(f"c{i}") == 0).alias("passed"),
        )
        for i, c in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def run_checks(tables: Mapping[str, DataFrame] | Sequence[Scan], checks: Sequence[Check],
               settled: Callable[[list[DataFrame]], list[DataFrame]] = lambda parts: parts) -> DataFrame:
    """One row per check: table, column, check, severity, failures, passed.

    ``tables`` are DataFrames by name, or scans that each hold several tables.
    ``settled`` may compute the parts of the report, one per scan and relationship,
    before they are put together; by default all are one query.
    """
    if isinstance(tables, Mapping):
        tables = [Scan(df, {name: {c: F.col(c) for c in df.columns}}) for name, df in tables.items()]
    parts = []
    for scan in tables:
        mine = [c for c in checks if c.table in scan.tables and c.kind != "relationship"]
        if mine:
            parts.append(_counted(scan, mine))
    home = {name: scan for scan in tables for name in scan.tables}

    def column(table: str, name: str) -> DataFrame:
        return home[table].df.select(home[table].tables[table][name].alias(name))

    parts += [
        _relationship(column(c.table, c.column), column(c.parent, c.parent_column), c)
        for c in checks if c.kind == "relationship"
    ]
    return reduce(DataFrame.unionAll, settled(parts))


def require(report: DataFrame, allowed: Collection[tuple[str, str, str]] = ()) -> DataFrame:
    """Raise where an error-severity check failed; warnings pass. Returns the report.

    ``allowed`` names (table, column, check) that are known to fail.
    """
    failed = report.where((F.col("severity") == "error") & ~F.col("passed")).collect()
    text = "; ".join(
        f"{r['table_name']}.{r['column_name']} {r['check_name']}: {r['failures']}" for r in failed
        if (r["table_name"], r["column_name"], r["check_name"]) not in set(allowed)
    )
    if text:
        raise QualityError(text)
    return report
