"""The whole batch: raw tables to staging snapshots, checks, and marts.

Materialization per layer: staging tables are keyed incremental merges, patients
a view, enrichments inlined, marts rewritten in full. All declared checks run
between the staging tables and the marts and stop the batch if one fails.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from carelattice.operators.incremental import incremental_filter, newest_first
from carelattice.operators.quality import require, run_checks
from carelattice.plans import checks, marts
from carelattice.plans.staging import stage
from carelattice.schemas import TABLES
from carelattice.session import freed_shuffles, settings, side_by_side, small_splits, written
from carelattice.sources import landing
from carelattice.sources.snapshots import SnapshotTable


# Steps run side by side: each keeps on disk what it shuffles until it ends.
_AT_ONCE = 2


@dataclass(frozen=True)
class Refreshed:
    staged: dict[str, DataFrame]
    marts: dict[str, DataFrame]
    report: DataFrame


def staging_snapshot(spark: SparkSession, root: str, table: str, split: str = "month") -> SnapshotTable:
    """The staging table of ``table``, split by the month (or year) of its watermark."""
    spec = TABLES[table]
    return SnapshotTable(spark, f"{root}/staging", table, spec.watermark, split, indexed_by=spec.key)


def load_increment(snapshot: SnapshotTable, staged: DataFrame, table: str,
                   lookback: str | None = None) -> DataFrame:
    """Merge the rows beyond the snapshot's high-water mark into it; returns the current version.

    The mark is read from the latest month alone. Without new rows nothing is
    written. With ``lookback`` rows behind the mark come too; they replace only
    rows that are not newer.
    """
    spec = TABLES[table]
    fresh = incremental_filter(staged, snapshot.newest(), spec.watermark, lookback)
    _merge(snapshot, fresh, table, keep="first" if lookback else "new")
    return snapshot.read()


def load_day(snapshot: SnapshotTable, landed: str, table: str, load_date: date, as_of: date | str,
             fmt: str = "csv") -> DataFrame:
    """Merge one landed day into the snapshot; returns the current version.

    Only that day's folder is read. Days may be loaded in any order and again: the
    newest row of a key by watermark stays.
    """
    raw = landing.read_landed(snapshot.spark, landed, table, load_date, fmt)
    _merge(snapshot, stage(raw, table, as_of), table, keep="first")
    return snapshot.read()


def _merge(snapshot: SnapshotTable, rows: DataFrame, table: str, keep: str) -> None:
    spec = TABLES[table]
    others = [c for c in rows.columns if c not in (spec.key, spec.watermark)]
    snapshot.merge(rows, spec.key, newest_first(spec.watermark, others), keep=keep)


def staging_layer(spark: SparkSession, raw: Mapping[str, DataFrame], root: str,
                  as_of: date | str, split: str = "month") -> dict[str, DataFrame]:
    """Every staging table; those that are merged are merged side by side."""
    staged = {name: stage(df, name, as_of) for name, df in raw.items()}
    merged = _merged(spark, {
        name: partial(load_increment, staging_snapshot(spark, root, name, split), staged[name], name)
        for name in raw if TABLES[name].watermark})
    return staged | merged


def _merged(spark: SparkSession, merges: Mapping[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """The results of merges of different tables. The settings of a merge hold for all of them, so none takes them from another."""
    with settings(spark, small_splits() | freed_shuffles()):
        return side_by_side(spark, merges, _AT_ONCE)


def mart_layer(staged: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The four marts as lazy DataFrames."""
    return {
        "readmissions": marts.readmissions(staged["encounter"]),
        "prevalence": marts.prevalence(staged["condition"], staged["patient"]),
        "length_of_stay": marts.length_of_stay(staged["encounter"], staged["condition"]),
        "medication_patterns": marts.medication_patterns(
            staged["medication_request"], staged["condition"]
        ),
    }


def checked(raw: Mapping[str, DataFrame], staged: Mapping[str, DataFrame]) -> DataFrame:
    """The report of all declared checks and relationships over raw, staged and enriched tables.

    Every scan is run on its own and its few rows written, so what one shuffles is gone
    before most others begin.
    """
    def settled(parts: list[DataFrame]) -> list[DataFrame]:
        spark = parts[0].sparkSession
        return list(side_by_side(spark, {str(i): partial(written, p, "checked") for i, p in enumerate(parts)}, _AT_ONCE).values())

    return run_checks(checks.layer_scans(raw, staged), checks.ALL_CHECKS + checks.RELATIONSHIPS, settled)


def refresh(spark: SparkSession, raw: Mapping[str, DataFrame], root: str, as_of: date | str, split: str = "month",
            allowed: Collection[tuple[str, str, str]] = ()) -> Refreshed:
    """Run every layer below ``root``; safe to run again after a failure.

    A failed check of severity error raises before any mart is written, but for
    those that fail by construction and those in ``allowed``, as
    (table, column, check). The report is written either way.
    """
    return _finished(spark, raw, staging_layer(spark, raw, root, as_of, split), root, allowed)


def refresh_day(spark: SparkSession, landed: str, root: str, load_date: date, as_of: date | str, split: str = "month",
                allowed: Collection[tuple[str, str, str]] = (), fmt: str = "csv") -> Refreshed:
    """Run every layer after one landed day; days may come in any order and again.

    Of the merged tables only that day's folder is read and only the pieces that may
    hold one of its keys are opened; the checks of raw tables cover the day. Patients
    are a view over all landed days.
    """
    raw, staged, merges = {}, {}, {}
    for name, spec in TABLES.items():
        day = load_date if spec.watermark else None
        raw[name] = landing.read_landed(spark, landed, name, day, fmt).select(*spec.columns)
        if spec.watermark:
            snapshot = staging_snapshot(spark, root, name, split)
            merges[name] = partial(load_day, snapshot, landed, name, load_date, as_of, fmt)
        else:
            staged[name] = stage(raw[name], name, as_of)
    staged |= _merged(spark, merges)
    return _finished(spark, raw, staged, root, allowed)


def _finished(spark: SparkSession, raw: Mapping[str, DataFrame], staged: dict[str, DataFrame], root: str,
              allowed: Collection[tuple[str, str, str]]) -> Refreshed:
    """Report, then marts, of staged tables."""
    with settings(spark, freed_shuffles()):
        report = _replace(spark, checked(raw, staged), f"{root}/report")
        require(report, [*checks.FAIL_BY_CONSTRUCTION, *allowed])
        marts = side_by_side(spark, {
            name: partial(_replace, spark, mart, f"{root}/marts/{name}") for name, mart in mart_layer(staged).items()}, _AT_ONCE)
    return Refreshed(staged, marts, report)


def _replace(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
