"""Refreshes driven by landed days."""

import time
from datetime import date
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from carelattice.harness import bindings
from carelattice.operators.quality import QualityError, run_checks
from carelattice.plans import checks, refresh
from carelattice.plans.staging import stage
from carelattice.schemas import TABLES
from carelattice.session import freed_shuffles, settings, side_by_side
from carelattice.sources import landing
from carelattice.sources.snapshots import SnapshotTable

AS_OF = bindings.AS_OF
REPEATED = tuple((f"raw_{t}", TABLES[t].key, "unique") for t in ("condition", "procedure", "medication_request"))


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    few = F.coalesce(F.col("encounter_id").cast("bigint") % 40 == 0, F.lit(False))
    tables = {n: bindings.raw(spark, sf_dir, n) for n in TABLES}
    return {n: df if n == "patient" else df.where(few) for n, df in tables.items()}


def land(raw, root, name, rows, day):
    landing.land(rows, f"{root}/landed", name, date(2024, 6, day))


def test_days_in_any_order_equal_one_refresh(spark, raw, rows, tmp_path):
    root = str(tmp_path)
    for name, df in raw.items():
        early = F.lit(True) if name == "patient" else F.col("encounter_id").cast("bigint") % 80 == 0
        land(raw, root, name, df.where(early), 7)
        land(raw, root, name, df.where(~early), 8)
    for day in (8, 7):
        found = refresh.refresh_day(spark, f"{root}/landed", f"{root}/clinic", date(2024, 6, day), AS_OF, "year", REPEATED)
    whole = refresh.refresh(spark, raw, f"{root}/whole", AS_OF, "year", REPEATED)
    for name in whole.marts:
        assert rows(found.marts[name]) == rows(whole.marts[name])
    assert whole.marts["medication_patterns"].count() > 50


def test_a_day_without_its_visits_is_stopped(spark, raw, tmp_path):
    """Claims whose encounters have not landed fail the relationship, and no mart is written."""
    root = str(tmp_path)
    for name, df in raw.items():
        land(raw, root, name, df.limit(0) if name == "encounter" else df, 7)
    with pytest.raises(QualityError, match="claim.encounter_id"):
        refresh.refresh_day(spark, f"{root}/landed", f"{root}/clinic", date(2024, 6, 7), AS_OF, "year", REPEATED)
    assert not (tmp_path / "clinic" / "marts").exists()


def test_tables_are_merged_side_by_side(spark, raw, tmp_path, monkeypatch):
    """Merges of two tables meet while both run, and leave the session's settings as they were."""
    key = "spark.sql.files.maxPartitionBytes"
    before, both, merge = spark.conf.get(key), Barrier(2, timeout=60), SnapshotTable.merge

    def waiting(self, *args, **kwargs):
        both.wait()
        return merge(self, *args, **kwargs)

    monkeypatch.setattr(SnapshotTable, "merge", waiting)
    two = {n: raw[n] for n in ("encounter", "claim")}
    staged = refresh.staging_layer(spark, two, str(tmp_path), AS_OF, "year")
    assert {n: df.count() for n, df in staged.items()} == {n: df.count() for n, df in two.items()}
    assert spark.conf.get(key) == before


def test_an_error_in_one_piece_of_work_is_raised_after_all_ended(spark):
    done = []

    def fails():
        raise ValueError("first")

    with pytest.raises(ValueError, match="first"):
        side_by_side(spark, {"a": fails, "b": lambda: done.append("b"), "c": lambda: done.append("c")}, most=1)
    assert done == ["b", "c"]
    assert side_by_side(spark, {"b": lambda: 2, "a": lambda: 1}) == {"b": 2, "a": 1} and side_by_side(spark, {}) == {}


def _shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def _left(spark, before):
    """Shuffle files made since ``before``; deleting them may take a moment."""
    for _ in range(50):
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


def test_merge_frees_what_it_shuffled(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path), "t", "at", "year", indexed_by="id")
    rows = spark.createDataFrame([(f"k{i % 40}", f"{2000 + i % 3}-01-01", i) for i in range(400)], "id string, at string, n int")
    order = [F.col("n").desc()]
    before = _shuffle_files(spark)
    table.merge(rows, "id", order)
    table.merge(rows.withColumn("n", F.col("n") + 1000), "id", order)
    assert not _left(spark, before)
    assert table.read().agg(F.count("*"), F.min("n")).first() == (40, 1360)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_scans_are_checked_apart_and_freed(spark, raw):
    staged = {n: stage(df, n, AS_OF) for n, df in raw.items()}
    wanted = checks.ALL_CHECKS + checks.RELATIONSHIPS
    expected = sorted(run_checks(checks.layer_scans(raw, staged), wanted).collect())
    before = _shuffle_files(spark)
    with settings(spark, freed_shuffles()):
        report = refresh.checked(raw, staged)
    assert len(report.inputFiles()) >= 2 * len(TABLES) and not _left(spark, before)
    assert sorted(report.collect()) == expected
