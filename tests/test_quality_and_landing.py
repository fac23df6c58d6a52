import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from carelattice.operators.quality import Check, QualityError, Scan, require, run_checks
from carelattice.harness import bindings, catalog
from carelattice.plans import checks, enrichment, marts, refresh
from carelattice.schemas import TABLES
from carelattice.sources import landing, registry
from carelattice.sources.snapshots import SnapshotTable
from carelattice.streaming import ingest


def test_declared_checks():
    assert len(checks.ALL_CHECKS) == 60
    kinds = [len(checks.of_kind(checks.ALL_CHECKS, k)) for k in ("not_null", "unique", "accepted_values")]
    assert kinds == [40, 17, 3]
    assert len(checks.RELATIONSHIPS) == 7


def test_dirty_table(spark):
    t = spark.createDataFrame(
        [("a", "x", "u"), ("a", "y", None), (None, "x", "u"), (None, None, "w"), ("b", "z", "w")],
        "id string, code string, ref string")
    parent = spark.createDataFrame([("u",), ("u",)], "id string")
    wanted = [
        Check("t", "id", "not_null"), Check("t", "id", "unique"), Check("t", "code", "not_null"),
        Check("t", "code", "unique"),
        Check("t", "code", "accepted_values", "warn", ("x", "y")),
        Check("t", "ref", "relationship", parent="p", parent_column="id"),
        Check("p", "id", "not_null"),
    ]
    report = run_checks({"t": t, "p": parent}, wanted)
    found = {(r["table_name"], r["column_name"], r["check_name"]): (r["failures"], r["passed"]) for r in report.collect()}
    assert found == {
        ("t", "id", "not_null"): (2, False), ("t", "id", "unique"): (1, False),
        ("t", "code", "not_null"): (1, False), ("t", "code", "unique"): (1, False),
        ("t", "code", "accepted_values"): (1, False), ("t", "ref", "relationship"): (2, False),
        ("p", "id", "not_null"): (0, True),
    }
    with pytest.raises(QualityError, match="t.id not_null: 2"):
        require(report)
    require(run_checks({"t": t}, [Check("t", "code", "accepted_values", "warn", ("x",))]))


def test_empty_table_passes(spark):
    t = spark.createDataFrame([], "id string")
    report = run_checks({"t": t}, [Check("t", "id", "not_null"), Check("t", "id", "unique")])
    assert [r["failures"] for r in report.collect()] == [0, 0]


AWKWARD = [("c1", 'Boston, "MA"', " two\nlines "), ("c2", "", None), ("c3", "x\\y", "é")]


def awkward(spark):
    columns = TABLES["claim"].columns
    wide = [dict.fromkeys(columns) | {"claim_id": a, "payer": b, "service_desc": c} for a, b, c in AWKWARD]
    return spark.createDataFrame([tuple(w[c] for c in columns) for w in wide], TABLES["claim"].raw_schema)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_landing_round_trip(spark, rows, tmp_path, fmt):
    root = str(tmp_path)
    for day in (date(2024, 6, 7), date(2024, 6, 7), date(2024, 11, 8)):
        landing.land(awkward(spark), root, "claim", day, fmt)
    everything = landing.read_landed(spark, root, "claim", fmt=fmt, multiline=True)
    assert rows(everything.select("year", "month", "day").distinct()) == [("2024", "06", "07"), ("2024", "11", "08")]
    assert everything.count() == 6
    one = landing.read_landed(spark, root, "claim", date(2024, 6, 7), fmt, multiline=True)
    assert tuple(one.columns) == TABLES["claim"].columns
    empty = None if fmt == "csv" else ""
    expected = [(a, empty if b == "" else b, c) for a, b, c in AWKWARD]
    assert rows(one, "claim_id", "payer", "service_desc") == sorted(expected, key=repr)


def test_compressed_landing_round_trip(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "MAX_ROWS_PER_PACKED_FILE", 2)
    day, claim = date(2024, 6, 7), awkward(spark).coalesce(1)
    landing.land(claim, str(tmp_path / "plain"), "claim", day)
    landing.land(claim, str(tmp_path / "packed"), "claim", day, compression="gzip")
    files = [f.name for f in (tmp_path / "packed").rglob("part-*")]
    assert len(files) == -(-claim.count() // 2) and all(f.endswith(".csv.gz") for f in files)
    read = [rows(landing.read_landed(spark, str(tmp_path / k), "claim", day, multiline=True)) for k in ("plain", "packed")]
    assert read[0] == read[1] and len(read[1]) == claim.count()


def test_one_day_is_landed_compressed(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "work_path", lambda _, name: f"{tmp_path}/{name}")
    monkeypatch.setattr(refresh, "refresh_day", lambda *a, **k: refresh.Refreshed({}, {"medication_patterns": None}, None))
    catalog.refresh_one_day(spark, sf_dir)
    files = [f.name for f in (tmp_path / "refresh-day" / "landed").rglob("part-*")]
    assert files and all(f.endswith(".csv.gz") for f in files)
    landed = landing.read_landed(spark, f"{tmp_path}/refresh-day/landed", "condition")
    assert landed.count() == bindings.raw(spark, sf_dir, "condition").count()


def test_flat_files_skip_empty_tables(spark, tmp_path):
    claim = awkward(spark)
    written = landing.write_flat({"claim": claim, "nothing": claim.where("false")}, str(tmp_path))
    assert written == ["claim"] and not (tmp_path / "nothing").exists()


def test_registry(spark, rows, tmp_path):
    assert registry.describe(spark).count() == 7
    awkward(spark).write.parquet(str(tmp_path / "claim"))
    found = registry.raw_table(spark, str(tmp_path), "claim")
    assert rows(found) == rows(awkward(spark))
    assert set(dict(registry.as_text(spark.range(1).selectExpr(*[f"id as {c}" for c in TABLES["claim"].columns]), "claim").dtypes).values()) == {"string"}


def test_empty_day_replaces_a_day(spark, tmp_path):
    for fmt in ("csv", "parquet"):
        root = str(tmp_path / fmt)
        landing.land(awkward(spark), root, "claim", date(2024, 6, 7), fmt)
        landing.land(awkward(spark).limit(0), root, "claim", date(2024, 6, 7), fmt)
        assert landing.read_landed(spark, root, "claim", date(2024, 6, 7), fmt).count() == 0


def test_one_day_reads_one_folder(spark, sf_dir, tmp_path):
    claim = bindings.raw(spark, sf_dir, "claim")
    for day in (7, 8):
        landing.land(claim, str(tmp_path), "claim", date(2024, 6, day))
    one = landing.read_landed(spark, str(tmp_path), "claim", date(2024, 6, 8))
    assert all("day=08" in f for f in one.inputFiles()) and one.count() == claim.count()


def test_scans_equal_formed_models(spark, sf_dir):
    """Checks of the enriched models by counts give what the formed models give."""
    raw = {n: bindings.raw(spark, sf_dir, n) for n in TABLES}
    staged = {n: bindings.staged(spark, sf_dir, n) for n in TABLES}
    formed = {n: enrichment.model(n, staged) for n in {c.table for c in checks.ENRICHED_CHECKS}}
    plain = run_checks(formed, checks.ENRICHED_CHECKS)
    counted = run_checks(checks.source_scans(raw, bindings.AS_OF), checks.ENRICHED_CHECKS)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, counted.collect()))
    plan = run_checks(checks.source_scans(raw, bindings.AS_OF), checks.ALL_CHECKS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 40


def test_refresh_twice(spark, sf_dir, rows, tmp_path):
    raw = {n: bindings.raw(spark, sf_dir, n) for n in TABLES}
    args = (spark, raw, str(tmp_path), bindings.AS_OF, "year", catalog.REPEATED_RAW_KEYS)
    first = refresh.refresh(*args)
    marts = {n: rows(df) for n, df in first.marts.items()}
    second = refresh.refresh(*args)
    assert {n: rows(df) for n, df in second.marts.items()} == marts
    assert second.report.count() == 67
    unique = [r for r in second.report.collect() if r["check_name"] == "unique"]
    assert {r["table_name"] for r in unique if r["failures"]} == {
        "raw_condition", "raw_procedure", "raw_medication_request", "encounter_claim", "medication_condition"}


def test_refresh_stops_before_the_marts(spark, sf_dir, tmp_path):
    raw = {n: bindings.raw(spark, sf_dir, n) for n in TABLES}
    with pytest.raises(QualityError, match="raw_condition.condition_id unique"):
        refresh.refresh(spark, raw, str(tmp_path), bindings.AS_OF, "year")
    assert (tmp_path / "report").exists() and not (tmp_path / "marts").exists()


def test_late_moved_and_repeated_visits(spark, rows, tmp_path):
    """The flags of a stream are those of the batch over the last copy of every visit."""
    rng = random.Random(3)
    columns = TABLES["encounter"].columns
    table = SnapshotTable(spark, str(tmp_path), "visits", "start_date")
    model: dict[str, tuple] = {}
    for day in range(1, 5):
        batch = {}
        for _ in range(60):
            e = f"e{rng.randrange(120)}"
            start = None if rng.random() < 0.05 else f"2024-{rng.randrange(1, 13):02d}-{rng.randrange(1, 28):02d} 10:00:00"
            batch[e] = (e, rng.choice(["p1", "p2", "p3", None]), "kind", start)
        model |= batch
        wide = [dict.fromkeys(columns) | dict(zip(("encounter_id", "patient_id", "encounter_type", "start_date"), v))
                for v in batch.values()]
        raw = spark.createDataFrame([tuple(w[c] for c in columns) for w in wide], TABLES["encounter"].raw_schema)
        landing.land(raw, f"{tmp_path}/landed", "encounter", date(2024, 6, day), "parquet")
        ingest.flag_readmissions_available(ingest.landed_stream(spark, f"{tmp_path}/landed", "encounter"), table,
                                           f"{tmp_path}/checkpoint", bindings.AS_OF)
        visits = spark.createDataFrame(list(model.values()), "encounter_id string, patient_id string, "
                                       "encounter_type string, start_date string").withColumn(
            "start_date", F.col("start_date").cast("timestamp_ntz"))
        want = rows(marts.readmission_flags(visits), *table.read().columns)
        assert rows(table.read()) == want, day


def test_stream_replay_and_lost_checkpoint(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    landing.land(bindings.raw(spark, sf_dir, "claim"), f"{root}/landed", "claim", date(2024, 6, 7), "parquet")
    table = SnapshotTable(spark, root, "claim")

    def run(checkpoint):
        ingest.upsert_available(ingest.landed_stream(spark, f"{root}/landed", "claim"), table, "claim",
                                f"{root}/{checkpoint}", bindings.AS_OF)
        return table.version

    assert run("one") == 1
    assert run("one") == 1  # no new file
    for name in ("0", ".0.crc"):
        (tmp_path / "one" / "commits" / name).unlink()
    assert run("one") == 1  # a batch that died after its merge is replayed and skipped
    assert run("two") == 2  # a new checkpoint reads everything again, to the same table
    assert not table.has_batch("x") and len(table._entries()) == 2
    assert table.read().count() == 1500


def test_equal_keys_of_a_row_share_an_entry(spark):
    """Counts per table are kept apart; a key equal in the raw and the cleaned row travels once."""
    df = spark.createDataFrame(
        [("a", "a", 1), ("a ", "a", 1), ("b", "b", 3), (None, None, 1), (" ", None, 1), ("c", "d", 1), ("d", "c", 2)],
        "raw string, clean string, n bigint")
    tables = {"r": {"id": F.col("raw")}, "s": {"id": F.col("clean")}, "m": {"id": F.col("clean")}}
    wanted = [Check(t, "id", kind) for t in tables for kind in ("not_null", "unique")]
    scan = Scan(df, tables, {"m": "n"})
    found = {(r["table_name"], r["check_name"]): r["failures"] for r in run_checks([scan], wanted).collect()}
    assert found == {("r", "not_null"): 1, ("r", "unique"): 0, ("s", "not_null"): 2, ("s", "unique"): 1,
                     ("m", "not_null"): 2, ("m", "unique"): 3}
    report = run_checks([scan], wanted)
    report.collect()
    stages = report._jdf.queryExecution().executedPlan().toString()
    assert "keys=[key#" in stages and "entry#" not in stages
