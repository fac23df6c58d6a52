from datetime import datetime

import pytest
from pyspark.sql import functions as F

from carelattice.operators import incremental
from carelattice.plans import refresh
from carelattice.session import small_splits
from carelattice.sources import snapshots
from carelattice.sources.snapshots import SnapshotTable
from carelattice.streaming import ingest

DDL = "k string, w timestamp_ntz, v int"


def day(n):
    return datetime(2024, 1, n)


@pytest.fixture(scope="module")
def old(spark):
    return spark.createDataFrame([("a", day(1), 1), ("b", day(5), 2), (None, day(2), 3)], DDL)


@pytest.fixture(scope="module")
def new(spark):
    return spark.createDataFrame(
        [("b", day(6), 20), ("c", day(5), 30), ("d", day(3), 40), ("e", None, 50), ("f", day(7), 60), (None, day(9), 70)],
        DDL,
    )


def test_filter_is_strict_and_loses_missing(old, new, rows):
    assert rows(incremental.incremental_filter(new, old, "w"), "v") == [(20,), (60,), (70,)]


def test_first_run_takes_everything(new):
    assert incremental.incremental_filter(new, None, "w").count() == 6


def test_empty_target(old, new):
    empty = old.where("false")
    assert incremental.incremental_filter(new, empty, "w").count() == 5
    assert incremental.incremental_filter(new, empty, "w", default=None).count() == 0


def test_lookback_recovers_late_rows(old, new, rows):
    found = incremental.incremental_filter(new, old, "w", lookback="3 days")
    assert rows(found, "v") == [(20,), (30,), (40,), (60,), (70,)]


def test_upsert_replaces_adds_and_is_idempotent(old, new, rows):
    order = incremental.newest_first("w", ["v"])
    once = incremental.upsert(old, new, "k", order)
    assert rows(once, "v") == sorted([(1,), (3,), (20,), (30,), (40,), (50,), (60,), (70,)], key=repr)
    assert rows(incremental.upsert(once, new, "k", order)) == rows(once)


def test_upsert_of_an_older_late_row(old, new, rows):
    order = incremental.newest_first("w", ["v"])
    late = old.where("k = 'b'").withColumn("w", F.lit(day(1)).cast("timestamp_ntz")).withColumn("v", F.lit(99))
    assert (99,) in rows(incremental.upsert(old, late, "k", order), "v")
    assert rows(incremental.upsert(old, late, "k", order, keep="first")) == rows(old)
    both = incremental.upsert(old, new, "k", order, keep="first")
    assert rows(both) == rows(incremental.upsert(old, new, "k", order))


def test_upsert_with_a_new_column(old, new, rows):
    order = incremental.newest_first("w", ["v"])
    wider = new.withColumn("extra", F.lit("x"))
    for keep in ("new", "first"):
        found = incremental.upsert(old, wider, "k", order, keep=keep)
        assert found.columns == ["k", "w", "v", "extra"]
        assert rows(found.where("extra is null"), "v") == [(1,), (3,)]


def test_duplicates_in_a_batch(spark, old, rows):
    batch = spark.createDataFrame(
        [("a", day(2), 5), ("a", day(3), 4), ("a", None, 9), ("z", day(1), 1), ("z", day(1), 2)], DDL)
    found = incremental.upsert(old, batch, "k", incremental.newest_first("w", ["v"]))
    assert rows(found.where("k in ('a', 'z')")) == [("a", day(3), 4), ("z", day(1), 2)]
    with pytest.raises(ValueError, match="rows for k ="):
        incremental.upsert(old, batch, "k", on_duplicate="error")
    with pytest.raises(ValueError, match="order_by"):
        incremental.upsert(old, batch, "k")


def test_dedup_drops_copies_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = incremental.deduplicate(df, "k", [F.col("v").desc()])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_snapshot_versions(spark, old, new, rows, tmp_path):
    table = SnapshotTable(spark, str(tmp_path), "t", dated_by="w")
    order = incremental.newest_first("w", ["v"])
    assert table.version == 0 and table.read() is None and table.newest() is None and not table.has_batch("a")
    assert table.merge(old, "k", order, batch="a") == 1
    first = table.read()
    assert rows(first) == rows(old)
    assert table.merge(new, "k", order, batch="b") == 2
    assert table.version == 2 and table.has_batch("b") and not table.has_batch("c")
    assert rows(table.read()) == rows(incremental.upsert(old, new, "k", order))
    assert rows(first) == rows(old)


def test_merge_rewrites_only_months_with_replaced_keys(spark, rows, tmp_path):
    table = SnapshotTable(spark, str(tmp_path), "t", dated_by="w")
    order = incremental.newest_first("w", ["v"])
    start = [(f"{m}{i}", datetime(2024, m, 1 + i), m) for m in range(1, 5) for i in range(3)] + [("u", None, 0)]
    model = {k: (k, w, v) for k, w, v in start}
    table.merge(spark.createDataFrame(start, DDL), "k", order)
    batch = [("20", datetime(2024, 4, 9), 99), ("x", datetime(2024, 1, 5), 98), ("y", datetime(2024, 6, 5), 97)]
    model |= {k: (k, w, v) for k, w, v in batch}
    table.merge(spark.createDataFrame(batch, DDL), "k", order)
    assert rows(table.read()) == sorted(model.values(), key=repr)
    assert rows(table.newest(), "v") == [(97,)]
    pieces = [(p["part"], p["path"]) for p in table._latest()["pieces"]]
    # February lost a key and is rewritten; the others only gained rows.
    second = sorted(part for part, path in pieces if "=000000000002-" in path)
    assert second == ["p2024-01", "p2024-02", "p2024-04", "p2024-06"]
    assert sum("=000000000001-" in path for _, path in pieces) == 4
    assert sum(part == "p2024-02" for part, _ in pieces) == 1


def test_split_by_year(spark, old, new, rows, tmp_path):
    table = SnapshotTable(spark, str(tmp_path), "t", dated_by="w", split="year")
    order = incremental.newest_first("w", ["v"])
    table.merge(old, "k", order)
    table.merge(new, "k", order)
    assert rows(table.read()) == rows(incremental.upsert(old, new, "k", order))
    assert {p["part"] for p in table._latest()["pieces"]} == {"p2024", "none"}


def test_compact_gathers_pieces(spark, rows, tmp_path):
    table = SnapshotTable(spark, str(tmp_path), "t", dated_by="w")
    order = incremental.newest_first("w", ["v"])
    for i in range(4):
        table.merge(spark.createDataFrame([(f"k{i}", day(3), i)], DDL), "k", order)
    assert len(table._latest()["pieces"]) == 4
    assert table.compact() == 5 and table.compact() == 5
    assert len(table._latest()["pieces"]) == 1
    assert rows(table.read(), "v") == [(i,) for i in range(4)]


def test_new_column_in_a_later_batch(spark, old, new, rows, tmp_path):
    table = SnapshotTable(spark, str(tmp_path), "t", dated_by="w")
    order = incremental.newest_first("w", ["v"])
    table.merge(old, "k", order)
    wider = spark.createDataFrame([("z", datetime(2024, 3, 1), 7, "x")], DDL + ", extra string")
    table.merge(wider, "k", order)
    assert rows(table.read().where("extra is not null"), "k", "extra") == [("z", "x")]
    table.merge(spark.createDataFrame([("a", day(9), 8, "y")], DDL + ", extra string"), "k", order)
    assert rows(table.read(), "k", "v", "extra") == sorted(
        [("a", 8, "y"), ("b", 2, None), (None, 3, None), ("z", 7, "x")], key=repr)
    table.merge(spark.createDataFrame([("b", day(9), 9)], DDL), "k", order)
    assert table.read().columns == ["k", "w", "v", "extra"] and table.read().count() == 4
    with pytest.raises(ValueError, match="column v was int, now string"):
        table.merge(spark.createDataFrame([("b", day(9), "9")], "k string, w timestamp_ntz, v string"), "k", order)


def test_keyless_rows_and_late_rows_in_a_snapshot(spark, old, rows, tmp_path):
    table = SnapshotTable(spark, str(tmp_path), "t", dated_by="w")
    order = incremental.newest_first("w", ["v"])
    for _ in range(3):
        table.merge(old, "k", order)
    assert rows(table.read()) == rows(old)
    late = spark.createDataFrame([("b", day(1), 99), ("n", day(1), 1)], DDL)
    table.merge(late, "k", order, keep="first")
    assert rows(table.read(), "v") == [(1,), (1,), (2,), (3,)]


def test_months_are_pruned(spark, rows, tmp_path):
    table = SnapshotTable(spark, str(tmp_path), "t", dated_by="w")
    data = [(f"k{m}", datetime(2024, m, 1), m) for m in range(1, 7)] + [("u", None, 0)]
    table.commit(spark.createDataFrame(data, DDL))
    assert rows(table.read(["2024-02", "2024-05", "1999-01"]), "v") == [(2,), (5,)]
    assert table.read([]).count() == 0 and table.read([]).columns == ["k", "w", "v"]


def test_empty_table(spark, old, tmp_path):
    table = SnapshotTable(spark, str(tmp_path), "t", dated_by="w")
    table.commit(old.where("false"))
    assert table.read().columns == ["k", "w", "v"] and table.read().count() == 0
    table.merge(old, "k", incremental.newest_first("w", ["v"]))
    assert table.read().count() == 3


def test_a_writer_that_dies_leaves_nothing_behind(spark, old, new, rows, tmp_path, monkeypatch):
    """Death between the data and the log entry, also where sessions overwrite partitions dynamically."""
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        table = SnapshotTable(spark, str(tmp_path), "t", dated_by="w")
        order = incremental.newest_first("w", ["v"])
        table.merge(old, "k", order)
        with monkeypatch.context() as dying:
            dying.setattr(spark, "createDataFrame", lambda *_: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                table.merge(new.where("k = 'c'"), "k", order)
        assert table.version == 1 and rows(table.read()) == rows(old)
        table.merge(new.where("k = 'd'"), "k", order)
        assert rows(table.read(), "v") == [(1,), (2,), (3,), (40,)]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_load_increment_without_news_writes_nothing(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path), "claim")
    claim = spark.createDataFrame([("c1", day(1))], "claim_id string, created_date timestamp_ntz")
    refresh.load_increment(table, claim, "claim")
    refresh.load_increment(table, claim, "claim")
    assert table.version == 1


@pytest.fixture
def many_row_groups(spark, tmp_path):
    """One file of keyed rows in many row groups, which Spark's defaults read as one split."""
    path = str(tmp_path / "source")
    rows = spark.range(60_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("k"), F.lit(day(1)).cast("timestamp_ntz").alias("w"), F.col("id").cast("int").alias("v"))
    rows.coalesce(1).write.option("parquet.block.size", 1 << 18).option("parquet.page.size", 1 << 14).parquet(path)
    return path


def test_a_merge_reads_small_splits(spark, many_row_groups, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "small_splits", lambda: small_splits("512k"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    table = SnapshotTable(spark, str(tmp_path), "t", dated_by="w")
    source = spark.read.parquet(many_row_groups).withColumn("task", F.spark_partition_id())
    table.merge(source, "k", incremental.newest_first("w", ["v"]))
    assert table.read().count() == 60_000
    assert table.read().select("task").distinct().count() > source.select("task").distinct().count()
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_a_stream_reads_small_splits(spark, many_row_groups, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "small_splits", lambda: small_splits("512k"))
    found = []
    stream = spark.readStream.schema(DDL).parquet(many_row_groups)
    ingest.run_available(stream, lambda batch, _: found.append((batch.count(), batch.rdd.getNumPartitions())), str(tmp_path / "checkpoint"))
    assert sum(n for n, _ in found) == 60_000
    assert max(p for _, p in found) > spark.read.parquet(many_row_groups).rdd.getNumPartitions()
