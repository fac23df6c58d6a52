"""Merges that open only the pieces whose key index may hold a key of the batch."""

import glob
import json
from random import Random

import pytest
from pyspark.sql import functions as F

from carelattice.operators.incremental import newest_first
from carelattice.sources import key_index
from carelattice.sources.snapshots import SnapshotTable

SCHEMA = "k string, w timestamp_ntz, v int"


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "k string, day string, v int").select(
        "k", F.col("day").cast("timestamp_ntz").alias("w"), "v")


def by_month(rng, per_month=300, months=12):
    """Random keys, so every month has the whole range of keys."""
    keys = rng.sample(range(10**9), per_month * months)
    return [(f"k{k:09d}", f"2024-{1 + i % months:02d}-05", i) for i, k in enumerate(keys)]


def order():
    return newest_first("w", ["v"])


def test_only_months_with_a_key_are_opened(spark, tmp_path, rows):
    old = by_month(Random(1))
    table = SnapshotTable(spark, str(tmp_path), "t", dated_by="w", indexed_by="k")
    table.commit(rows_of(spark, old))
    march = [r for r in old if r[1].startswith("2024-03")][:5]
    batch = [(k, "2024-12-30", -1) for k, _, _ in march] + [("new", "2024-12-31", 7)]
    # Other months' data cannot be read any more, and need not be.
    for part in glob.glob(f"{tmp_path}/t/data/*/snapshot_part=p2024-*/*.parquet"):
        if "p2024-03" not in part:
            with open(part, "r+b") as f:
                f.write(b"\0" * 200)
    table.merge(rows_of(spark, batch), "k", order())
    assert [p for p, _ in table.opened] == ["p2024-03"]
    assert rows(table.read(["2024-03", "2024-12"]).where("v = -1"), "k") == sorted((k,) for k, _, _ in march)


def test_equal_to_a_table_without_index(spark, tmp_path, rows):
    rng = Random(2)
    old = by_month(rng, 60) + [(None, "2024-02-01", 1), (None, "2024-05-01", 1)]
    tables = [SnapshotTable(spark, str(tmp_path / n), "t", dated_by="w", indexed_by=k) for n, k in (("a", "k"), ("b", None))]
    batches = [old]
    for i in range(3):
        known = rng.sample([r for r in old if r[0]], 4)
        batches.append([(k, f"2024-{rng.randrange(1, 13):02d}-20", -i) for k, _, _ in known] + [(f"n{i}", None, i), (None, "2024-02-01", 1)])
    for batch in batches:
        for table in tables:
            table.merge(rows_of(spark, batch), "k", order())
    assert rows(tables[0].read()) == rows(tables[1].read())
    assert len(tables[0].opened) < len(tables[1].opened)


def test_range_of_keys_alone(spark, tmp_path):
    """Keys that grow with time: a batch beyond them opens nothing."""
    table = SnapshotTable(spark, str(tmp_path), "t", dated_by="w", indexed_by="k")
    table.commit(rows_of(spark, [(f"k{i:05d}", f"2024-{1 + i // 10:02d}-01", i) for i in range(120)]))
    table.merge(rows_of(spark, [("k90000", "2024-12-02", 1)]), "k", order())
    assert table.opened == []
    table.merge(rows_of(spark, [("k00055", "2024-12-03", 2), ("k90000", "2024-12-03", 3)]), "k", order())
    assert {p for p, _ in table.opened} <= {"p2024-06", "p2024-12"} and len(table.opened) >= 2
    assert table.read().where("k = 'k00055'").first()["v"] == 2 and table.read().count() == 121


def test_pieces_without_index_are_opened(spark, tmp_path):
    """A table from before the index, or one indexed by another column."""
    old = rows_of(spark, [("a", "2024-01-01", 1), ("b", "2024-02-01", 2)])
    for key in (None, "v"):
        root = str(tmp_path / str(key))
        SnapshotTable(spark, root, "t", dated_by="w", indexed_by=key).commit(old)
        for file in glob.glob(f"{root}/t/commits/*/*.json"):
            entry = json.loads(open(file).read())
            if key is None:
                for piece in entry["pieces"]:
                    piece.pop("index", None)
                open(file, "w").write(json.dumps(entry))
                for crc in glob.glob(f"{root}/t/commits/*/.*.crc"):
                    open(crc, "wb").close()
        table = SnapshotTable(spark, root, "t", dated_by="w", indexed_by="k")
        table.merge(rows_of(spark, [("a", "2024-03-01", 3)]), "k", order())
        assert len(table.opened) == 2 and table.read().count() == 2
        table.merge(rows_of(spark, [("a", "2024-03-02", 4)]), "k", order())
        assert [p for p, _ in table.opened if p != "p2024-02"] == ["p2024-03"]


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_no_key_is_missed(spark, kind):
    n = 20_000
    held = spark.range(n).select((F.col("id") * 7919 % 1_000_003).cast(kind).alias("k"), F.concat(F.lit("p"), F.col("id") % 3).alias("piece"))
    index = key_index.build(held, "k", "piece")
    assert index.select("piece", "blocks").distinct().count() == 3 and index.first()["blocks"] == 4
    for piece in ("p0", "p1", "p2"):
        own = held.where(F.col("piece") == piece).limit(50).select("k")
        assert piece in key_index.may_hold(index, own, "k")
    absent = spark.range(200).select((F.col("id") * 5 + 2_000_003).cast(kind).alias("k"))
    assert kind == "string" or key_index.may_hold(index, absent, "k") == set()
    assert key_index.may_hold(index, absent.limit(0), "k") == set()
    assert key_index.may_hold(index, spark.sql(f"select cast(null as {kind}) as k"), "k") == set()


def test_keys_travel_to_their_blocks_not_filters(spark):
    """Every task of the scan touches every block, but nothing of 4 KB per task and block is shuffled."""
    held = spark.range(0, 400_000, 1, 16).select(F.col("id").cast("string").alias("k"), F.lit("p").alias("piece"))
    index = key_index.build(held, "k", "piece")
    rows = index.collect()
    assert index.rdd.getNumPartitions() <= 2 and len({r["block"] for r in rows}) == rows[0]["blocks"] == 256
    plan = index._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # The first lines are the last steps: the filter is made after the shuffle of keys.
    assert 0 < plan.index("bitmap_construct_agg") < plan.index("REPARTITION_BY_NUM")
    assert "partial_bitmap_construct_agg" not in plan[plan.index("REPARTITION_BY_NUM"):]


def test_a_large_batch_is_probed_by_few_keys(spark, monkeypatch):
    """All keys are looked up only in pieces that the first ones do not settle."""
    held = spark.range(30_000).select(F.format_string("k%06d", "id").alias("k"), F.concat(F.lit("p"), F.col("id") % 3).alias("piece"))
    alone = spark.createDataFrame([("k000000x", "q"), ("k029990x", "q")], "k string, piece string")
    index = key_index.build(held.unionByName(alone), "k", "piece").localCheckpoint()
    looked = []
    hit = key_index._hit
    monkeypatch.setattr(key_index, "_hit", lambda i, *a: looked.append({r[0] for r in i.select("piece").distinct().collect()}) or hit(i, *a))
    keys = held.select("k").where("k < 'k029000'").unionByName(spark.createDataFrame([("k029990x",)], "k string"))
    assert key_index.may_hold(index, keys, "k") == {"p0", "p1", "p2", "q"}
    assert looked[0] == {"p0", "p1", "p2", "q"} and looked[1] <= {"q"}
