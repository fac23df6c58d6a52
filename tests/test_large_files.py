"""Files read in byte ranges: CSV records over several lines, and bundles larger than a task."""

import csv
import json
from random import Random

import pytest
from pyspark.sql import functions as F

from carelattice.operators.flatten import flatten
from carelattice.schemas import TABLES
from carelattice.sources import bundles, landing, multiline, pieces


@pytest.fixture
def ranges(spark):
    """Sets how many bytes a range has."""
    key = "spark.sql.files.maxPartitionBytes"
    before = {k: spark.conf.get(k) for k in (key, "spark.sql.files.openCostInBytes")}

    def use(size):
        spark.conf.set(key, str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield use
    for k, v in before.items():
        spark.conf.set(k, v)


COLUMNS = TABLES["encounter"].columns


def awkward_rows(n, seed):
    rng = Random(seed)
    parts = ["a", "é", ",", '"', "\n", "\r\n", " ", "line", '""', "x" * 30]
    return [[f"{seed}-{i}", *["".join(rng.choices(parts, k=rng.randrange(6))) for _ in COLUMNS[1:]]] for i in range(n)]


@pytest.mark.parametrize("size", [200, 10_000_000])
def test_records_over_lines_and_ranges(spark, ranges, tmp_path, rows, size):
    ranges(size)
    want = []
    for seed, end in ((1, "\n"), (2, "\r\n"), (3, "\n")):
        own = awkward_rows(0 if seed == 3 else 60, seed)
        with open(tmp_path / f"{seed}.csv", "w", newline="", encoding="utf-8") as f:
            writer = csv.writer(f, lineterminator=end)
            writer.writerows([COLUMNS, *own])
        want += [tuple(x or None for x in r) for r in own]
    (tmp_path / "empty.csv").write_text("")
    found = multiline.read_multiline(spark, str(tmp_path), TABLES["encounter"].raw_schema, {"header": "true", "escape": '"'})
    assert rows(found) == sorted(want, key=repr)


def test_records_equal_sparks_reader(spark, ranges, tmp_path, rows):
    """Short records, empty lines, a quote that is never closed; a line break at the end of the file ends a record."""
    ranges(50)
    text = 'a,b\n1,"x\ny"\n\n2\n3,z,extra\n "4",q\n5,"no end\n6,w'
    (tmp_path / "t.csv").write_text(text)
    schema = "a string, b string"
    options = {"header": "true", "escape": '"'}
    spark_own = spark.read.options(**options, multiLine="true").schema(schema).csv(str(tmp_path))
    assert rows(multiline.read_multiline(spark, str(tmp_path), spark_own.schema, options)) == rows(spark_own)


def test_one_file_is_read_by_many_tasks(spark, ranges, tmp_path):
    with open(tmp_path / "one.csv", "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows(awkward_rows(2000, 1))
    ranges(10_000)
    found = pieces.read_pieces(spark, str(tmp_path), "\n")
    assert found.select("range_start").distinct().count() > 10
    assert found.rdd.getNumPartitions() > 8


def test_landed_days_with_line_breaks(spark, ranges, tmp_path, rows):
    from datetime import date

    ranges(500)
    schema = TABLES["encounter"].raw_schema
    df = spark.createDataFrame([tuple(x or None for x in r) for r in awkward_rows(50, 1)], schema)
    root = str(tmp_path)
    landing.land(df, root, "encounter", date(2024, 6, 7))
    landing.land(df.limit(3), root, "encounter", date(2024, 6, 8))
    assert rows(landing.read_landed(spark, root, "encounter", date(2024, 6, 7), multiline=True)) == rows(df)
    every = landing.read_landed(spark, root, "encounter", multiline=True)
    assert rows(every.groupBy("year", "month", "day").count()) == [("2024", "06", "07", 50), ("2024", "06", "08", 3)]


# ---- bundles

def resource(kind, i, **more):
    return {"resourceType": kind, "id": f"{kind[0]}{i}", **more}


AWKWARD = [
    {"fullUrl": "u", "resource": resource("Encounter", 0, note='"resource": {"id": "no"}', status="a } ] { [ \\")},
    {"resource": resource("Condition", 1, contained=[{"resource": {"resourceType": "Patient", "id": "inner"}}])},
    {"request": {"resource": 1}, "resource": resource("Patient", 2)},
    {"link": ["resource", "\\"], "resource": resource("Patient", 3), "search": {"resource": {"id": "after"}}},
    {"fullUrl": "no resource here"},
    {"resource": resource("Claim", 4, item=[{"productOrService": {"text": 'he said "resource'}}], total={"value": 12.50})},
    {"resource": resource("Observation", 5, code={"text": "ends with \"resource"})},
]


def bundle(entries, **around):
    return {"resourceType": "Bundle", "link": [{"resource": {"resourceType": "Patient", "id": "link"}}],
            "meta": {"entry": [{"resource": resource("Patient", 99)}]}, **around, "entry": entries,
            "trailer": [{"resource": resource("Patient", 98)}]}


@pytest.fixture
def folder(tmp_path):
    many = [{"resource": resource("Procedure", i, code={"text": "x" * (i % 50)})} for i in range(300)]
    files = {
        "awkward": json.dumps(bundle(AWKWARD)),
        "spaced": json.dumps(bundle(AWKWARD[::-1], total=3), indent=2, ensure_ascii=False).replace('":', '" :'),
        "many": json.dumps(bundle(many + AWKWARD)),
        "empty": json.dumps(bundle([])),
        "none": json.dumps({"resourceType": "Bundle"}),
        "nopatient": json.dumps(bundle(many[:3])),
        "cut": json.dumps(bundle(many))[:5000],
        "broken": json.dumps(bundle(many[:5])).replace('"P2"', '"P2" oops'),
    }
    for name, text in files.items():
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
    return str(tmp_path)


@pytest.mark.parametrize("size", [700, 10_000_000])
def test_large_files_read_like_small_ones(spark, ranges, folder, rows, size):
    ranges(size)
    name = F.regexp_extract("bundle_id", "([a-z]+).json$", 1).alias("name")

    def read(limit):
        resources, bad = bundles.read_resources(spark, folder, large_file=limit)
        resources = resources.where("resource_type is not null").select(
            name, "bundle_patient_id", "resource_type", F.to_json("resource").alias("resource"))
        return rows(resources), rows(bad.select(name, "reason"))

    split, whole = read(0), read(1 << 30)
    assert split == whole
    assert {r[0] for r in split[1]} == {"cut", "broken"} and len(split[0]) == 2 * 6 + 306 + 3
    assert {(r[0], r[1]) for r in split[0]} == {("awkward", "P2"), ("spaced", "P3"), ("many", "P2"), ("nopatient", None)}
    assert read(2000) == whole


def test_order_of_entries(spark, ranges, folder):
    ranges(500)
    resources, _ = bundles.read_resources(spark, folder, large_file=0)
    own = resources.where(F.col("bundle_id").endswith("many.json")).orderBy("position").select(
        "position", F.try_variant_get("resource", "$.id", "string").alias("id")).collect()
    assert [r["position"] for r in own] == list(range(306))
    assert [r["id"] for r in own] == [f"P{i}" for i in range(300)] + ["E0", "C1", "P2", "P3", "C4", "O5"]


def test_empty_folder(spark, tmp_path):
    for limit in (0, 1 << 30):
        resources, bad = bundles.read_resources(spark, str(tmp_path), large_file=limit)
        assert resources.isEmpty() and bad.isEmpty()


# ---- text that a VARIANT does not hold

def test_repeated_names_and_odd_shapes(spark, rows):
    texts = {
        "twice": '{"entry":[{"resource":{"resourceType":"Patient","id":"old","id":"p"}},'
                 '{"resource":{"resourceType":"Encounter","id":"e","status":"a","status":"b"}},{"resource":{"resourceType":"Else","a":1,"a":2}}]}',
        "object": '{"entry":{"resource":{"resourceType":"Patient","id":"p"}}}',
        "number": '{"entry":[1,{"resource":{"resourceType":"Patient","id":"p"}}]}',
        "null": '{"entry":[null,{"resource":{"resourceType":"Patient","id":"p"}}]}',
        "text": '{"entry":[{"resource":"Patient"}]}',
        "scalar": "3", "prose": "no json", "blank": "",
    }
    df = spark.createDataFrame([*texts.items(), ("missing", None)], "bundle_id string, value string")
    resources = bundles.explode_bundles(df)
    assert rows(flatten(resources, "patient"), "patient_id") == [("p",), ("p",)]
    assert rows(flatten(resources, "encounter"), "encounter_id", "patient_id", "status") == [("e", "p", "b")]
    claim = '{"entry":[{"resource":{"resourceType":"Claim","id":"c","total":{"value":%s,"value":%s}}}]}'
    claims = spark.createDataFrame([(str(i), claim % (1, v)) for i, v in enumerate(["7", "7.0", "12.50", '"x"', "1e2"])], df.schema)
    assert rows(flatten(bundles.explode_bundles(claims), "claim"), "total_amount") == [("100.0",), ("12.5",), ("7",), ("7.0",), ("x",)]
    assert {r[0] for r in rows(bundles.quarantine(df), "bundle_id")} == {"object", "number", "scalar", "prose"}


def test_flattening_takes_text_too(spark, rows):
    text = '{"resourceType":"Condition","id":"d","code":{"coding":[{"code":"1"}]},"recordedDate":"2024"}'
    df = spark.createDataFrame([("p", "Condition", text)], "bundle_patient_id string, resource_type string, resource string")
    parsed = df.withColumn("resource", F.try_parse_json("resource"))
    assert rows(flatten(df, "condition")) == rows(flatten(parsed, "condition")) != []
