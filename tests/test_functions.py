from datetime import date, datetime

from pyspark.sql import functions as F

from carelattice import functions as fn
from carelattice.plans import staging


def one(spark, value, column, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(column.alias("x")).first()["x"]


def check(spark, column, cases, ddl="v string"):
    """Evaluate the column over all case inputs at once."""
    values = [(i, value) for i, (value, _) in enumerate(cases)]
    found = spark.createDataFrame(values, f"i int, {ddl}").select("i", column.alias("x")).collect()
    by_case = {r["i"]: r["x"] for r in found}
    assert [by_case[i] for i in range(len(cases))] == [expected for _, expected in cases]


def test_trimmed_removes_spaces_only(spark):
    check(spark, fn.trimmed("v"), [("  a b ", "a b"), ("\ta\n", "\ta\n"), ("", ""), (None, None)])


def test_strip_quotes(spark):
    assert one(spark, ' "Dr. ""X"" " ', fn.strip_quotes("v")) == "Dr. X "


def test_safe_timestamp_keeps_wall_clock(spark):
    check(spark, fn.safe_timestamp("v"), [("2024-01-01", datetime(2024, 1, 1)),
    ("2024-01-01T10:00:00-05:00", datetime(2024, 1, 1, 10)),
    ("2024-02-30", None), ("yesterday", None), ("", None), (None, None),])


def test_safe_double(spark):
    check(spark, fn.safe_double("v"), [("12.5", 12.5), (" 7 ", 7.0), ("-1e3", -1000.0), ("1.0d", None), ("NaN", None), ("n/a", None), (None, None),])


def test_gate_matches_whole_untrimmed_text(spark):
    check(spark, fn.gate("v", staging.SERVICE_TEXT), [("Exam (adult) ", "Exam (adult)"), ("Exam #2", None), ("Exam\n", None), ("", None), (None, None),])


def test_person_gate(spark):
    check(spark, fn.gate("v", staging.PERSON_NAME), [("Dr. Who", "Dr. Who"), ("DrX Who", "DrX Who"), ("Prof. Who", None)])


def test_gated_double(spark):
    check(spark, fn.gated_double("v", staging.UNSIGNED_NUMBER), [(" 5.0 ", 5.0), ("-5", None), ("1e3", None), ("5.", None), ("Never smoker", None),])


def test_unit_gate(spark):
    check(spark, fn.gate("v", staging.UNIT_TEXT, tested=fn.trimmed("v")), [("kg", "kg"), ("kg/m2", None), ("mm[Hg]", None), ("{score}", None), ("%", "%")])


def test_strip_trailing_digits(spark):
    check(spark, fn.strip_trailing_digits("v"), [("Ann12 Bob34", "Ann12 Bob"), ("Ann12", "Ann"), ("12", "")])


def test_age_bucket(spark):
    check(spark, fn.age_bucket("v"), [(0, "0-17"), (17, "0-17"), (18, "18-34"), (34, "18-34"), (35, "35-54"), (54, "35-54"),
    (55, "55-74"), (74, "55-74"), (75, "75+"), (None, "75+"),], "v int")


def test_age_bucket_labels_missing(spark):
    assert one(spark, None, fn.age_bucket("v", null_label="unknown"), "v int") == "unknown"
    assert one(spark, 80, fn.age_bucket("v", null_label=None), "v int") == "75+"


def test_ages(spark):
    born = date(1990, 12, 31)
    assert one(spark, born, fn.age_by_calendar_year("v", "2024-01-01"), "v date") == 34
    assert one(spark, born, fn.age_in_years("v", "2024-01-01"), "v date") == 33


def test_boundaries(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 23, 50, 59), datetime(2024, 1, 2, 0, 10, 1))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    found = df.select(
        fn.day_boundaries("a", "b"), fn.days_between("b", "a"), fn.minute_boundaries("a", "b"),
        fn.minute_boundaries("b", "a"),
    ).first()
    assert tuple(found) == (1, -1, 20, -20)


def test_boundaries_ignore_clock_change(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame(
            [(datetime(2024, 3, 10, 1, 0), datetime(2024, 3, 10, 4, 0))],
            "a timestamp_ntz, b timestamp_ntz",
        )
        assert df.select(fn.minute_boundaries("a", "b")).first()[0] == 180
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_small_scalars(spark):
    assert one(spark, 0.0, fn.safe_divide(F.lit(5), "v"), "v double") == 0.0
    assert one(spark, 2.0, fn.safe_divide(F.lit(5), "v"), "v double") == 2.5
    assert one(spark, None, fn.safe_divide(F.lit(5), "v"), "v double") is None
    assert one(spark, 0, fn.nullif_zero("v"), "v int") is None
    assert one(spark, 3, fn.nullif_zero("v"), "v int") == 3
    assert one(spark, 2.345, fn.round_to("v", 1), "v double") == 2.3


def test_surrogate_key_spells_null(spark):
    import hashlib

    df = spark.createDataFrame([(1, None, "x")], "a int, b string, c string")
    found = df.select(fn.surrogate_key(["a", "b", "c"])).first()[0]
    assert found == hashlib.md5(b"1-NULL-x").hexdigest()
