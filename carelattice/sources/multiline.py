"""CSV with line breaks inside fields, read in byte ranges.

A line that starts behind an odd number of quotes continues the record before it:
quotes inside a field are doubled, so only the ends of quoted fields change the parity.
Lines are counted over byte ranges, and a record is put together from its lines where
it lies; only records that cross the border of a range travel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelattice.sources.pieces import RANGE, joined, read_pieces, spread_over_ranges


def _numbered(lines: DataFrame) -> DataFrame:
    """``lines`` with the number of their record, and whether they start it.

    Which lines of a range start records depends on the quotes before the range, so
    both cases are counted inside it, and the right one is chosen per range.
    """
    before = Window.partitionBy(*RANGE).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*RANGE).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = Window.partitionBy("file").orderBy("range_start").rowsBetween(Window.unboundedPreceding, -1)

    def so_far(amount: Column | str, window) -> Column:
        return F.coalesce(F.sum(amount).over(window), F.lit(0))

    quotes = F.octet_length("text") - F.octet_length(F.replace("text", F.lit('"'), F.lit("")))
    inside = lines.withColumn("quotes", quotes).withColumn("odd", so_far("quotes", before) % 2)
    ranges = (
        inside.groupBy(*RANGE).agg(F.sum("quotes").alias("quotes"), F.count(F.lit(1)).alias("lines"), F.sum("odd").alias("odds"))
        .withColumn("open", so_far("quotes", ahead) % 2)
        .withColumn("begun", F.when(F.col("open") == 1, F.col("odds")).otherwise(F.col("lines") - F.col("odds")))
        .select(*RANGE, "open", so_far("begun", ahead).alias("records"))
    )
    return (
        inside.join(ranges, list(RANGE)).withColumn("starts", F.col("odd") == F.col("open"))
        .withColumn("record", F.col("records") + F.count(F.when(F.col("starts"), 1)).over(upto) - 1)
    )


def read_records(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(file, record, text): the records of every CSV file, numbered from 0, the header included.

    Line breaks inside quoted fields are kept; a carriage return that ends a record is
    not part of it. Empty lines keep their number but are no records, as in Spark's
    reader. A quote that is never closed makes the rest of its file one record.
    """
    lines = spread_over_ranges(read_pieces(spark, path, "\n", pattern))
    parts = _numbered(lines).groupBy(*RANGE, "record").agg(
        joined("at", "\n").alias("text"), F.max("starts").alias("starts"), F.sum("quotes").alias("quotes"))
    # Parts cut by the border of a range meet; all others are whole.
    whole = F.col("starts") & (F.col("quotes") % 2 == 0)
    crossing = parts.where(~whole).groupBy("file", "record").agg(joined("range_start", "\n").alias("text"))
    found = parts.where(whole).select("file", "record", "text").unionByName(crossing)
    return found.withColumn("text", F.regexp_replace("text", r"\r\z", "")).where("text <> ''")


def read_multiline(spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str],
                   pattern: str | None = None, file_as: str | None = None) -> DataFrame:
    """The rows of CSV files whose fields may hold line breaks; any number of tasks reads a file.

    ``options`` are those of Spark's CSV reader; the escape must be the quote. With the
    option ``header`` the first line of every file starts a record that is left out.
    Missing fields are NULL, as in Spark's reader. ``file_as`` names a last column for
    the path of a row's file.
    """
    records = read_records(spark, path, pattern)
    if options.get("header") == "true":
        records = records.where("record > 0")
    # Line breaks inside quotes stay as they are only under multiLine.
    row = F.from_csv("text", schema.toDDL(), {**options, "multiLine": "true"})
    named = [F.col("file").alias(file_as)] if file_as else []
    return records.select(row.alias("row"), "file").select("row.*", *named)
