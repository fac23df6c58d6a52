"""Date-partitioned landing of flat tables, and reading them back."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelattice.schemas import TABLES
from carelattice.sources.multiline import read_multiline

# Quoted fields may hold commas and quotes.
_CSV = {"header": "true", "escape": '"'}
# Rows per written CSV file.
MAX_ROWS_PER_FILE = 2_000_000
# The same where files are compressed: one task reads such a file from its beginning.
MAX_ROWS_PER_PACKED_FILE = 200_000


def write_flat(tables: Mapping[str, DataFrame], folder: str, fmt: str = "csv") -> list[str]:
    """One folder per non-empty table with a header and no index; returns the tables written."""
    written = []
    for name, df in tables.items():
        if df.isEmpty():
            continue
        _writer(df, fmt).save(f"{folder}/{name}")
        written.append(name)
    return written


def _writer(df: DataFrame, fmt: str, compression: str | None = None):
    writer = df.write.mode("overwrite").format(fmt)
    if compression is not None:
        writer = writer.option("compression", compression)
    if fmt == "csv":
        writer = writer.options(
            header="true",
            escape='"',
            ignoreLeadingWhiteSpace="false",
            ignoreTrailingWhiteSpace="false",
            maxRecordsPerFile=MAX_ROWS_PER_FILE if compression is None else MAX_ROWS_PER_PACKED_FILE,
        )
    return writer


def day_folder(load_date: date) -> str:
    return f"year={load_date.year}/month={load_date.month:02d}/day={load_date.day:02d}"


def land(df: DataFrame, root: str, table: str, load_date: date, fmt: str = "csv",
         compression: str | None = None) -> None:
    """Write ``df`` below ``root/table`` in the partition of ``load_date``.

    Landing a day again replaces that day and no other, also when there are no rows.
    With ``compression`` ("gzip") CSV takes a fraction of the disk, in more and smaller
    files, since byte ranges of one cannot be read.
    """
    folder = f"{root}/{table}/{day_folder(load_date)}"
    _writer(df, fmt, compression).option("partitionOverwriteMode", "static").save(folder)


def read_landed(spark: SparkSession, root: str, table: str, load_date: date | None = None,
                fmt: str = "csv", multiline: bool = False) -> DataFrame:
    """Raw rows of one landed table, all days or only ``load_date``; empty text reads as NULL.

    One day is read from its own folder, so other days are not even listed. CSV
    fields with line breaks need ``multiline``; files are read in byte ranges either way.
    """
    schema = TABLES[table].raw_schema
    if fmt == "csv" and multiline:
        return _multiline(spark, f"{root}/{table}", schema, load_date)
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(**_CSV)
    if load_date is not None:
        return reader.schema(schema).load(f"{root}/{table}/{day_folder(load_date)}")
    dated = T.StructType(
        schema.fields + [T.StructField(c, T.StringType()) for c in ("year", "month", "day")]
    )
    return reader.schema(dated).load(f"{root}/{table}")


def _multiline(spark: SparkSession, folder: str, schema: T.StructType, load_date: date | None) -> DataFrame:
    if load_date is not None:
        return read_multiline(spark, f"{folder}/{day_folder(load_date)}", schema, _CSV)
    rows = read_multiline(spark, folder, schema, _CSV, file_as="_file")
    day = {c: F.regexp_extract("_file", f"/{c}=([^/]*)/", 1) for c in ("year", "month", "day")}
    return rows.withColumns(day).drop("_file")
