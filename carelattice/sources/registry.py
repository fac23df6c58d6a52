"""Named raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelattice.schemas import TABLES


def describe(spark: SparkSession) -> DataFrame:
    """The registry as rows: table, resource type, description, key, watermark, number of columns."""
    rows = [
        (s.name, s.resource_type, s.description, s.key, s.watermark, len(s.columns))
        for s in TABLES.values()
    ]
    return spark.createDataFrame(
        rows,
        "table_name string, resource_type string, description string, key string, "
        "watermark string, n_columns int",
    )


def raw_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Every row and column of one raw table, all text, columns in their declared order."""
    spec = TABLES[name]
    return spark.read.schema(spec.raw_schema).format(fmt).load(f"{root}/{name}").select(*spec.columns)


def as_text(df: DataFrame, name: str) -> DataFrame:
    """Any DataFrame with the table's columns, brought to its raw all-text form."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in TABLES[name].columns])
