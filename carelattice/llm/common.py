"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelattice.session import work_path

# Rows a join side may have to be broadcast under an explicit hint. Larger sides
# are joined in blocks of this size or by a shuffle.
BROADCAST_ROWS = 200_000


_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the session was started.

    Spark sends the archive to the executors, once per application. Where the
    package is installed on the cluster or given as ``--py-files`` this is not needed.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).parents[1]
    folder = tempfile.TemporaryDirectory(prefix="package-", ignore_cleanup_errors=True)
    archive = Path(folder.name) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped[application] = folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared work folder and read again.

    The lineage ends at the written files, so a lost executor costs only its own
    tasks, and later uses do not repeat the work.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept out of learning; a NULL id is never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def by_record(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Non-empty slices of at most ``rows`` rows, so that working arrays stay small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
