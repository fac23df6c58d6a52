"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

# Runtime SQL settings that suit these jobs on any cluster size. The number of
# shuffle partitions is left to the caller: AQE coalesces from above, so a large
# cluster sets it to a few times its core count and small inputs pay nothing.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g",
                  app: str = "carelattice") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SQL_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_root: tempfile.TemporaryDirectory | None = None


def work_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates: the session's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its
    own, which goes with the process. A cluster session without it is refused,
    since executors on other machines could not read what is written to one
    machine's disk.
    """
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_root is None:
        _local_root = tempfile.TemporaryDirectory(prefix="carelattice-", ignore_cleanup_errors=True)
    return _local_root.name


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below :func:`work_root`."""
    return f"{work_root(spark)}/carelattice/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared work folder and read again, which ends its lineage."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings that hold for what is computed inside."""
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def freed_shuffles() -> dict[str, str]:
    """Settings under which what a query has shuffled is deleted as soon as the query has ended.

    Otherwise shuffled rows stay on the executors' disks until the driver happens to
    collect garbage, so those of all steps of a job pile up.
    """
    return {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def side_by_side(spark: SparkSession, work: Mapping[str, Callable[[], T]], most: int = 4) -> dict[str, T]:
    """The results by name of pieces of work that do not need each other, ``most`` at a time.

    Jobs of one piece fill the cores that another leaves idle at the end of a stage and
    while it plans. All pieces are run to their end; then the first error, by order, is
    raised. None may change session settings, but to values that hold for all.
    """
    with ThreadPoolExecutor(most) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(piece)) for name, piece in work.items()}
    return {name: piece.result() for name, piece in running.items()}


def open_folders(most: int) -> dict[str, str]:
    """Settings under which a write split into folders keeps ``most`` files open per task.

    Otherwise a task sorts its rows by folder first, and may spill them all. Beyond that
    many folders it sorts what is left.
    """
    return {"spark.sql.maxConcurrentOutputFileWriters": str(most)}


def small_splits(size: str = "16m") -> dict[str, str]:
    """Settings under which a task reads at most ``size`` of a file, or one row group.

    A merge sorts what a task reads before the first shuffle, with all columns. By
    Spark's default a split grows with the table up to 128 MB, and compact text in it
    to several GB of rows.
    """
    return {"spark.sql.files.maxPartitionBytes": size}
