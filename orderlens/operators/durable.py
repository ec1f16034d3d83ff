"""Intermediate results that outlive executors."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def durable_root(spark: SparkSession) -> str:
    """A folder that the driver and all executors share.

    `spark.checkpoint.dir` if it is set, on the session or by
    `SparkContext.setCheckpointDir`; otherwise a folder in the warehouse, which
    every session has.  A warehouse on the local disk is refused unless Spark runs
    locally: each machine of a cluster would write to a disk of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        # A path without a scheme is on the default file system.
        scheme = urlparse(warehouse).scheme or file_system(spark, warehouse)[1].getUri().getScheme()
        root = warehouse_root(warehouse, scheme, spark.sparkContext.master if scheme == "file" else "")
    return root.rstrip("/")


def warehouse_root(warehouse: str, scheme: str, master: str) -> str:
    """The folder for intermediate results in a warehouse on a file system with that scheme."""
    if scheme == "file" and not master.startswith("local"):
        raise ValueError(
            f"intermediate results need a folder that all machines share: set spark.checkpoint.dir ({warehouse} is local)"
        )
    return warehouse.rstrip("/") + "/_intermediate"


def file_system(spark: SparkSession, path: str):
    """The path, and the file system it is on."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def store(df: DataFrame) -> tuple[DataFrame, str]:
    """Write `df` once; the scan of the written table, and its path for `drop`.

    Runs a job.  The table goes when the application ends, if `drop` was not
    called before.
    """
    spark = df.sparkSession
    path = f"{durable_root(spark)}/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at, files = file_system(spark, path)
    files.deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, path: str) -> None:
    """Remove a stored table that nothing will read again."""
    at, files = file_system(spark, path)
    files.delete(at, True)


def durable(df: DataFrame) -> DataFrame:
    """Write `df` once and return a scan of the written table.

    Used where several later passes need the same expensive rows: parquet keeps
    column pruning for those passes, cuts the lineage, and a lost executor costs
    a re-read instead of a recomputation.
    """
    return store(df)[0]


class Scratch:
    """Stored tables that are dropped together."""

    def __init__(self):
        self._paths: list[tuple[SparkSession, str]] = []

    def store(self, df: DataFrame) -> DataFrame:
        stored, path = store(df)
        self._paths.append((df.sparkSession, path))
        return stored

    def counted(self, df: DataFrame) -> tuple[DataFrame, int]:
        """The stored table and its rows, counted by the job that writes it."""
        rows = observed(df, {"rows": F.count(F.lit(1))})
        return self.store(rows[0]), rows[1]()["rows"]

    def drop(self) -> None:
        for spark, path in self._paths:
            drop(spark, path)
        self._paths = []


@contextmanager
def scratch() -> Iterator[Scratch]:
    """A scope whose stored tables go at its end, also after an error."""
    held = Scratch()
    try:
        yield held
    finally:
        held.drop()


def observed(df: DataFrame, metrics: dict) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """`df`, whose next job also takes aggregate `metrics` (BIGINT) of it, and a function that
    returns them once that job is done.

    The aggregates ride on the tasks that hand on `df`, so nothing is read a second time.
    They belong right before a write: a task of the last stage counts once however often
    it is tried, whereas tasks before a shuffle may run again after a lost executor.
    """
    watch = Observation(uuid.uuid4().hex)
    watched = df.observe(watch, *[c.cast("bigint").alias(name) for name, c in metrics.items()])
    # Of an input known to be empty Spark takes no metrics.
    return watched, lambda: {name: watch.get.get(name) or 0 for name in metrics}
