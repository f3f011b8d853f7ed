"""Intermediate tables in the folder the cluster shares.

A frame that several branches read is written once and read back. The written table
survives the loss of executors, keeps column pruning, and cuts the lineage.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
# Spark then removes the shuffle files of a write when it is done; what reads the stored table needs them no more.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
CODEC = "zstd"  #: of Parquet files; smaller than the usual one
_run: ContextVar[str | None] = ContextVar("run_folder", default=None)


def scratch_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one on a local master only."""
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="assaysift-")
    spark.conf.set(_SETTING, folder)
    return folder


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Tables stored inside the block share one folder, which is deleted when the block ends.

    For runs that write their results before the end; frames that read the stored tables
    are of no use afterwards. Without such a block the tables stay.
    """
    folder = f"{scratch_folder(spark).rstrip('/')}/run-{uuid.uuid4().hex}"
    token = _run.set(folder)
    try:
        yield folder
    finally:
        _run.reset(token)
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{_run.get() or scratch_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    with _shuffles_removed(spark):
        df.write.option("compression", CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_result(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """``materialise`` what ``make`` gives; tables stored by ``make`` are deleted once that is written."""
    outer = _run.get()
    with run_folder(spark):
        df = make()
        token = _run.set(outer)
        try:
            return materialise(df, label)
        finally:
            _run.reset(token)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
