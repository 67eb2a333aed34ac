"""Materialising tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Rows that one task of a join holds and sorts.
SORTED = 1 << 18
#: Folders of the tables that go at the end of the block of ``passing`` that this is in.
_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def shared_dir(spark: SparkSession) -> str:
    """This session's part of spark.checkpoint.dir, which goes when the session ends; in local mode without one, a temporary
    folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        where = spark.conf.get("spark.checkpoint.dir", None)
        if where is None and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(where or tempfile.mkdtemp(prefix="jurispark-"))
    folder = sc.getCheckpointDir()
    where = sc._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(where)
    return folder


def cut(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def keep(df: DataFrame) -> DataFrame:
    """df as a table of the shared folder, written once: whoever reads it sees the same rows, however often it is evaluated,
    and whatever became of the settings that its scan was dealt out by."""
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    if (passing := _PASSING.get()) is not None:
        passing.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def passing(spark: SparkSession):
    """Tables that ``keep`` writes inside the block go at its end, so what leaves it must not read them."""
    paths: list[str] = []
    token = _PASSING.set(paths)
    try:
        yield
    finally:
        _PASSING.reset(token)
        for path in paths:
            delete(spark, path)


def spread(df: DataFrame, rows: int, key: str) -> DataFrame:
    """df for a join by ``key`` whose larger side has so many rows: dealt out over parts that grow with these, where the
    session's number of shuffle partitions would give a task more than ``SORTED`` of them."""
    parts = -(-rows // SORTED)
    return df.repartition(parts, key) if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df
