"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from jurispark.operators.relational import with_ordinal

#: Bytes after lower-casing A-Z; everything that is not 0-9, a-z or part of a non-ASCII character becomes a space.
ALNUM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Lower-cases A-Z only.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


#: Rows of an Arrow batch: texts may be long, and a worker holds a batch several times over.
BATCH_ROWS = 2000


def lean_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches, unless the session has a setting of its own."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not spark._jsparkSession.sessionState().conf().contains(key):
        spark.conf.set(key, str(BATCH_ROWS))


def lean(run):
    """A batch function that gives its memory back at the end of a task: idle workers are kept for later tasks."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return wrapped


def shared_dir(spark: SparkSession) -> str:
    """This session's part of the folder that driver and executors share, spark.checkpoint.dir; it goes when the session
    ends. In local mode without one, a temporary folder."""
    lean_batches(spark)
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
    """Materialise df in the shared folder: later readers neither recompute it nor depend on an executor's disk."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession):
    """Gives ``keep(df)``, which writes a table to the shared folder and reads it again. Columns on disk take a fraction
    of what checkpoints of rows do. The tables go at the end of the block, so what leaves it must not read them;
    ``keep.drop(*tables)`` deletes those that nothing reads any more before that."""
    paths: dict[int, str] = {}

    def keep(df: DataFrame) -> DataFrame:
        path = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
        # Spark deletes the shuffle files of finished steps when the driver collects its garbage; a driver with room to
        # spare does so too seldom, and the files pile up. Those of the step before may still be held by its last events
        # when it ends, so garbage is collected ahead of a step as well
        spark.sparkContext._jvm.System.gc()
        df.write.parquet(path)
        spark.sparkContext._jvm.System.gc()
        out = spark.read.schema(df.schema).parquet(path)
        paths[id(out)] = path
        held.append(out)
        return out

    def drop(*tables: DataFrame) -> None:
        for t in tables:
            delete(spark, paths.pop(id(t)))

    held: list[DataFrame] = []  # so that no id is given twice
    keep.drop = drop
    try:
        yield keep
    finally:
        for path in paths.values():
            delete(spark, path)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    lean_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns or ["*"])


def by_number(docs: DataFrame, id_col: str, work, *id_columns: str) -> DataFrame:
    """``work(docs)`` with ids as whole numbers in their order. Ids of another type are numbered first, and their numbers in
    the given columns of the result become ids again; that takes a sort of the different ids and a join for each."""
    if isinstance(docs.schema[id_col].dataType, IntegralType):
        return work(docs)
    names = docs.select(F.col(id_col).alias("__name")).where("__name IS NOT NULL").distinct().orderBy("__name")
    names = cut(with_ordinal(cut(names), "__number"))
    rest = [c for c in docs.columns if c != id_col]
    out = work(docs.join(names, docs[id_col] == names["__name"], "left").select(F.col("__number").alias(id_col), *rest))
    for c in id_columns or (id_col,):
        out = out.join(names, out[c] == names["__number"], "left").select(*[F.col("__name").alias(c) if x == c else F.col(x) for x in out.columns])
    return out


def numbered_columns(docs: DataFrame) -> tuple[DataFrame, dict[str, str], list]:
    """docs with columns named by number, their new names, and what gives them their names back: so none clashes with a
    column that an operator adds."""
    new = {c: f"__{i}" for i, c in enumerate(docs.columns)}
    return docs.select([F.col(f"`{c}`").alias(n) for c, n in new.items()]), new, [F.col(n).alias(c) for c, n in new.items()]


def raw(column: pa.Array) -> list[bytes | None]:
    """A string column's UTF-8 bytes, without decoding them."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def alnum_words(text: bytes | None) -> list[bytes]:
    """Words of 0-9, a-z and non-ASCII characters, A-Z lower-cased."""
    return text.translate(ALNUM).split() if text else []


def md5_int(column, digits: int):
    """The first hex digits of a string's MD5 as a number; the same in any SQL engine."""
    return F.conv(F.substring(F.md5(column.cast("string")), 1, digits), 16, 10).cast("long")
