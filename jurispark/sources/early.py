"""Scans of files of lines that stop once they have what they look for.

Files are read by name in rounds, each with twice as many as the one before, so that all cores have work. What is
read is less than twice the files that are needed and one first round. The files of a round are read by split, side by side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jurispark.sources.dumps import SPLIT, _runs_of, _scan
from jurispark.sources.shared import keep


@dataclass(frozen=True)
class Found:
    """A line: its file, its number in it and over all files (from 1), its first byte likewise (from 0), its text; and how many of
    how many files were read for it."""

    path: str
    line: int
    total_line: int
    offset: int
    total_offset: int
    value: str
    files_read: int
    files: int


def _rounds(spark: SparkSession, path: str, first: int | None) -> tuple[int, Iterator[list[str]]]:
    files = sorted(spark.read.text(path).inputFiles())

    def rounds():
        at, size = 0, first or spark.sparkContext.defaultParallelism
        while at < len(files):
            yield files[at : at + size]
            at, size = at + size, 2 * size

    return len(files), rounds()


def _mark(spark: SparkSession, path: str) -> int:
    """Bytes of a byte order mark where a file begins; the reader drops it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(path))
    stream = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(where)
    try:
        return 3 if [stream.read() for _ in range(3)] == [0xEF, 0xBB, 0xBF] else 0
    finally:
        stream.close()


_SPLITS = "path string, block long, lines long, bytes long, line long, offset long, value string"


def _measured(batches):
    """Of each split its lines and bytes, and the first line that is looked for: its place, the bytes before it, its text."""
    key, lines, size, hit = None, 0, 0, (None, None, None)

    def row():
        values = [[v] for v in (*key, lines, size, *hit)]
        kinds = [pa.string(), *[pa.int64()] * 5, pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=[c.split()[0] for c in _SPLITS.split(", ")])

    for batch in batches:
        for path, block, at, n in _runs_of(batch):
            if (path, block) != key:
                if key is not None:
                    yield row()
                key, lines, size, hit = (path, block), 0, 0, (None, None, None)
            lengths, values = batch.column(3).slice(at, n).to_pylist(), batch.column(0).slice(at, n)
            if hit[0] is None and values.null_count < n:
                i = next(i for i in range(n) if values[i].is_valid)
                hit = lines, size + sum(lengths[:i]) + i, values[i].as_py()
                hit = hit[0] + i, hit[1], hit[2]
            lines, size = lines + n, size + sum(lengths) + n
    if key is not None:
        yield row()


def first_line(spark: SparkSession, path: str, wanted: Column, *, first: int | None = None) -> Found | None:
    """The first line, by file name and place, for which ``wanted`` (over ``value``) holds, and where it lies in bytes; None if
    there is none. What a task sends on is one row a split. Null counts as not wanted; odd bytes count as they are."""
    files, rounds = _rounds(spark, path, first)
    read = lines = size = 0
    for names in rounds:
        rows = _scan(spark.read.option("lineSep", "\n").text(names))
        seen = F.when(F.coalesce(wanted, F.lit(False)), F.make_valid_utf8("value"))
        splits = keep(rows.select(seen.alias("value"), *SPLIT, F.octet_length("value").cast("long").alias("n")).mapInArrow(_measured, _SPLITS))
        read += len(names)
        hit = splits.where("line IS NOT NULL").orderBy(*SPLIT).first()
        if hit is None:
            more = splits.agg(F.sum("lines").alias("lines"), F.sum("bytes").alias("bytes")).first()
            lines, size = lines + (more["lines"] or 0), size + (more["bytes"] or 0) + sum(_mark(spark, n) for n in names)
            continue
        ahead = splits.where((F.col("path") < hit.path) | ((F.col("path") == hit.path) & (F.col("block") < hit.block)))
        own = F.col("path") == hit.path
        total = lambda c, of: F.coalesce(F.sum(F.when(of, F.col(c))), F.lit(0))
        b = ahead.agg(total("lines", own).alias("l"), total("bytes", own).alias("b"), total("lines", ~own).alias("tl"), total("bytes", ~own).alias("tb")).first()
        before = [n for n in names if n < hit.path]
        line, offset = b.l + hit.line + 1, b.b + hit.offset + _mark(spark, hit.path)
        return Found(hit.path, line, lines + b.tl + line, offset, size + b.tb + sum(_mark(spark, n) for n in before) + offset, hit.value, read, files)
    return None


def first_rows(spark: SparkSession, path: str, key: Column, wanted: DataFrame, *, first: int | None = None) -> tuple[DataFrame, int]:
    """Of each wanted key (the one column of ``wanted``) its first line, as (key, path, value), and the number of files read. Each
    round looks for what the rounds before have not found, and the last is the one that leaves nothing to be found; keys
    without lines take all files. Nulls are not found, repeated keys count once."""
    name = wanted.columns[0]
    left = keep(wanted.where(F.col(name).isNotNull()).distinct())
    found, read = None, 0
    _, rounds = _rounds(spark, path, first)
    for names in rounds:
        if left.isEmpty():
            break
        rows = _scan(spark.read.option("lineSep", "\n").text(names)).withColumn("place", F.monotonically_increasing_id())
        lines = rows.select(key.alias(name), *SPLIT, "place", F.make_valid_utf8("value").alias("value")).join(left, name, "left_semi")
        best = lines.groupBy(name).agg(F.min_by(F.struct("path", "value"), F.struct(*SPLIT, "place")).alias("r"))
        part = keep(best.select(name, "r.path", "r.value"))
        left = keep(left.join(part, name, "left_anti"))
        found = part if found is None else found.unionByName(part)
        read += len(names)
    empty = spark.createDataFrame([], wanted.schema).withColumns({"path": F.lit("").cast("string"), "value": F.lit("").cast("string")})
    return (empty if found is None else found), read
