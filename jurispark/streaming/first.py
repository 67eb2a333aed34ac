"""The first row of each key over a folder that grows, with what was seen as state that outlives a stop."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


#: Rows that a task gathers before it looks for the least ones among them.
KEPT = 1 << 17


def first_wins(rows: DataFrame, key: str, order: str, *, otherwise: str | None = None) -> DataFrame:
    """Of a stream's rows, the first of each key: the one with the least ``order`` of the first batch that has the key.

    Rows with an empty or null key go by ``otherwise``, as ``<name>:<value>``, or are all passed over without it. Each task
    keeps the least row of a key in each of its batches before the shuffle, so a key that a third of the rows have reaches
    its task as few rows; behind the shuffle a task keeps one row of each of its keys of the stream's batch, and no code
    runs key by key. The state is one mark for each key, kept by Spark's own deduplication; on large streams set RocksDB
    as the state store.
    """
    instead = F.lit(None).cast("string") if otherwise is None else F.concat(F.lit(f"{otherwise}:"), F.col(otherwise).cast("string"))
    keyed = rows.withColumn("__key", F.coalesce(F.nullif(F.col(key).cast("string"), F.lit("")), instead)).where("__key IS NOT NULL")
    schema = keyed.schema

    def least(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table, [(order, "ascending")]))
        table = table.append_column("__at", pa.array(np.arange(table.num_rows)))
        first = table.group_by("__key", use_threads=False).aggregate([("__at", "min")])["__at_min"]
        return table.take(first).drop_columns("__at")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from least(pa.Table.from_batches([batch])).to_batches()

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, more, size = None, [], 0
        for batch in batches:
            more.append(pa.Table.from_batches([batch]))
            size += batch.num_rows
            if size >= max(KEPT, best.num_rows if best is not None else 0):
                best, more, size = least(pa.concat_tables([*([best] if best is not None else []), *more])), [], 0
        if best is not None or more:
            yield from least(pa.concat_tables([*([best] if best is not None else []), *more])).to_batches(max_chunksize=10000)

    few = keyed.mapInArrow(of_batches, schema).repartition("__key").mapInArrow(of_task, schema)
    return few.dropDuplicates(["__key"]).drop("__key")


def first_wins_stream(spark: SparkSession, source: str, schema: StructType | str, output: str, checkpoint: str, *, key: str, order: str, otherwise: str | None = None, files_per_batch: int = 100) -> StreamingQuery:
    """Reads the files of JSON lines that are new since the last run, in the order in which they came, appends rows with new
    keys to ``output`` as Parquet, and stops. Started again after a stop at any place it goes on from the last batch that
    was committed; the sink's log keeps a batch that is run again from being counted twice."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(source)
    found = first_wins(rows, key, order, otherwise=otherwise)
    return found.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
