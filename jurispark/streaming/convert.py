"""The convert job over a folder that grows: each new file once, resumable where it stopped."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from jurispark.functions.text import glob_filter
from jurispark.operators import convert as C
from jurispark.sources.dumps import RAW


def convert_stream(spark: SparkSession, source: str, output: str, errors: str, checkpoint: str, *, as_of: int, patterns: str | None = None, files_per_batch: int = 100) -> StreamingQuery:
    """Reads the files that are new since the last run, converts them and stops. Batch folders make a batch that is
    run again after a failure replace what it wrote before."""
    raw = spark.readStream.schema(RAW).option("maxFilesPerTrigger", files_per_batch).json(source)
    if patterns is not None:
        raw = raw.where(glob_filter(F.col("s1"), patterns))

    def write(batch, number: int) -> None:
        rows = C.convert(batch, as_of=as_of).persist()
        C.successes(rows).write.mode("overwrite").json(f"{output}/batch={number}")
        C.errors(rows).write.mode("overwrite").json(f"{errors}/batch={number}")
        rows.unpersist()

    return raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
