"""The named queries of this library and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Rows that one task gets of a table whose rows are costly, and bytes of a split of a file.
ROWS, SPLIT = 1 << 16, 128 << 20
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``f(spark, sf_dir) -> DataFrame`` under a name, with DuckDB SQL for the same rows."""

    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


def parts(df: DataFrame) -> int:
    """Over how many parts the rows of a scan are dealt out where they are costly: all cores, and as often again as it takes
    for a part to hold about ``ROWS`` rows at most, so that a task's work stays the same however large the table is. Rows
    are counted from the files' footers."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return cores * max(1, -(-df.count() // (cores * ROWS)))


def table(spark: SparkSession, sf_dir: str, name: str, key: str | None = None) -> DataFrame:
    """A table of the folder. With ``key``, rows are dealt out by it, unless the splits of its files are as many parts: a
    row group is one task's, however costly what is made of its rows."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if key is None:
        return df
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    n = parts(df)
    return df if max(len(df.inputFiles()), size // SPLIT) >= n else df.repartition(n, key)
