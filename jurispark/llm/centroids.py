"""Centroid clustering of whole-number vectors: sort-means, exact at any magnitude."""

from __future__ import annotations

import hashlib
import math
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jurispark.llm.common import cut, lean, lean_batches, scratch

#: Sums that don't fit a long are carried as digits of so many bits.
DIGIT = 32
LONGEST = (1 << 63) - 1


def distances(v: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of rows to one centroid, or of each row to its own."""
    away = v - centroid
    return (away * away).sum(axis=1)


def nearest(v: np.ndarray, previous: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row (ties: the smaller number), and the squared distance to it.

    From a row's previous centroid c at distance d, the others are tried by their distance from c. One that is strictly
    beyond 2d from c is farther from the row than c is, and so are all behind it.
    """
    between = [distances(centroids, c) for c in centroids]
    best, least = previous.copy(), distances(v, centroids[previous])
    reach = 4 * least
    for c in np.unique(previous):
        rows = np.flatnonzero(previous == c)
        for o in sorted((o for o in range(len(centroids)) if o != c), key=lambda o: (between[c][o], o)):
            rows = rows[reach[rows] >= between[c][o]]
            if not len(rows):
                break
            d = distances(v[rows], centroids[o])
            better = ((d < least[rows]) | ((d == least[rows]) & (o < best[rows]))).astype(bool)
            best[rows[better]], least[rows[better]] = o, d[better]
    return best, least


def _whole(values: np.ndarray, centroids: list[list[int]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and centroids as longs where four squared distances fit one, else as Python's whole numbers."""
    most = math.isqrt((1 << 62) // (16 * width))
    if (not len(values) or np.abs(values).max() <= most) and all(abs(x) <= most for c in centroids for x in c):
        return values.astype(np.int64).reshape(-1, width), np.array(centroids, np.int64)
    exact = np.empty(len(values), object)
    exact[:] = [int(x) for x in values]
    return exact.reshape(-1, width), np.array(centroids, object)


def _digits(sums: list[int]) -> list[int]:
    """Whole numbers as digits, the lowest of all first; the highest carry the sign."""
    if all(abs(s) <= LONGEST for s in sums):
        return sums
    n = max(s.bit_length() for s in sums) // DIGIT + 1
    low = [(s >> (DIGIT * i)) & ((1 << DIGIT) - 1) for i in range(n - 1) for s in sums]
    return low + [s >> (DIGIT * (n - 1)) for s in sums]


def _assigned(batch: pa.RecordBatch, centroids: list[list[int]], width: int):
    values = batch.column(1).flatten().to_numpy(zero_copy_only=False)
    v, c = _whole(values, centroids, width)
    return v, *nearest(v, batch.column(2).to_numpy(zero_copy_only=False), c)


def cluster_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", width: int = 64, k: int = 8, rounds: int = 10, scale: float = 1024.0, seed: str = "3") -> DataFrame:
    """id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256 and centroid of each vector that is kept.

    Kept are vectors of ``width`` finite components that stay finite when scaled; components become floor(scale * x). The
    k vectors whose ``seed:id`` has the least SHA-256 are the first centroids, in that order (repeated ids: by the vector,
    component by component; fewer vectors: fewer centroids). Each round assigns all vectors and makes each centroid
    the floored mean of its own; one without vectors stays. Rounds that change nothing end the walk, as all later ones
    would do the same.

    A round reads the table once and writes it again with the new assignment, and the last row of each batch holds the
    batch's sums, so that they are added up from a column of their own; the table before is deleted then. Only k * width
    sums reach the driver. A large cluster is no group: all its vectors stay where they are.

    All arithmetic is exact. Distances and inertias beyond a long are given as the largest long. Null ids are hashed as
    empty ids; repeated rows are vectors of their own; other columns are left out. No vectors give no rows.
    """
    spark = vectors.sparkSession
    lean_batches(spark)
    scaled = F.transform(F.col(f"`{vector_col}`"), lambda x: x.cast("double") * F.lit(float(scale)))
    finite = F.forall(scaled, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(math.inf)), F.lit(False)))
    # sizes and parts are looked at in this order; a null vector isn't kept
    good = F.coalesce(F.when(F.size(F.col(f"`{vector_col}`")) == width, finite), F.lit(False))
    base = vectors.where(good).select(F.col(f"`{id_col}`").alias("id"), scaled.alias("v"), F.lit(0).alias("cluster"))
    first = base.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), "v").limit(k).collect()
    centroids = [[math.floor(x) for x in row.v] for row in first]
    kind = base.schema["id"].dataType.simpleString()
    if not centroids:
        return spark.createDataFrame([], f"`{id_col}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<double>")

    def moved(table: DataFrame, centroids: list[list[int]]) -> DataFrame:
        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                batch = _floored(batch)
                v, cluster, _ = _assigned(batch, centroids, width)
                sums = [[int(s) for s in v[cluster == c].sum(axis=0)] + [int((cluster == c).sum())] if (cluster == c).any() else [0] * (width + 1) for c in range(len(centroids))]
                said = [None] * (batch.num_rows - 1) + [_digits([s for own in sums for s in own])]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cluster, pa.int32()), pa.array(said, pa.list_(pa.int64()))], names=["id", "v", "cluster", "sums"])

        return table.select("id", "v", "cluster").mapInArrow(lean(run), f"id {kind}, v array<double>, cluster int, sums array<long>")

    def means(table: DataFrame, before: list[list[int]]) -> list[list[int]]:
        parts = table.where("sums IS NOT NULL").select(F.posexplode("sums").alias("at", "part"))
        totals = [0] * (len(before) * (width + 1))
        for row in parts.groupBy("at").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part")).collect():
            digit, at = divmod(row["at"], len(totals))
            totals[at] += int(row["part"]) << (DIGIT * digit)
        own = [totals[i : i + width + 1] for i in range(0, len(totals), width + 1)]
        return [[s // sums[-1] for s in sums[:-1]] if sums[-1] else old for sums, old in zip(own, before, strict=True)]

    def final(table: DataFrame, centroids: list[list[int]]) -> DataFrame:
        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    batch = _floored(batch)
                    _, cluster, least = _assigned(batch, centroids, width)
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster, pa.int32()), pa.array([min(int(d), LONGEST) for d in least], pa.int64())], names=["id", "cluster", "distance"])

        return table.select("id", "v", "cluster").mapInArrow(lean(run), f"id {kind}, cluster int, distance long")

    with ExitStack() as held:
        table, old = base, ExitStack()
        held.callback(lambda: old.close())
        for _ in range(rounds):
            new = ExitStack()
            held.push(new)
            table = new.enter_context(scratch(spark))(moved(table, centroids))
            old.close()
            before, old = centroids, new
            centroids = means(table, before)
            if centroids == before:
                break
        found = cut(final(table, centroids))
    said = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest(), [float(x) for x in c]) for i, c in enumerate(centroids)]
    return _with_inertia(found, said).select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid")


def _floored(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Components rounded down; in later rounds they already are."""
    column = batch.column(1)
    values = np.floor(column.flatten().to_numpy(zero_copy_only=False))
    width = len(values) // batch.num_rows
    lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * width, pa.int32()), pa.array(values, pa.float64()))
    return pa.RecordBatch.from_arrays([batch.column(0), lists, batch.column(2)], names=["id", "v", "cluster"])


def _with_inertia(found: DataFrame, centroids: list[tuple]) -> DataFrame:
    """Adds sums of distances and the centroids, from one row for each cluster."""
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {r["cluster"]: int(r["total"]) for r in found.groupBy("cluster").agg(total.alias("total")).collect()}
    every = min(sum(sums.values()), LONGEST)
    rows = [(i, min(sums[i], LONGEST), every, digest, c) for i, digest, c in centroids if i in sums]
    few = found.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<double>")
    return found.join(F.broadcast(few), "cluster")
