"""Mixing sources to target weights by systematic sampling, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jurispark.llm.common import cut, md5_int

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Documents in one sorted run; larger (source, size band) groups are dealt out by a hash of the id.
RUN = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, source: str, weights=(5, 2, 1), share: float = 1.0, cap: float = 3.0) -> DataFrame:
    """One row for each source: source, source_size, weight, target.

    Sources by code point, null last, take the weights in turn. They share ``share`` of all sizes by weight;
    no target exceeds ``cap`` times its source's size, and what is cut off goes to the others by weight. With
    sources in the order of cap * size / weight, those that reach the cap are a prefix, and the level that
    the others share is the greatest of (total - caps before) / (weights - weights before).
    The windows run over one row for each source.
    """
    totals = sizes.groupBy(source).agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col(source).asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    ranked = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), (turn + 1).cast("int")))
    by_ratio = Window.orderBy(F.lit(cap) * F.col("source_size") / F.col("weight"), F.col(source).asc_nulls_last())
    before, every = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(1))
    rest = F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum(F.col("source_size") * F.lit(cap)).over(before), F.lit(0.0))
    level = rest / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    ranked = ranked.withColumn("level", level)
    return ranked.select(source, "source_size", "weight", F.least(F.col("source_size") * F.lit(cap), F.max("level").over(every) * F.col("weight")).alias("target"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=(5, 2, 1), share: float = 1.0, cap: float = 3.0, seed: int = 7) -> DataFrame:
    """Systematic sampling of documents to target weights.

    A document's expected copies are its source's target over its source's size. Within a source, documents
    stand in the order of size band, hash run, size, id; prefix sums of expected copies get one random offset
    for each source, and a document is taken once for each integer that its interval crosses. As sizes rise
    along the order, what a source takes stays near its target. Reruns give the same rows: the order and the
    offset are functions of the rows and the seed.

    Prefix sums go by level, so that no task holds a source: counts of (source, band), then of (source, band,
    run), then rows within a run of about ``RUN`` documents.

    Returns id, source, size, source_size, target, copies, taken. Null texts and texts without words have size
    0 and take part with copies of no words; a null source is a source; repeated rows are documents of their
    own; a null id is an id. Other columns are not read. An empty table gives an empty result.
    """
    # rows without id are dealt out by their place
    tag = F.when(F.col(id_col).isNull(), F.monotonically_increasing_id())
    thin = cut(docs.select(F.col(id_col).alias("__id"), F.col(source_col).alias("__source"), word_count(F.col(text_col)).alias("size"), tag.alias("__tag")))
    targets = source_targets(thin, "__source", weights, share, cap)
    offset = md5_int(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("__source"), F.lit("\x00"))), 4) / F.lit(65536.0)
    targets = targets.select("__source", "source_size", "target", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"), offset.alias("offset"))

    thin = thin.withColumn("band", F.length(F.bin("size")))
    bands = thin.groupBy("__source", "band").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("__source").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = bands.select("__source", "band", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("band_at"), F.ceil(F.col("n") / RUN).cast("long").alias("runs"))
    bands = bands.alias("b").join(targets.alias("t"), F.expr("b.__source <=> t.__source")).select("b.*", "source_size", "target", "rate", "offset")
    rows = thin.alias("d").join(bands.alias("b"), F.expr("d.__source <=> b.__source AND d.band = b.band"))
    rows = rows.select("d.*", "band_at", "source_size", "target", "rate", "offset", F.coalesce(md5_int(F.col("__id"), 8) % F.col("runs"), F.col("__tag") % F.col("runs")).alias("run")).drop("__tag")

    runs = rows.groupBy("__source", "band", "run").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("__source", "band").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("__source", "band", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("run_at"))
    rows = rows.alias("d").join(runs.alias("r"), F.expr("d.__source <=> r.__source AND d.band = r.band AND d.run = r.run")).select("d.*", "run_at")

    within = Window.partitionBy("__source", "band", "run").orderBy("size", "__id")
    rank = F.col("band_at") + F.col("run_at") + F.row_number().over(within)
    rows = rows.withColumn("rank", rank)
    copies = F.floor(F.col("rate") * F.col("rank") + F.col("offset")) - F.floor(F.col("rate") * (F.col("rank") - 1) + F.col("offset"))
    rows = rows.withColumn("copies", copies.cast("long"))
    return rows.select(F.col("__id").alias(id_col), F.col("__source").alias(source_col), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def emit(mixed: DataFrame) -> DataFrame:
    """One row for each copy, numbered from 1; documents that the mix doesn't take are gone."""
    return mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))


#: The same rows in DuckDB.
MIX_SQL = r"""
WITH thin AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM thin GROUP BY source),
ranked AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM totals),
levels AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(source_size * 3.0::DOUBLE) OVER w, 0.0::DOUBLE)) / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0.0::DOUBLE)) AS level
  FROM ranked WINDOW w AS (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size, least(source_size * 3.0::DOUBLE, max(level) OVER () * weight) AS target, ('0x' || substr(md5('7:' || coalesce(source, chr(0))), 1, 4))::BIGINT / 65536.0::DOUBLE AS off FROM levels),
banded AS (SELECT d.*, source_size, target, off, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate, length(bin(size)) AS band,
    coalesce(('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % CAST(ceil(count(*) OVER (PARTITION BY d.source, length(bin(size))) / 4096.0) AS BIGINT), 0) AS run
  FROM thin d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY band, run, size, doc_id) AS rank FROM banded)
SELECT doc_id, source, size, source_size, target, copies, copies * size AS taken
FROM (SELECT *, CAST(floor(rate * rank + off) - floor(rate * (rank - 1) + off) AS BIGINT) AS copies FROM placed)
"""


def mix_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The documents that the mix takes, with all their columns, once for each copy; ``copy`` numbers these from 1.

    Rows that agree in id, source and size take their copies in the order of their texts.
    """
    keys = [id_col, source_col, "__size"]
    mixed = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options).withColumnRenamed("size", "__size")
    mixed = emit(mixed.withColumn("__place", F.row_number().over(Window.partitionBy(*keys).orderBy("copies"))).where("copies > 0"))
    placed = docs.drop("copy").withColumn("__size", word_count(F.col(text_col)))
    placed = placed.withColumn("__place", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(text_col).asc_nulls_first())))
    same = " AND ".join(f"d.`{k}` <=> m.`{k}`" for k in [*keys, "__place"])
    return placed.alias("d").join(mixed.alias("m"), F.expr(same)).select(*[F.col(f"d.`{c}`") for c in docs.columns if c != "copy"], F.col("m.copy"))
