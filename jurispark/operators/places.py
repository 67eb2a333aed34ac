"""Which province a city is in, learnt from court names that tell both."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jurispark.functions.chars import MUNICIPALITIES, PROVINCES
from jurispark.functions.text import compact

#: Cities that a table may hold. There are a few hundred; more means that names were not court names.
LIMIT = 5000


def learn_places(courts: DataFrame, column: str, *, least: int = 1) -> DataFrame:
    """city, province, n: names that begin with a province and go on with a city, prefecture or league. Of several
    provinces of a city the most frequent counts, then the first by name; ``least`` names must agree."""
    name = compact(F.col(column))
    inside = "|".join(p for p in PROVINCES if p not in MUNICIPALITIES)
    found = courts.select(F.regexp_extract(name, f"^({inside})", 1).alias("province"), F.regexp_extract(name, f"^(?:{inside})([^市州盟县区旗]{{1,10}}(?:市|自治州|州|盟|地区))", 1).alias("city"))
    found = found.where("province <> '' AND city <> ''").withColumn("city", F.regexp_replace("city", "市$", ""))
    counts = found.groupBy("city", "province").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    best = Window.partitionBy("city").orderBy(F.desc("n"), "province")
    return counts.withColumn("__r", F.row_number().over(best)).where("__r = 1").select("city", "province", "n")


def place_table(places: DataFrame, *, known: dict[str, str] | None = None, limit: int = LIMIT) -> dict[str, str]:
    """A table for ``metadata.location``: municipalities and known cities, then learnt ones, longer names first so that none
    hides in another. A dimension of bounded size; more than ``limit`` cities raise ValueError."""
    rows = places.select("city", "province").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} cities")
    learnt = sorted(((r.city, r.province) for r in rows), key=lambda r: (-len(r[0]), PROVINCES.index(r[1]) if r[1] in PROVINCES else len(PROVINCES), r[0]))
    return {m.removesuffix("市"): m for m in MUNICIPALITIES} | (known or {}) | dict(learnt)


def read_places(spark, path: str) -> DataFrame:
    """city, province, n of a table of one's own: CSV with a head line."""
    return spark.read.option("header", True).csv(path).select("city", "province", F.lit(1).cast("long").alias("n"))
