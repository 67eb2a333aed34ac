"""Cities found by their own substrings, against a walk through the table."""

import random
import time

from pyspark.sql import functions as F

from jurispark.functions import metadata as M


def walked(court, cities):
    return next(((c, p) for c, p in cities.items() if c in court), None)


def test_first_in_the_order_of_the_table(spark):
    some = random.Random(4)
    signs = "甲乙丙丁|戊.("
    names = list(dict.fromkeys("".join(some.choice("甲乙丙丁戊") for _ in range(some.randint(1, 4))) for _ in range(80)))
    courts = ["", "甲", *("".join(some.choice(signs) for _ in range(some.randint(0, 12))) for _ in range(500))]
    df = spark.createDataFrame([(c,) for c in courts], "court string")
    for size in (1, 7, len(names)):
        some.shuffle(names)
        cities = {n: f"p{i % 5}" for i, n in enumerate(names[:size])}
        found = df.select("court", M._city(F.col("court"), cities).alias("c")).collect()
        assert [(tuple(r.c) if r.c else None) for r in found] == [walked(r.court, cities) for r in found]
    assert df.select(M._city(F.col("court"), {}).alias("c")).where("c IS NOT NULL").count() == 0


def test_a_table_of_five_thousand(spark):
    """Takes no more than a few times what a table of thirty does."""
    some = random.Random(5)
    sign = lambda: chr(some.randint(0x4E00, 0x9FA5))
    cities = {}
    while len(cities) < 5000:
        cities["".join(sign() for _ in range(some.randint(2, 4)))] = "省"
    names = list(cities)
    courts = spark.range(200_000).select(F.concat(F.element_at(F.split(F.lit("|".join(names[:50])), r"\|"), (F.col("id") % 50 + 1).cast("int")), F.lit("市中级人民法院")).alias("court")).cache()
    courts.count()

    def took(table):
        began = time.time()
        n = courts.select(M._city(F.col("court"), table).alias("c")).where("c IS NOT NULL").count()
        return time.time() - began, n

    took(dict(list(cities.items())[:30]))
    small, n_small = took(dict(list(cities.items())[:30]))
    large, n_large = took(cities)
    courts.unpersist()
    assert (n_small, n_large) == (120_000, 200_000) and large < 10 * small + 5
