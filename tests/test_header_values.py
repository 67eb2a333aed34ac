"""Single values of a header are those of the map of all its parameters, whatever ends its lines."""

import random

from pyspark.sql import functions as F

from jurispark.functions import wiki as W

KEYS = ("court", "title", "案号")
PIECES = ["{{Header/裁判文书", " {{header/裁判文书 x", "\n", "\n", "\r\n", "\x0b", "\x1c", "\x1f", "\x85", " ", "　", " ", "}}", "|", "court", "title", "案号", "=", "a", "\n|court = 甲", "\n | title = b= c", "\n}}\n"]


def test_values_are_those_of_the_map(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 20))) for _ in range(2000)]
    texts += ["{{Header/裁判文书\n" + t + "\n}}" for t in texts] + [None, "{{Header/裁判文书\n|court = 1\n |court=2 \n|courtx=3\n}}x\n }} "]
    df = spark.createDataFrame([(t,) for t in texts], "x string").select("x", W.header(F.col("x")).alias("h"), W.header_block(F.col("x")).alias("b"))
    rows = df.select("x", "h", "b", *[W.header_value(F.col("b"), k).alias(k) for k in KEYS]).collect()
    assert sum(r.h is not None for r in rows) > 1000
    for r in rows:
        assert (r.h is None) == (r.b == ""), r.x
        assert [(r.h or {}).get(k, "") for k in KEYS] == [r[k] for k in KEYS], r.x


def test_a_long_header_is_read(spark):
    text = "{{Header/裁判文书\n|court = 甲\n" + "\n " * 100000 + "}}"
    b = spark.createDataFrame([(text,)], "x string").select(W.header_block(F.col("x")).alias("b"))
    assert b.select(W.header_value(F.col("b"), "court")).first()[0] == "甲"
