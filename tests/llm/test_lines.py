"""Line dedup against plain Python, with odd rows, small filters and parts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from jurispark.llm import line_dedup as L


def plain(rows, least_chars=40, least_docs=5):
    """The contract, line by line."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(lower)
    rank = lambda i: -1 if i is None else i
    held = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            held.setdefault(key(line), set()).add(rank(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if len(key(x)) < least_chars or len(held[key(x)]) < least_docs or max(held[key(x)]) == rank(i)]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=str)


def texts(n, seed=3):
    some = random.Random(seed)
    word = lambda: "".join(some.choice("abcé😀 XY") for _ in range(some.randint(30, 60)))
    pool = [word() for _ in range(60)] + ["Common line that a third of all documents holds, whatever they are"] * 30 + ["short"] * 10 + ["", "\t " + "é" * 40 + "\r", "é" * 39, "É" * 40, "é" * 40]
    dress = lambda x: some.choice(["", " ", "\t\x0b"]) + (x.upper() if some.random() < 0.2 else x) + some.choice(["", "\r", " "])
    return [(i, "\n".join(dress(some.choice(pool)) for _ in range(some.randint(0, 9)))) for i in range(n)]


def found(df, **options):
    out = L.dedup_lines(df, **options)
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()), key=str)


@pytest.mark.parametrize("bits", [1, 1 << 20, 1 << 30])
def test_against_plain(spark, bits):
    """However small the filters are."""
    rows = texts(400) + [(7, None), (None, None), (None, "x " * 50), (8, ""), (9, "\n\n"), (3, texts(400)[3][1]), (3, texts(400)[3][1]), (1000, "long " * 40000 + "\n" + "é" * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("own") for c in ("id", "key", "lost", "n", "holder", "n_lines", "text_")})
    assert found(df, most_bits=bits) == plain(rows)


def test_other_columns_ids_and_empty_tables(spark):
    rows = [(f"d{i}", "the same line of forty characters or more, in all of them\nown", i) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id string, text string, key int")
    out = {r.doc_id: (r.text, r.key, r.n_dropped) for r in L.dedup_lines(df).collect()}
    assert out == {f"d{i}": ("own" if i < 5 else rows[5][1], i, int(i < 5)) for i in range(6)}
    assert L.dedup_lines(df.limit(0)).collect() == [] and L.dedup_lines(df.limit(0)).columns == ["doc_id", "text", "key", "n_lines", "n_dropped"]
    nothing = spark.createDataFrame([(None, None)] * 6, "doc_id long, text string")
    assert found(nothing) == [(None, "", 1, 0)] * 6


def test_filter_misses_no_repeat_and_passes_few_others(spark, monkeypatch):
    rows = [(i, f"line number {i} of those that stand in one document only\nline number {i // 3 if i < 300 else i} of those that some share, long enough") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    monkeypatch.setattr(L, "PART", 100)
    bits = L.filter_bits(df, "text", 40, 8, 1 << 30)
    keys = {r.key for r in L.suspects(df, "doc_id", "text", 40, L.repeat_filter(df, "text", 40, bits)).collect()}
    shared = {f"line number {i} of those that some share, long enough" for i in range(100)}
    assert shared <= keys and len(keys) < 600


def test_dense_parts(spark, monkeypatch):
    """Bitmaps and places say the same."""
    df = spark.range(20000).selectExpr("id AS doc_id", "concat('a line that is long enough to count in documents ', id % 15000) AS text")
    a = L.repeat_filter(df.repartition(3), "text", 40, L.BLOCK_BITS)
    monkeypatch.setattr(L, "PART", 50)
    b = L.repeat_filter(df.repartition(3), "text", 40, L.BLOCK_BITS)
    assert np.unpackbits(a).sum() > 0 and not np.any(a & ~b)
