"""Centroid clustering against plain Lloyd rounds in Python's whole numbers, with odd vectors."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jurispark.llm import centroids as C


def plain(rows, width, k=8, rounds=10, scale=1024):
    kept = [(i, [math.floor(Fraction(x) * scale) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    centres = [v for _, v in sorted(kept, key=lambda r: (sha(f"3:{'' if r[0] is None else r[0]}"), r[1]))[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in range(len(centres)):
            mine = [v for (_, v), o in zip(kept, own, strict=True) if o == j]
            if mine:
                centres[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found = [(i, *near(v)) for i, v in kept]
    cap = lambda x: min(x, C.LONGEST)
    total = sum(cap(d) for _, d, _ in found)
    by = {j: sum(cap(d) for _, d, o in found if o == j) for j in range(len(centres))}
    return sorted([(i, j, cap(d), cap(by[j]), cap(total), sha(",".join(map(str, centres[j])))) for i, d, j in found], key=str)


def found(df, **options):
    out = C.cluster_vectors(df, **options)
    return sorted((tuple(r)[:6] for r in out.collect()), key=str)


def vectors(n, width, seed, size=1.0):
    some = random.Random(seed)
    middles = [[some.uniform(-size, size) for _ in range(width)] for _ in range(5)]
    return [(i, [float(np.float32(x + some.gauss(0, size / 5))) for x in some.choice(middles)]) for i in range(n)]


def test_rounds_against_plain(spark):
    rows = vectors(400, 6, 1)
    odd = [(None, rows[0][1]), (5, rows[5][1]), (5, rows[5][1]), (5, rows[9][1]), (900, None), (901, []), (902, rows[0][1][:5]), (903, [None] + rows[0][1][1:]), (904, [float("nan")] + rows[0][1][1:]), (905, [float("inf")] + rows[0][1][1:]), (906, [-0.0] * 6), (907, [0.0] * 6)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumns({c: F.lit("own") for c in ("id", "v", "cluster", "sums", "distance", "inertia")}).repartition(5)
    assert found(df, width=6) == plain(rows + odd, 6)


def test_ties_and_empty_clusters(spark):
    """Equal vectors, centroids that coincide and lose all their vectors, and points halfway between two."""
    rows = [(i, [float(i % 3 - 1), 0.0]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(df, width=2) == plain(rows, 2)
    assert found(df.where("vec_id < 3"), width=2, rounds=1) == plain(rows[:3], 2, rounds=1)
    assert found(df.limit(0), width=2) == [] and C.cluster_vectors(df.limit(0), width=2).columns[:3] == ["vec_id", "cluster", "distance"]
    assert found(df, width=2, rounds=0) == plain(rows, 2, rounds=0)


@pytest.mark.parametrize("size", [1e5, 1e12, 3e30])
def test_any_magnitude(spark, size):
    """Components whose squares and sums don't fit longs."""
    rows = vectors(60, 4, 2, size) + vectors(20, 4, 3)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    assert found(df, width=4, rounds=3) == plain(rows, 4, rounds=3)


@given(st.lists(st.tuples(st.integers(-4, 4), st.integers(-4, 4)), min_size=1, max_size=40), st.lists(st.tuples(st.integers(-4, 4), st.integers(-4, 4)), min_size=1, max_size=6), st.data())
def test_nearest_from_any_start(points, centres, data):
    start = np.array([data.draw(st.integers(0, len(centres) - 1)) for _ in points])
    for kind in (np.int64, object):
        v, c = np.array(points, kind).reshape(-1, 2), np.array(centres, kind).reshape(-1, 2)
        best, least = C.nearest(v, start, c)
        want = [min(((x - a) ** 2 + (y - b) ** 2, j) for j, (a, b) in enumerate(centres)) for x, y in points]
        assert [(int(d), int(j)) for d, j in zip(least, best, strict=True)] == want


@given(st.lists(st.integers(-(1 << 150), 1 << 150), min_size=1, max_size=5))
def test_digits(sums):
    digits, n = C._digits(sums), len(sums)
    assert all(abs(d) <= C.LONGEST for d in digits)
    assert [sum(d << (C.DIGIT * i) for i, d in enumerate(digits[j::n])) for j in range(n)] == sums
