"""Parent chains against a walk from each revision, and moves over redirects."""

import random

from jurispark.operators import history as H


def walked(rows):
    parents = dict(rows)
    out = {}
    for i in parents:
        way, at = [i], i
        while parents[at] in parents and parents[at] not in way:
            at = parents[at]
            way.append(at)
        ring = parents[at] in parents
        out[i] = (None if ring else at, None if ring else len(way), sum(p == i for p in parents.values()), bool(parents[i]) and parents[i] not in parents)
    return out


def found(spark, rows):
    df = spark.createDataFrame(rows, "revid long, parentid long").selectExpr("*", "'own' AS depth", "'x' AS note", "1 AS __n")
    return {r.revid: (r.root, r.depth, r.children, r.orphan) for r in H.parent_chains(df).collect() if r.note == "x"}


def test_shuffled_ids_branches_and_missing_parents(spark):
    some = random.Random(2)
    ids = some.sample(range(1, 10_000), 400)
    rows = [(ids[0], 0)]
    for k in range(1, 400):
        kind = some.random()
        rows.append((ids[k], ids[k - 1] if kind < 0.9 else some.choice(ids[:k]) if kind < 0.96 else some.choice([None, 0, 20_000])))
    some.shuffle(rows)
    assert found(spark, rows) == walked(rows)


def test_long_chains_rings_and_nothing(spark):
    rows = [(i, i - 1) for i in range(1, 1500)] + [(5001, 5003), (5002, 5001), (5003, 5002), (5004, 5001), (6000, 6000)]
    out = found(spark, rows)
    assert out[1499] == (1, 1499, 0, False) and out[1] == (1, 1, 1, False)
    assert out[5004] == (None, None, 0, False) and out[6000] == (None, None, 1, False)
    assert found(spark, []) == {} and found(spark, [(None, 3), (7, None)]) == {7: (7, 1, 0, False)}


def test_moves_over_redirects(spark):
    pages = spark.createDataFrame([("a", "s"), ("b", "other"), ("c", None), ("d", "s")], "title string, redirect string")
    revisions = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("d",), ("z",)], "title string")
    moves = spark.createDataFrame([("s", t) for t in "abcde"] + [(None, "a"), ("s", None), ("s", "a")], "source string, target string")
    assert sorted((str(r.source), str(r.target), r.movable) for r in H.movable(moves, pages, revisions).collect()) == [("None", "a", False), ("s", "None", False), ("s", "a", True), ("s", "a", True), ("s", "b", False), ("s", "c", False), ("s", "d", False), ("s", "e", False)]
