"""Costly queries on a table of one file are dealt out over the cores."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["masked_lists", "record_search"])
def test_rows_of_one_file_are_dealt_out(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [o_orderkey" in plan


def test_parts_grow_with_the_rows(spark, monkeypatch):
    """A task's rows stay the same: before, a table was dealt out over the cores however many rows it had."""
    from jurispark.plans import registry

    monkeypatch.setattr(registry, "ROWS", 100)
    for name in ("convert_route", "record_search", "masked_lists"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "RepartitionByExpression" in plan and "], 16" in plan, name


def test_rows_are_dealt_out_behind_the_join(spark):
    plan = entry.queries()["convert_route"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.index("RepartitionByExpression [o_orderkey") < plan.index("Join")


def test_rows_without_a_key_stay_out_of_the_joins(spark):
    """They used to meet in one task of each join."""
    from jurispark.operators.relational import anti_dedupe

    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, "b"), (5, None)], "line long, key string")
    found = anti_dedupe(df, spark.createDataFrame([("a",), ("a",), (None,)], "key string"), "key", "line")
    assert {(r.line, r.key, r.outcome) for r in found.collect()} == {(1, "a", "exists"), (2, None, "new"), (3, "b", "new"), (4, "b", "duplicate"), (5, None, "new")}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and "isnotnull(key" in plan and "isnull(key" in plan


def test_parts_of_joins_grow_with_the_rows(spark, monkeypatch):
    from jurispark.sources import shared

    expected = sorted(entry.queries()["case_redirect_job"](spark, SF).collect())
    monkeypatch.setattr(shared, "SORTED", 20)
    found = entry.queries()["case_redirect_job"](spark, SF)
    assert "RepartitionByExpression [key" in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(found.collect()) == expected
