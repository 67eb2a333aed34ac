import os

import pytest

import __spark_entry__ as entry
from tests.oracle import plain, rows

SF = "/root/testdata/sf0.001"
OWN = [n for n in entry.queries() if not n.startswith("op") and n != "pipeline"]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.mark.parametrize("name", OWN)
def test_query(spark, name):
    found = entry.queries()[name](spark, SF).toPandas()
    assert len(found.columns)
    if name in entry.oracle_sql():
        assert plain(found) == plain(rows(entry.oracle_sql()[name], SF))


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_cjk_spaces_go_from_bodies(spark):
    """No space between two Chinese characters stays in any body."""
    found = entry.queries()["cjk_space_clean"](spark, SF)
    assert found.where("body RLIKE '上海市浦东新区人民法院'").count() > 0
    assert found.where("body RLIKE '[\\\\x{4e00}-\\\\x{9fff}] +[\\\\x{4e00}-\\\\x{9fff}]'").count() == 0
