"""Long pages go through the costly patterns only where these can match."""

import re

from jurispark.operators import jobs as J


def test_numbers_are_looked_for_at_their_parentheses_only():
    """What stands before a number was looked at on each of 4000 characters."""
    assert re.match(r"\(\?=\[（\(\]20", J._CASE)


def test_courts_types_and_numbers_in_long_texts(spark):
    long = "文" * 3000
    rows = [(1, "甲县人民法院\n民事判决书\n" + long + "（2024）京1号"), (2, long + "账号（2024）京2号，（2024）京3号"), (3, None), (4, long + "判决书")]
    found = {r.k: r for r in J.infer_from_text(spark.createDataFrame(rows, "k long, content string")).collect()}
    assert (found[1].court, found[1].doc_type, found[1].case_number) == ("甲县人民法院", "民事判决书", "（2024）京1号")
    assert (found[2].court, found[2].doc_type, found[2].case_number) == ("", "", "（2024）京3号")
    assert (found[3].court, found[3].doc_type, found[4].doc_type) == ("", "", "")
