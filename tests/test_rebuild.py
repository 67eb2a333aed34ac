"""Pages in a new form, counters and page sources."""

import json

import pytest
from pyspark.sql import functions as F

from jurispark.functions import rebuild as B
from jurispark.operators import jobs as J
from jurispark.operators import reports as R

VALUES = {"title": "甲案", "court": "甲市人民法院", "type": "民事判决书", "案号": "（2024）甲01民初1号", "year": "2024", "docid": "d1", "docid10": "d10", "docid3": "d3"}
HEAD = "{{Header/裁判文书\n|title = 甲案\n|court = 甲市人民法院\n|type = 民事判决书\n|案号 = （2024）甲01民初1号\n|year = 2024\n|month = \n|day = \n|loc = \n|docid = d1\n|docid3 = d3\n|docid10 = d10\n}}\n"


def test_drop_prefix():
    assert B.drop_prefix("甲 市(一) 余", "甲市（一）") == " 余" and B.drop_prefix("乙", "甲") == "乙" and B.drop_prefix("乙", "") == "乙"


    assert B.drop_prefix(" a (b)　c", "a（b）") == "　c" and B.drop_prefix("a.c", "abc") == "a.c"


def test_header_and_params():
    assert B.build_header(VALUES) + "\n" == HEAD
    text = "x\n{{Header/裁判文书\n|title = 甲案 \n| court =旧\n}}\nbody"
    assert B.set_params(text, {"court": "新", "type": "判决书"}, link_title=True) == "x\n{{Header/裁判文书\n|title = [[甲案]] \n| court =新\n|type = 判决书\n}}\nbody"
    assert "|title = [[甲案]]\n" in B.set_params("{{Header/裁判文书\n|title = [[甲案]]\n}}", {}, link_title=True)
    for bad in ("no header", "{{Header/裁判文书\n|title = x", "{{Header/裁判文书\n|court = x\n}}"):
        with pytest.raises(ValueError):
            B.set_params(bad, {})


def test_intro():
    text = "top\n{{gap}}文书内容\n\n甲市人民法院\n民事判决书\n案号：(2024)甲01民初1号\n\n\n正文\n尾"
    assert B.take_intro(text) == ("top\n正文\n尾", {"court": "甲市人民法院", "type": "民事判决书", "案号": "（2024）甲01民初1号"})
    for bad in ("x", "{{gap}}文书内容\n\na\nb"):
        with pytest.raises(ValueError):
            B.take_intro(bad)


def test_inline_signature():
    body, entries = B.split_signature("驳回诉讼请求。审 判 长 王某某审判员李某二〇二四年一月二日书记员：赵某")
    assert body == "驳回诉讼请求" and entries == ["审判长：王某某", "审判员：李某", "二〇二四年一月二日", "书记员：赵某"]
    for plain in ("审判长王某", "本案由审判长王某某独任审理，原告到庭参加诉讼，现已审理终结"):
        assert B.split_signature(plain) == (plain, [])
    assert B.inline_entries("书记员甲2024年1月2日审判长乙") == ["书记员：甲", "2024年1月2日", "审判长：乙"]


def test_dense_lines():
    line = "原告：张某，" + "住址" * 200 + "。被告：李某。" + "事实" * 60 + "本院认为，理由。判决如下：一、驳回。"
    pieces = B.split_dense(line)
    assert [p[:4] for p in pieces] == ["原告：张", "被告：李", "本院认为", "判决如下"] and "".join(pieces) == line
    assert B.split_dense(" short -PAGE- ") == ["short"] and B.split_dense(" ") == [""]


def test_rebuilt_page():
    text = "{{header\n|title=x\n}}\n文书内容\n甲市人民法院\n民 事 判 决 书\n(2024)甲01民初1号\n第一段。\n{{gap}}第二段。\n\n\n第三段。\n审判长 王某\n\n{{署名|\n{{印|x}}\n审判员　李某\n二〇二四年一月二日\n}}\n\n书记员赵某\n[[Category:覆盖版本未检查的裁判文书]]\n{{PD-PRC-exempt}}"
    wanted = HEAD + "{{gap}}第一段。\n\n{{gap}}第二段。\n\n{{gap}}第三段。\n\n{{裁判文书署名|1=\n审判长：王某\n审判员：李某\n二〇二四年一月二日\n书记员：赵某\n}}\n{{PD-PRC-exempt}}\n"
    assert B.rebuild_page(text, VALUES) == wanted
    again = B.rebuild_page(wanted, VALUES)
    assert again == wanted  # a rebuilt page stays as it is
    loose = "文书内容甲市人民法院民事判决书（2024）甲01民初1号原告诉称如下。\n审判长：王某\n2024年1月2日\n{{裁判文书署名|1=\n}}"
    assert B.rebuild_page(loose, VALUES) == HEAD + "{{gap}}原告诉称如下。\n\n{{裁判文书署名|1=\n审判长：王某\n2024年1月2日\n}}\n"
    assert B.rebuild_page(None, VALUES) == HEAD + "\n"
    with pytest.raises(ValueError):
        B.rebuild_page("{{裁判文书署名|1=\nx", VALUES)


def test_rebuild_jobs(spark):
    pages = spark.createDataFrame([("a", "正文", {"title": "a"}), ("b", None, None), ("c", "{{Header/裁判文书\n|title = c", {})], "title string, content string, values map<string,string>")
    found = {r.title: r for r in J.rebuild_pages(pages).collect()}
    assert found["a"].content.endswith("}}\n{{gap}}正文\n") and found["b"].error is None and found["c"].error == "unterminated header"
    split = J.split_intros(spark.createDataFrame([("a", "{{Header/裁判文书\n|title = a\n}}\n{{gap}}文书内容\n甲法院\n判决书\n（2024）1号\n余"), ("b", None)], "title string, content string"))
    rows = {r.title: r for r in split.collect()}
    assert (rows["a"].court, rows["a"].case_number) == ("甲法院", "（2024）1号") and rows["a"].content.endswith("|案号 = （2024）1号\n}}\n余") and rows["b"].error == "no introduction"


def test_page_sources(spark):
    answer = {"query": {"pages": [{"title": "a", "pageid": 1, "revisions": [{"slots": {"main": {"content": "x"}}}]}, {"title": "b", "missing": True}, {"title": "c", "pageid": 3, "revisions": []}, {"title": "d", "pageid": 4, "revisions": [{}]}]}}
    rows = R.page_records(spark.createDataFrame([(json.dumps(answer),), ("{}",), (None,)], "value string")).collect()
    assert [tuple(r) for r in rows] == [("a", True, 1, "x"), ("b", False, None, None), ("c", True, 3, None), ("d", True, 4, "")]
    pages = spark.createDataFrame([("z", "x\n[[Category:甲.类|k]]"), ("a", "[[分类: 甲.类 ]]"), ("Talk:a", "[[Category:甲.类]]"), ("c", "[[Category:甲x类]]"), ("d", None)], "title string, content string")
    assert [r.title for r in R.category_members(pages, "甲.类").collect()] == ["a", "z"]
    log = spark.createDataFrame([("u", ["t", "s"]), ("u", []), ("v", ["t"]), ("u", None)], "user string, tags array<string>")
    assert R.tagged_contributions(log, "u", "t").count() == 1


def test_counters_and_reports(spark):
    results = spark.createDataFrame([(s,) for s in ("uploaded", "reverted_overwrite", "failed", "skipped", "skipped", "conflict_resolved", "overwritable", None)], "status string")
    assert tuple(R.upload_counters(results).first()) == (2, 1, 2, 1, 1)
    jobs = spark.createDataFrame([(s,) for s in (None, None, "missing_page", "redirect_exists", "failed")], "r string")
    assert R.job_counters(jobs, F.col("r")).first().asDict() == {"processed": 5, "created": 2, "missing_page": 1, "missing_metadata": 0, "redirect_exists": 1, "invalid_input": 0, "failed": 1, "skipped_total": 2}
    rows, summary = R.run_report(spark.createDataFrame([("a", "merge", None), ("b", "merge", None), ("c", "split", "E")], "title string, action string, error string"))
    assert {tuple(r) for r in summary.collect()} == {("merge", "ok", 2), (None, "failed", 1)} and rows.where("title = 'c'").first().error == "E"
    titles, a, b = (spark.createDataFrame([(t,) for t in ts], "title string") for ts in ("abc", "ax", "c"))
    assert [r.title for r in R.unclassified(titles, a, b).collect()] == ["b"]
    with pytest.raises(ValueError, match="unclassified"):
        R.require_classified(titles, a, b)
    R.require_classified(titles, a, b, titles)
    assert R.throughput(spark.createDataFrame([(3, 1)], "x int, y int"), 2.0, "x", "y").first().per_second == 2.0


def test_prefixes_of_pages_compile_no_patterns(monkeypatch):
    """A page's own number in the prefix must not cost a pattern a page."""
    import re

    assert B.drop_prefix(" 甲 法院（2024） 1号：余", "甲法院(2024)1号") == "：余"
    assert B.drop_prefix("甲法院", "甲法院（") == "甲法院" and B.drop_prefix(" 甲", "") == " 甲" and B.drop_prefix("　甲", "甲") == ""
    B.rebuild_page("甲法院（2024）1号\n首段。", {"court": "甲法院", "案号": "（2024）1号"})
    made = []
    own = re._compiler.compile
    monkeypatch.setattr(re._compiler, "compile", lambda *a: made.append(a) or own(*a))
    for i in range(50):
        page = B.rebuild_page(f"甲法院(2025){i}号\n首段。", {"court": "甲法院", "案号": f"（2025）{i}号"})
        assert page.endswith("}}\n{{gap}}首段。\n")
    assert not made
