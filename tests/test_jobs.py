from pyspark.sql import functions as F

from jurispark.functions import wiki as W
from jurispark.operators import jobs as J
from jurispark.operators import relational as R
from jurispark.operators.graph import groups


def test_ordinals_and_cuts(spark):
    rows = R.with_ordinal(spark.range(0, 100, 1, 7)).orderBy("id").collect()
    assert [r.ordinal for r in rows] == list(range(1, 101))
    df = spark.range(10).withColumn("ok", F.col("id") % 2 == 0)
    assert R.first_n_successes(df, F.col("ok"), 2, "id").count() == 3
    assert [r.id for r in R.slice_eligible(df, F.col("ok"), 1, 2, "id").orderBy("id").collect()] == [2, 4]
    total = R.running_total(spark.range(10), F.col("id"), "id", block=3).orderBy("id").collect()
    assert [r.running for r in total] == [0, 0, 1, 3, 6, 10, 15, 21, 28, 36]


def test_redirect_chains_loops_and_gaps(spark):
    pages = [(f"p{i}", f"p{i + 1}") for i in range(12)] + [("p12", None), ("a", "b"), ("b", "a"), ("c", "missing")]
    found = {r.title: r.resolved for r in R.resolve_redirects(spark.createDataFrame(pages, "title string, target string")).collect()}
    assert found["p2"] == "p12" and found["p1"] is None and found["p12"] == "p12"
    assert found["a"] is None and found["c"] is None


def test_groups(spark):
    links = spark.createDataFrame([("a", "b"), ("c", "b"), ("x", "y"), ("y", "z"), ("q", "q")], "a string, b string")
    assert {r.node: r.component for r in groups(links).collect()} == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x", "z": "x", "q": "q"}


def test_first_wins_and_distinct(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), (None, 3, "c")], "k string, o int, v string")
    assert sorted((r.k or "", r.v) for r in R.first_by_key(df, ["k"], "o").collect()) == [("", "c"), ("k", "a")]
    assert spark.range(1).select(R.ordered_distinct(F.array(*map(F.lit, [" b", "a", "b ", ""])))).first()[0] == ["b", "a"]


def test_reconcile(spark):
    kind = "line long, title string, court string, doc_id string, doc_type string, wikitext string"
    old = spark.createDataFrame([(1, "张xx案", "院", "(1)", "书", "a"), (2, "乙案", "院", "(2)", "书", "a"), (3, "丙案", "院", "(3)", "书", "a")], kind)
    new = spark.createDataFrame([(1, "张××案", "院", "(1)", "书", "b"), (2, "乙案", "院", "(2)", "书", "a"), (3, "丁案", "院", "(3)", "书", "a")], kind)
    pages = spark.createDataFrame([("院（1）书", "#REDIRECT [[张xx案]]"), ("张xx案", "李xx")], "title string, content string")
    found = [(r.case, r.move_to, r.marked_text) for r in J.reconcile(old, new, pages).orderBy("position").collect()]
    assert found == [("1.1", "张××案", "李{{PRC-redact|2}}"), ("unchanged", None, None), ("redirect_page_missing", None, None)]


def test_versions_jobs(spark):
    legacy = "{{versions\n | title = t\n | notes = {{x}}\n}}\n* [[a]]\n[[Category:2024年民事判决书]]\n[[Category:民事判决书]]\n[[Category:甲法院]]\n"
    listed = "{{裁判文书消歧义页\n | title      = {}\n | court      = 甲法院\n | type       = 民事判决书\n}}\n* [[甲法院（2024）{}号民事判决书]]\n"
    at = lambda t, n: listed.replace("{}", t, 1).replace("{}", n, 1)
    pages = spark.createDataFrame([("l", legacy), ("张xx", at("张xx", "2")), ("张××", at("张××", "1")), ("李**", at("李**", "3"))], "title string, content string")
    assert J.convert_versions(pages).collect()[0].content == "{{裁判文书消歧义页\n | title      = t\n | court      = 甲法院\n | type       = 民事判决书\n | year       = 2024\n}}\n* [[a]]\n"
    found = {r.title: r for r in J.merge_versions(pages).collect()}
    assert found["李**"].outcome == "moved" and found["张xx"].outcome == "merged" and found["张xx"].page_text.count("* [[") == 2


def test_diff_and_cleaning(spark):
    df = spark.createDataFrame([("k", "a\nb", "a\nc"), ("l", "a", "a\n")], "k string, x string, y string")
    found = {r.k: r.diff for r in J.unified_diff(df, "x", "y", "k").collect()}
    assert found["l"] == "" and "-b\n+c" in found["k"]
    assert J.strip_invisible(spark.createDataFrame([("t", "a​b"), ("u", "ab")], "title string, content string")).collect()[0].fixed == "ab"


def test_titles_and_edits(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    title = F.lit("甲法院（2024）1号 民事判决书")
    assert one(W.court_of_title(title)) == "甲法院" and one(W.type_of_title(title)) == "民事判决书" and one(W.court_of_title(F.lit("x"))) is None
    assert one(W.redact_selection(F.lit("😀a"))) == "{{PRC-redact|2|os=yes}}"
    assert one(W.page_url(F.lit("a b/c:d*~（"), "w/")) == "w/a_b/c:d%2A~%EF%BC%88"
    assert one(W.alternate_title(F.lit("张某"), F.lit("张三"))) == "{{另|张三|张某}}" and one(W.alternate_title(F.lit("a"), F.lit("a"))) == "a"
    assert "* [[甲法院（2024）1号判决书]]" in one(W.redirect_to_list(F.lit("#REDIRECT [[甲法院（2024）1号判决书]]"), F.lit("t")))


def test_rescue_and_inference(spark):
    page = lambda d: "{{Header/裁判文书\n|docid = %s\n}}\n" % d
    rows = [("t", 1, 0, "Imported from 裁判文书网", page("a")), ("t", 2, 1, "Imported from 裁判文书网", page("b")), ("t", 3, 2, "Imported from 裁判文书网", page("b")), ("t", 4, 3, "edit", page("c"))]
    found = J.rescued_drafts(spark.createDataFrame(rows, "title string, revid long, parentid long, comment string, text string")).collect()
    assert [(r.ordinal, r.wenshu_id) for r in found] == [(2, "b")]
    text = "{{x}}北京市第一中级人民法院\n民事判决书\n（2024）京01民初1号\n正文。\n二〇二四年九月二十八日"
    r = J.infer_from_text(spark.createDataFrame([("t", text)], "title string, content string")).first()
    assert (r.court, r.doc_type, r.case_number, r.date.month, r.place) == ("北京市第一中级人民法院", "民事判决书", "（2024）京01民初1号", "9", "北京市")
