import json
import subprocess
import sys

from pyspark import cloudpickle

from jurispark.functions import html, render
from jurispark.operators import convert as C
from jurispark.sources import dumps, sinks
from jurispark.streaming.convert import convert_stream

FIELDS = "s1 string, s2 string, s7 string, s22 string, s31 string, wsKey string, qwContent string, doc_num long"


def body(*lines):
    return "".join(f'<div style="{s}">{t}</div>' for s, t in lines)


CENTRE, RIGHT, GAP = "TEXT-ALIGN: center; FONT-SIZE: 18pt;", "TEXT-ALIGN: right;", "TEXT-INDENT: 30pt;"
FULL = body((CENTRE, "北京市第一中级人民法院"), (CENTRE, "民 事 判 决 书"), (RIGHT, "(2024)京01民初1号"), (GAP, "原告张xx诉被告一案，本院受理后依法进行了审理，现已"), (GAP, "审理终结。"), ("", "-1-"), (RIGHT, "审 判 长　王某"), (RIGHT, "书记员：李某"), (RIGHT, "二〇二四年九月二十八日"), ("", "附注。"))


def raw(spark, **row):
    base = dict(s1="甲案民事判决书", s2="", s7="", s22="", s31="", wsKey="doc-1", qwContent=FULL, doc_num=1)
    return spark.createDataFrame([tuple((base | row)[c.split()[0]] for c in FIELDS.split(", "))], FIELDS)


def test_full_document(spark):
    r = C.convert(raw(spark), as_of=2026).first()
    assert r.error_stage is None
    assert (r.court, r.doc_type, r.doc_id) == ("北京市第一中级人民法院", "民事判决书", "（2024）京01民初1号")
    assert "|year = 2024\n|month = 9\n|day = 28\n|loc = 北京市\n" in r.wikitext
    assert "{{gap}}原告张{{PRC-redact|2}}诉被告一案，本院受理后依法进行了审理，现已审理终结。\n" in r.wikitext
    assert "-1-" not in r.wikitext
    assert "{{裁判文书署名|1=\n审判长：王某\n书记员：李某\n二〇二四年九月二十八日\n}}" in r.wikitext
    assert r.wikitext.endswith("附注。\n\n{{PD-PRC-exempt}}\n")


def test_fallbacks_without_header(spark):
    r = C.convert(raw(spark, s2="某市法院", s22="甲省某市法院\n民事裁定书\n(2020)甲1号", s31="2020-03-04", qwContent="<div>正文。</div>"), as_of=2026).first()
    assert (r.court, r.doc_type, r.doc_id) == ("甲省某市法院", "民事裁定书", "（2020）甲1号")
    assert "|year = 2020\n|month = 3\n|day = 4\n" in r.wikitext


def test_errors_and_nulls(spark):
    rows = raw(spark, s1="").unionByName(raw(spark, qwContent=None)).unionByName(raw(spark, s1=None))
    found = [(r.error_stage, r.error_message) for r in C.convert(rows, as_of=2026).collect()]
    assert found == [("field_extraction", "Missing title (s1 field)"), ("field_extraction", "Missing HTML content (qwContent field)"), ("field_extraction", "Missing title (s1 field)")]
    assert C.convert(rows.limit(0), as_of=2026).count() == 0


def test_limit_stops_behind_the_nth_success(spark):
    rows = raw(spark, doc_num=1).unionByName(raw(spark, s1="", doc_num=2)).unionByName(raw(spark, doc_num=3)).unionByName(raw(spark, doc_num=4))
    job = lambda **k: sorted(r.doc_num for r in C.convert_job(rows, as_of=2026, **k).collect())
    assert job(max_success=2) == [1, 2, 3]
    assert job(max_success=1) == [1]
    assert job() == [1, 2, 3, 4]
    assert job(start_from=1, max_success=1) == [2, 3]


def test_table_and_list():
    source = '<div><table class="x" onclick="y"><caption>题</caption><tr><th>a</th><td colspan="2">b|c<br>d</td></tr><tr><td><table><tr><td>e</td></tr></table></td></tr></table></div><ol><li>一<li>二</ol>'
    table, found = html.blocks(source)
    text = html.table_wikitext(table.table)
    assert text.startswith('{| class="wikitable x"\n|+ 题\n|-\n! a\n| colspan="2" |\nb|c\nd\n|-\n|\n{| class="wikitable"')
    assert text.count("{|") == text.count("|}") == 2
    assert (found.kind, found.ordered, found.items) == ("LIST", True, ["一", "二"])


def test_bodies_nested_to_any_depth():
    deep = 100_000
    found = html.blocks("<div>" * deep + "甲" + "</div>" * deep)
    assert [(b.kind, b.text) for b in found] == [("PARAGRAPH", "甲")]
    assert [b.text for b in html.blocks("<section>" * deep + "甲", descend=True)] == ["甲"]
    (table,) = html.blocks("<font>" * deep + "<table><tr><td>" + "<b>" * deep + "|甲")
    assert html.table_wikitext(table.table) == '{| class="wikitable"\n|-\n| &#124;甲\n|}'
    assert [b.text for b in html.blocks("<b>" * deep + "</i>" * deep + "</b>" * deep + "<p>甲")] == ["甲"]


def test_segments_without_header_and_short_bodies():
    doc = html.segment(html.blocks(body((GAP, "正文"), (RIGHT, "审判长　王某"))))
    assert [b.kind for b in doc.body] == ["PARAGRAPH", "SIGNATURE"] and doc.signatures == [] and doc.date is None
    assert html.blocks("") == [] and html.segment([]).body == []
    assert render.judges_and_clerks(html.blocks(body((RIGHT, "审判长　王某"), (RIGHT, "2024年1月2日"), (RIGHT, "书记员　李某"))))[1] == ["书记员　李某"]


def test_dumps(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('{"s1": "一"}\n{\n "s1": "二"\n}\n{bad\n}\n{"s1": "三"}\n{"s1": ', encoding="utf-8")
    read = lambda **k: [json.loads(r.value)["s1"] for r in dumps.read_json_objects(spark, str(path), **k).orderBy("doc_num").collect()]
    assert read() == ["一", "二", "三"]
    assert read(strict_parity=True) == ["一", "二"]
    lines = tmp_path / "b.jsonl"
    lines.write_text('﻿{"title": "a", "wikitext": "w"}\n\nnope\n[1]\n{"final_title": "c", "wenshuID": "i"}\n', encoding="utf-8")
    assert [r.valid for r in dumps.read_rows(spark, str(lines)).orderBy("line").collect()] == [True, False, True]
    assert [(r.title, r.wenshu_id) for r in dumps.read_drafts(spark, str(lines), overwrite=True).orderBy("ordinal").collect()][-1] == ("c", "i")
    assert dumps.read_valid(spark, str(lines), 1).count() == 1


def test_sinks_and_state(spark, tmp_path):
    rows = C.convert(raw(spark).unionByName(raw(spark, s1="", doc_num=2)), as_of=2026)
    out, err, state = sinks.output_paths(f"{tmp_path}/in.jsonl")
    assert err.endswith("in_converted_failed.jsonl") and state.endswith("in_converted_checkpoint.json")
    r = sinks.write_conversion(rows, out, err).first()
    assert (r.success, r.errors, r.last_doc_num) == (1, 1, 2)
    sinks.write_conversion(rows, out, err, append=True)
    assert spark.read.json(out).count() == 2 and spark.read.json(err).select("error_stage").first()[0] == "field_extraction"
    assert sinks.load_state(spark, state) is None
    sinks.save_state(spark, state, {"input": "a", "output": out, "errors": err} | sinks.add_totals({"total_success": 3}, 1, 1, 2))
    again = sinks.load_state(spark, state)
    assert again["total_success"] == 4 and sinks.same_run(again, "a", out, err) and not sinks.same_run(again, "b", out, err)
    assert sinks.report(rows).count() == 1


def test_stream_takes_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    run = lambda: convert_stream(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/err", f"{tmp_path}/state", as_of=2026).awaitTermination()
    for n in (1, 2):
        (tmp_path / "in" / f"{n}.json").write_text(json.dumps({"s1": f"标题{n}", "qwContent": "<p>正文。</p>"}, ensure_ascii=False), encoding="utf-8")
        run()
    assert sorted(r.title for r in spark.read.json(f"{tmp_path}/out").collect()) == ["标题1", "标题2"]


def test_counters_make_no_fields(spark):
    raw = spark.createDataFrame([(1, "题", "院", "号", "", "", "id", "<p>文</p>"), (2, "", "院", "号", "", "", "id", "<p>文</p>")], "doc_num long, s1 string, s2 string, s7 string, s22 string, s31 string, wsKey string, qwContent string")
    counted = C.counters(C.convert(raw, as_of=2026))
    assert "PRC-redact" not in counted._jdf.queryExecution().optimizedPlan().toString()
    assert tuple(counted.first()) == (1, 1, 2)


def test_plain_sources_need_no_parser(monkeypatch):
    plain = ['<DIV ALIGN="Right" style="">甲<p>乙<p>丙</DIV></p>丁<br><ul><li>一<li>二</ul>', "<table><tr><td>a<td>b<tr><th>c</table>", "<html><body><p>x</body>", "a<b>c</b></i>d", ""]
    other = ["a &amp; b", "<!-- x --><p>y", "<script><p></script>z", "a < b", "<p class=x>y", "<p/>x", "<p a='b'>x"]
    assert all(html._plain_tree(s) is not None for s in plain) and all(html._plain_tree(s) is None for s in other)
    trees = [html.parse(s) for s in plain]
    monkeypatch.setattr(html, "_plain_tree", lambda source: None)
    assert trees == [html.parse(s) for s in plain]
    assert subprocess.run([sys.executable, "-c", "import sys, pickle; print(len(pickle.load(sys.stdin.buffer)('<p>x</p>')))"], input=cloudpickle.dumps(html.blocks), capture_output=True, cwd="/").stdout.strip() == b"1"
