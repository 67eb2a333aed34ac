import pytest
from pyspark.sql import functions as F

from jurispark.functions import metadata as M
from jurispark.functions import plain
from jurispark.functions import text as T
from jurispark.functions import wiki as W

CASES = [
    (T.mark_redactions, "张三xx李四", "张三{{PRC-redact|2}}李四"),
    (T.mark_redactions, "3×123", "3×123"),
    (T.mark_redactions, "1×号", "1{{PRC-redact|1}}号"),
    (T.mark_redactions, "textXword", "textXword"),
    (T.mark_redactions, "textXXword", "text{{PRC-redact|2}}word"),
    (T.mark_redactions, "{{PRC-redact|2}}*123", "{{PRC-redact|3}}123"),
    (T.mark_redactions, None, None),
    (T.mark_title_redactions, "张三Xｘ*执行裁定书", "张三×××执行裁定书"),
    (T.drop_cjk_spaces, "在本案执 行过程中", "在本案执行过程中"),
    (T.drop_cjk_spaces, "（ 2024 ）", "（ 2024 ）"),
    (T.clean, "张三‎李四​", "张三李四"),
    (T.clean, None, ""),
    (T.clean, "a\t\n b　", "a b"),
    (T.is_date_line, "…二〇二四年九月二十八日", True),
    (T.is_signature_line, "审 判 员　：杨清", True),
    (T.is_signature_line, "代理审判员　李某", True),
    (T.is_signature_line, "原告", False),
    (T.is_junk_line, "-12-", True),
    (T.is_junk_line, "第 3 页", True),
    (T.is_junk_line, "3元", False),
    (T.tighten_products, "3 × 5", "3×5"),
    (T.canonical_redactions, "a{{PRC-redact|2}}××{{PRC-redact|1}}b", "a{{PRC-redact|5}}b"),
    (T.merge_redactions, "*{{PRC-redact|1}}x", "{{PRC-redact|3}}"),
    (T.templates_to_crosses, "a{{PRC-redact|3}}b", "a×××b"),
    (T.hide_redactions, "a{{PRC-redact|2}}x", "a"),
    (T.same_lines, "a\r\nb\r \n", "a\nb"),
    (T.truncate, "x" * 301, "x" * 299 + "…"),
    (M.court_name, "  12.【x】北京市第一中级人民法院", "北京市第一中级人民法院"),
    (M.court_name, "四川省绵阳市中级人民法院赔偿委员会", "四川省绵阳市中级人民法院赔偿委员会"),
    (lambda c: M.court_name(c, committee=False), "四川省绵阳市中级人民法院赔偿委员会", "四川省绵阳市中级人民法院"),
    (M.court_name, "某某仲裁委", ""),
    (M.case_number, "案号：(2024)京01执123号之一附件", "（2024）京01执123号之一"),
    (M.doc_type, "No. 执 行 裁 定 书 123", "执行裁定书"),
    (M.doc_type, "其他", "其他"),
    (M.doc_type_of_title, "张三民事判决书", "民事判决书"),
    (M.location, "鄂托克前旗人民法院", "内蒙古自治区"),
    (M.location, "江西省南昌市红谷滩区人民法院", "江西省南昌市"),
    (M.location, "杭州市西湖区人民法院", "浙江省杭州"),
    (M.location, "", None),
    (lambda c: M.date_of_text(c)["day"], "二〇二四年九月二十八日", "28"),
    (lambda c: M.date_of_text(c)["month"], "2024年09月28日", "09"),
    (lambda c: M.date_of_iso(c, 2026)["month"], "2024-09-30", "9"),
    (lambda c: M.date_of_iso(c, 2026)["year"], "1948-12-31", None),
    (lambda c: M.year_of_case_number(c, 2026), "(2024)京1号", "2024"),
    (lambda c: T.glob_filter(c, "*判决书; ?x[!a-c]*"), "民事判决书", True),
    (lambda c: T.glob_filter(c, "?x[!a-c]*"), "1xb", False),
    (lambda c: T.glob_filter(c, " ; "), "x", False),
    (lambda c: T.remove_once(c, F.lit("b")), "abcb", "acb"),
    (W.redirect_target, "x\n#redirect [[ 目标 ]]", "目标"),
    (W.page_kind, "{{Versions\n}}", "versions"),
    (W.shown_title, "[[a|b]]", "b"),
    (W.link_title, "{{x\n|title = 甲\n}}", "{{x\n|title = [[甲]]\n}}"),
    (W.has_official_redaction, "{{PRC-redact|2|os=yes}}", True),
    (lambda c: W.header(c)["a"], "{{Header/裁判文书\n|a = 1\n|b\n|a = 2\n}}", "2"),
    (lambda c: W.header(c)["a"], "{{Header/裁判文书\n|a = 1", None),
    (lambda c: F.array_join(W.sort_entries(F.split(c, ",")), ","), "京10123号,京2106号,京2106号之一,京9号", "京9号,京2106号,京2106号之一,京10123号"),
    (lambda c: W.year_and_type(c)["year"], "[[Category:2024年民事判决书]]\n[[Category:民事判决书]]", "2024"),
    (W.structure_penalty, "{{裁判文书署名|1=\n}}", 12),
    (W.redaction_penalty, "x{{PRC-redact|2}}", 4),
]


@pytest.mark.parametrize("f,value,wanted", CASES)
def test_case(spark, f, value, wanted):
    assert spark.createDataFrame([(value,)], "c string").select(f(F.col("c"))).first()[0] == wanted


@pytest.mark.parametrize("native,single", [(T.clean, plain.clean), (T.mark_redactions, plain.mark_redactions), (T.canonical_redactions, plain.canonical_redactions), (T.is_junk_line, plain.is_junk), (M.case_number, plain.case_number), (M.doc_type, plain.doc_type), (lambda c: M.court_name(c, committee=False), plain.court_name)])
def test_both_forms_agree(spark, native, single):
    values = ["", "张xx诉李**，×3", "（2024）京01民初1号之二", "北京 市 法院 判决书", "-1-", "a  b​{{PRC-redact|1}}x", "AXB aXXb ×.5"]
    rows = spark.createDataFrame([(v,) for v in values], "c string").select("c", native(F.col("c")).alias("r")).collect()
    assert {r.c: r.r for r in rows} == {v: single(v) for v in values}


def test_trimming_is_no_pattern(spark):
    """Ends are trimmed by a list of characters, the same as the class; a pattern went through the whole text for each end."""
    import re

    from jurispark.functions import chars

    assert {chr(c) for c in range(0x10000) if re.match(f"[{chars.SPACE}]", chr(c))} == set(chars.SPACES)
    x = F.col("x")
    assert "regexp" not in str(T.strip(x)).lower() and "regexp" not in str(T.rstrip(x)).lower()
    row = spark.createDataFrame([("\u3000\x1c a\u3000b \x85\n",)], "x string").select(T.strip(x).alias("s"), T.rstrip(x).alias("r")).first()
    assert (row.s, row.r) == ("a\u3000b", "\u3000\x1c a\u3000b")
