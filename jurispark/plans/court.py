"""Queries on court rows that are derived from orders, customers and nations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jurispark.functions import metadata as M
from jurispark.functions import text as T
from jurispark.operators import convert as C
from jurispark.operators import relational as R
from jurispark.plans.registry import parts, query, table

AS_OF = 2026

#: Raw court rows; the same SQL in Spark and DuckDB.
RAW = """
SELECT o_orderkey AS doc_num, 'doc-' || CAST(o_orderkey AS STRING) AS wsKey, s2, kind, s7,
  CASE WHEN o_orderkey % 97 = 0 THEN '' WHEN o_orderkey % 4 = 0 THEN '李xx与王**' || kind WHEN o_orderkey % 4 = 1 THEN '张三•李四一案' || kind ELSE c_name || '与' || n_name || kind END AS s1,
  CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 11 = 1 THEN s2 || chr(10) || s7 ELSE s2 || chr(10) || kind || chr(10) || s7 END AS s22,
  CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 3 = 1 THEN '1948-01-02' ELSE day END AS s31,
  CASE WHEN o_orderkey % 89 = 0 THEN '' ELSE
    '<div style="TEXT-ALIGN: center; FONT-SIZE: 18pt;">' || CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE s2 END || '</div>'
    || '<div style="TEXT-ALIGN: center; FONT-SIZE: 18pt;">' || CASE WHEN o_orderkey % 6 = 1 THEN '' ELSE kind END || '</div>'
    || '<div style="TEXT-ALIGN: right;">' || CASE WHEN o_orderkey % 6 = 2 THEN '' ELSE s7 END || '</div>'
    || '<div style="TEXT-INDENT: 30pt;">原告' || c_name || '，与被告xx公司合同纠纷一案，本院受理后依法进行了审理</div><div style="TEXT-INDENT: 30pt;">现已审理终结。</div><div>-' || CAST(o_orderkey % 9 AS STRING) || '-</div>'
    || '<table><tr><th>项</th><td colspan="2">' || CAST(o_totalprice AS STRING) || '</td></tr></table>'
    || '<div style="TEXT-ALIGN: right;">审 判 长　王某</div><div style="TEXT-ALIGN: right;">书记员：李某</div><div style="TEXT-ALIGN: right;">' || CASE WHEN o_orderkey % 5 = 3 THEN '' ELSE CAST(year AS STRING) || '年3月8日' END || '</div>' END AS qwContent
FROM (SELECT *, CASE WHEN o_orderkey % 5 = 0 THEN '(' || CAST(year AS STRING) || ')京01民初' || CAST(o_orderkey AS STRING) || '号'
      WHEN o_orderkey % 5 = 1 THEN '案号：（' || CAST(year AS STRING) || '）京01民初' || CAST(o_orderkey AS STRING) || '号之一附件' WHEN o_orderkey % 5 = 2 THEN '' ELSE '（' || CAST(year AS STRING) || '）京01民初' || CAST(o_orderkey AS STRING) || '号' END AS s7
  FROM (SELECT o_orderkey, o_totalprice, c_name, n_name, CAST(year(o_orderdate) AS INT) AS year, CAST(CAST(o_orderdate AS DATE) AS STRING) AS day,
      CASE o_orderpriority WHEN '1-URGENT' THEN '民事判决书' WHEN '2-HIGH' THEN '执行裁定书' WHEN '3-MEDIUM' THEN '刑事判决书' WHEN '4-NOT SPECIFIED' THEN '行政裁定书' ELSE '决定书' END AS kind,
      CASE o_orderkey % 7 WHEN 0 THEN '北京市第一中级人民法院' WHEN 1 THEN '12.【x】江西省南昌市红谷滩区人民法院' WHEN 2 THEN '四川省绵阳市中级人民法院赔偿委员会' WHEN 3 THEN '杭州市西湖区人民法院（执行局）' WHEN 4 THEN '鄂托克前旗人民法院' WHEN 5 THEN '某某仲裁委' ELSE '上海市浦东新区 人民法院' END AS s2
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey))
"""
_JOINED = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
#: Character classes and steps that the DuckDB texts share.
_COURT = "regexp_extract(regexp_replace(regexp_replace({0}, '\\s+', '', 'g'), '^[^\\x{{4e00}}-\\x{{9fff}}]+', ''), '^(.*法院([\\x{{4e00}}-\\x{{9fff}}]{{1,12}}委员会)?)', 1)"
_NUMBER = "regexp_extract(replace(replace(regexp_replace({0}, '\\s+', '', 'g'), '(', '（'), ')', '）'), '（.*?号(?:之[一二三四五六七八九十百千万〇零]+)?', 0)"


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are the large side; customers join by key, and nations, a fixed 25 rows, are small enough to send. What is made
    of the joined rows is costly, so that these are dealt out behind the join, whose own parts follow the settings."""
    tables = {n: table(spark, sf_dir, n) for n in ("orders", "customer", "nation")}
    joined = spark.sql(f"SELECT o_orderkey, o_totalprice, o_orderdate, o_orderpriority, c_name, n_name FROM {_JOINED.replace('orders', '{orders}').replace(' customer', ' {customer}').replace(' nation', ' {nation}')}", **tables)
    return spark.sql(RAW.replace(_JOINED, "{joined}"), joined=joined.repartition(parts(tables["orders"]), "o_orderkey"))


@query("title_glob_filter", f"WITH raw AS ({RAW}) SELECT doc_num, s1 FROM raw WHERE regexp_matches(s1, '^(.*民事判决书|李.x.*裁定书)$')")
def title_glob_filter(spark, sf_dir):
    return raw(spark, sf_dir).where(T.glob_filter(F.col("s1"), "*民事判决书; 李?x*裁定书")).select("doc_num", "s1")


@query("court_normalize", f"WITH raw AS ({RAW}) SELECT doc_num, {_COURT.format('s2')} AS court FROM raw")
def court_normalize(spark, sf_dir):
    return raw(spark, sf_dir).select("doc_num", M.court_name(F.col("s2")).alias("court"))


@query("case_number_extract", f"WITH raw AS ({RAW}) SELECT doc_num, {_NUMBER.format('s7')} AS case_number, {_NUMBER.format('s22')} AS from_hierarchy FROM raw")
def case_number_extract(spark, sf_dir):
    return raw(spark, sf_dir).select("doc_num", M.case_number(F.col("s7")).alias("case_number"), M.case_number(F.col("s22")).alias("from_hierarchy"))


@query("doc_type_extract", f"""WITH raw AS ({RAW}) SELECT doc_num,
  CASE WHEN s1 = '' THEN '' WHEN kind = '决定书' THEN '决定书' ELSE kind END AS from_title,
  CASE WHEN doc_num % 11 = 0 THEN '' WHEN doc_num % 7 = 3 AND doc_num % 5 <> 2 THEN CASE WHEN doc_num % 5 = 1 THEN '附件' ELSE '' END
    ELSE (CASE WHEN doc_num % 7 = 3 THEN '执行局' WHEN doc_num % 7 = 5 THEN '某某仲裁委' ELSE '' END) || CASE WHEN doc_num % 11 <> 1 THEN kind WHEN doc_num % 5 = 1 THEN '案号附件' ELSE '' END END AS from_hierarchy FROM raw""")  # fmt: skip
def doc_type_extract(spark, sf_dir):
    return raw(spark, sf_dir).select("doc_num", M.doc_type_of_title(F.col("s1")).alias("from_title"), M.doc_type_of_hierarchy(F.col("s22"), F.col("s2"), F.col("s7")).alias("from_hierarchy"))


@query("case_title", f"""WITH raw AS ({RAW}), parts AS (SELECT doc_num, regexp_extract({_COURT.format('s2')}, '^(.*法院)', 1) AS court, {_NUMBER.format('s7')} AS number, kind FROM raw)
  SELECT doc_num, CASE WHEN court <> '' AND number <> '' AND kind <> '' THEN court || number || kind END AS case_title FROM parts""")
def case_title(spark, sf_dir):
    return raw(spark, sf_dir).select("doc_num", M.case_title(F.col("s2"), F.col("s7"), F.col("kind")).alias("case_title"))




@query("date_fallback", f"""WITH raw AS ({RAW}), p AS (SELECT doc_num, s31, {_NUMBER.format('s7')} AS number, regexp_extract(qwContent, '(\\d{{4}})年3月8日', 1) AS shown FROM raw)
  SELECT doc_num, CASE WHEN shown <> '' THEN shown WHEN doc_num % 3 = 2 THEN substr(s31, 1, 4) WHEN number <> '' THEN substr(number, 2, 4) END AS year,
    CASE WHEN shown <> '' THEN '3' WHEN doc_num % 3 = 2 THEN CAST(CAST(substr(s31, 6, 2) AS INT) AS VARCHAR) END AS month,
    CASE WHEN shown <> '' THEN '8' WHEN doc_num % 3 = 2 THEN CAST(CAST(substr(s31, 9, 2) AS INT) AS VARCHAR) END AS day FROM p""")
def date_fallback(spark, sf_dir):
    """The date that the body is signed with, else that of the row, else the year of the case number."""
    rows = C.parse_bodies(raw(spark, sf_dir).select("doc_num", "s7", "s31", "qwContent"))
    date = M.resolve_date(M.date_of_text(F.col("found_date")), M.date_of_iso(F.col("s31"), AS_OF), M.case_number(F.col("s7")), AS_OF)
    return rows.select("doc_num", date["year"].alias("year"), date["month"].alias("month"), date["day"].alias("day"))


@query("location_infer", f"WITH raw AS ({RAW}) SELECT doc_num, CASE doc_num % 7 WHEN 0 THEN '北京市' WHEN 1 THEN '江西省南昌市' WHEN 2 THEN '四川省绵阳市' WHEN 3 THEN '浙江省杭州' WHEN 4 THEN '内蒙古自治区' WHEN 6 THEN '上海市' END AS place FROM raw")
def location_infer(spark, sf_dir):
    return raw(spark, sf_dir).select("doc_num", M.location(M.court_name(F.col("s2"))).alias("place"))


@query("title_redaction", f"WITH raw AS ({RAW}) SELECT doc_num, replace(replace(replace(s1, 'xx', '××'), '**', '××'), '•', '·') AS title FROM raw")
def title_redaction(spark, sf_dir):
    return raw(spark, sf_dir).select("doc_num", T.clean_title(F.col("s1")).alias("title"))


@query("cjk_space_clean", f"WITH raw AS ({RAW}) SELECT doc_num, replace(s2, '区 人', '区人') AS court, replace(replace(qwContent, '审 判 长', '审判长'), '区 人', '区人') AS body FROM raw")
def cjk_space_clean(spark, sf_dir):
    return raw(spark, sf_dir).select("doc_num", T.drop_cjk_spaces(F.col("s2")).alias("court"), T.drop_cjk_spaces(F.col("qwContent")).alias("body"))


_ROUTE = f"""WITH raw AS ({RAW}), t AS (SELECT *, replace(replace(replace(s1, 'xx', '××'), '**', '××'), '•', '·') AS title,
    regexp_extract(CASE WHEN regexp_matches(s22, '法院') THEN {_COURT.format("regexp_replace(s22, '[ ]', '', 'g')")} ELSE {_COURT.format('s2')} END, '^.*$', 0) AS court,
    CASE WHEN {_NUMBER.format('s7')} <> '' THEN {_NUMBER.format('s7')} ELSE {_NUMBER.format('s22')} END AS number FROM raw)
  SELECT doc_num, CASE WHEN s1 = '' OR qwContent = '' THEN 'error' ELSE 'success' END AS route,
    CASE WHEN s1 = '' THEN 'Missing title (s1 field)' WHEN qwContent = '' THEN 'Missing HTML content (qwContent field)' END AS error_message, title, court, number AS case_number,
    CASE WHEN doc_num % 3 = 2 THEN substr(s31, 1, 4) WHEN number <> '' THEN substr(number, 2, 4) END AS year,
    CASE doc_num % 7 WHEN 0 THEN '北京市' WHEN 1 THEN '江西省南昌市' WHEN 2 THEN '四川省绵阳市' WHEN 3 THEN '浙江省杭州' WHEN 4 THEN '内蒙古自治区' WHEN 6 THEN '上海市' END AS place FROM t"""


@query("convert_route", _ROUTE)
def convert_route(spark, sf_dir):
    """The flagship: metadata from the row's own fields, and the route; one scan, no Python."""
    none = F.lit(None).cast("string")
    rows = C.extract_fields(raw(spark, sf_dir)).withColumns({"found_court": none, "found_type": none, "found_number": none, "found_date": none})
    rows = C.resolve_metadata(rows, as_of=AS_OF)
    message = F.when(F.col("title") == "", "Missing title (s1 field)").when(F.col("qwContent") == "", "Missing HTML content (qwContent field)")
    return rows.select("doc_num", F.when(message.isNull(), "success").otherwise("error").alias("route"), message.alias("error_message"), "title", "court", F.col("doc_id").alias("case_number"), F.col("date.year").alias("year"), "place")


@query("convert_documents")
def convert_documents(spark, sf_dir):
    """The whole convert job with bodies."""
    return C.convert(raw(spark, sf_dir), as_of=AS_OF).select("doc_num", "error_stage", "error_message", *C.RESULT)


@query("convert_counters", f"WITH raw AS ({RAW}) SELECT count(*) FILTER (s1 <> '' AND qwContent <> '') AS success, count(*) FILTER (s1 = '' OR qwContent = '') AS errors, max(doc_num) AS last_doc_num FROM raw")
def convert_counters(spark, sf_dir):
    return C.counters(C.convert(raw(spark, sf_dir), as_of=AS_OF))


@query("first_n_success", f"WITH raw AS ({RAW}), r AS (SELECT doc_num, s1 <> '' AND qwContent <> '' AS ok, coalesce(sum(CASE WHEN s1 <> '' AND qwContent <> '' THEN 1 ELSE 0 END) OVER (ORDER BY doc_num ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM raw) SELECT doc_num, ok FROM r WHERE before < 500")
def first_n_success(spark, sf_dir):
    """The operator is a limit: the first 500 successes in order."""
    rows = raw(spark, sf_dir).select("doc_num", ((F.col("s1") != "") & (F.col("qwContent") != "")).alias("ok"))
    return R.first_n_successes(rows, F.col("ok"), 500, "doc_num")


@query("resume_slice", f"WITH raw AS ({RAW}) SELECT doc_num, wsKey FROM raw WHERE doc_num > 1000")
def resume_slice(spark, sf_dir):
    return R.resume_after(raw(spark, sf_dir), 1000, "doc_num").select("doc_num", "wsKey")
