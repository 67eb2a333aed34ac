"""Queries on single rules: texts, lines, headers and lists that are put together from pieces chosen by each order's key.

The pieces are the same SQL in Spark and DuckDB; DuckDB then works the rules out with its own string functions, or from the
parts that a text was made of.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jurispark.functions import text as T
from jurispark.functions import wiki as W
from jurispark.functions.chars import MARKERS
from jurispark.operators import convert as C
from jurispark.operators import reports as P
from jurispark.operators import relational as R
from jurispark.operators import revisions as V
from jurispark.operators.planner import IMPORT_SUMMARY, REVERT_SUMMARY
from jurispark.plans.court import AS_OF
from jurispark.plans.registry import query, table
from jurispark.plans.wiki import marked_sql
from jurispark.sources import sinks


def _pick(pieces: list[str], number: str) -> str:
    """The piece with a number, in either SQL."""
    joined = "¦".join(pieces).replace("'", "''")
    return f"split_part('{joined}', '¦', CAST(({number}) % {len(pieces)} AS INT) + 1)"


def _made(spark, sf_dir, sql: str) -> DataFrame:
    sql = sql.replace("{", "{{").replace("}", "}}")
    return spark.sql(sql.replace("FROM orders", "FROM {orders}"), orders=table(spark, sf_dir, "orders", "o_orderkey"))


PIECES = ["张三", "xx", "**", " ", "　", "{{PRC-redact|1}}", "{{PRC-redact|2}}", "{{PRC-redact|3}}", "(2024)", "3 × 4", "米 ×（", "某×X", "...", "A​", "﻿李", "⏎", "␍⏎", "a b", "×", "·", "3×4× 5", "Tax X"]
_X = " || ".join(_pick(PIECES, f"o_orderkey * {a} + floor(o_orderkey / {b})") for a, b in ((7, 5), (3, 11), (13, 2), (1, 1), (5, 17)))
TEXTS = f"SELECT o_orderkey AS k, replace(replace(x, '⏎', chr(10)), '␍', chr(13)) AS x FROM (SELECT o_orderkey, {_X} AS x FROM orders)"
_WS = r"[ \t\n\r\x{3000}]"


def _nested(text: str, pairs) -> str:
    for a, b in pairs:
        text = f"replace({text}, '{a}', '{b}')"
    return text


_T = "{{{{PRC-redact|{}}}}}".format
_TWO = [(_T(a) + _T(b), _T(a + b)) for a in range(1, 13) for b in range(1, 7)]
_COLLAPSED = _nested("x", _TWO * 3)
_CROSSES = _nested("x", [(_T(n), "×" * n) for n in (1, 2, 3)])
_HIDDEN = _nested("x", [(_T(n), "" * n) for n in (1, 2, 3)])


@query("text_rules", rf"""SELECT k,
  regexp_replace(x, '{_WS}+', '', 'g') AS compacted,
  regexp_replace(x, '[\x{{200b}}\x{{feff}}]', '', 'g') AS visible,
  regexp_replace(regexp_replace(x, '([0-9０-９%％）)元平方米])(?:{_WS}+×{_WS}*|×{_WS}+)([0-9０-９（(])', '\1×\2', 'g'), '([0-9０-９%％）)元平方米])(?:{_WS}+×{_WS}*|×{_WS}+)([0-9０-９（(])', '\1×\2', 'g') AS products,
  replace(replace(x, '(', '（'), ')', '）') AS wide,
  regexp_replace(regexp_replace(regexp_replace(x, '^{_WS}+|{_WS}+$', '', 'g'), '^[.…．·・、。]+', ''), '^{_WS}+|{_WS}+$', '', 'g') AS undotted,
  regexp_replace(replace(x, chr(13) || chr(10), chr(10)), '{_WS}+$', '') AS lines,
  CASE WHEN strpos(x, '张三') > 0 THEN left(x, strpos(x, '张三') - 1) || substr(x, strpos(x, '张三') + 2) ELSE x END AS without_name,
  {_CROSSES} AS crosses,
  translate({_HIDDEN}, '{MARKERS}', '{chr(0xE000) * len(MARKERS)}') AS hidden,
  {_COLLAPSED} AS collapsed,
  CAST(coalesce(list_sum(list_transform(regexp_extract_all(x, '\{{\{{PRC-redact\|(\d+)\}}\}}', 1), lambda v: v::BIGINT)), 0) AS BIGINT) AS templates,
  len(regexp_extract_all(regexp_replace(x, '\{{\{{PRC-redact\|\d+\}}\}}', '', 'g'), '[某×Xx]')) + 3 * len(regexp_extract_all(x, 'PRC-redact')) AS score,
  CASE WHEN length(x) > 10 THEN left(x, 9) || '…' ELSE x END AS cut,
  CASE WHEN k % 3 = 0 THEN 'more' ELSE x || '; more' END AS message,
  CASE WHEN regexp_replace(x, '{_WS}+', '', 'g') <> '' THEN regexp_replace(x, '^{_WS}+|{_WS}+$', '', 'g') ELSE 'else' END AS filled
  FROM ({TEXTS})""")
def text_rules(spark, sf_dir):
    x = F.col("x")
    message = F.when(F.col("k") % 3 == 0, F.when(F.col("k") % 2 == 0, "")).otherwise(x)
    return _made(spark, sf_dir, TEXTS).select(
        "k", T.compact(x).alias("compacted"), T.drop_invisible(x).alias("visible"), T.tighten_products(x).alias("products"), T.wide_parentheses(x).alias("wide"),
        T.drop_leading_dots(x).alias("undotted"), T.same_lines(x).alias("lines"), T.remove_once(x, F.lit("张三")).alias("without_name"), T.templates_to_crosses(x).alias("crosses"),
        T.hide_redactions(x).alias("hidden"), T.collapse_templates(x).alias("collapsed"), T.template_sum(x).alias("templates"), T.title_score(x).cast("long").alias("score"),
        T.truncate(x, 10).alias("cut"), T.append_message(message, "more").alias("message"), T.first_filled(F.when(F.col("k") % 2 == 0, "  "), x, F.lit("else")).alias("filled"),
    )


_PLAIN_PIECES = [p for p in PIECES if "PRC" not in p] + ["x", "a×", "×.", "甲x", "X乙", "＊", "bX", "Xb", "某某"]
_PLAIN = " || ".join(_pick(_PLAIN_PIECES, f"o_orderkey * {a} + floor(o_orderkey / {b})") for a, b in ((7, 5), (3, 11), (13, 2), (1, 1), (5, 17)))
PLAIN = f"SELECT o_orderkey AS k, replace(replace(x, '⏎', chr(10)), '␍', chr(13)) AS x FROM (SELECT o_orderkey, {_PLAIN} AS x FROM orders)"


@query("redaction_marks", f"""SELECT k, m AS marked, list_sum(list_transform(regexp_extract_all(m, 'PRC-redact\\|(\\d+)', 1), lambda v: v::BIGINT)) AS hidden,
  CAST(len(regexp_extract_all(m, 'PRC-redact')) AS BIGINT) AS runs FROM (SELECT k, {marked_sql('x')} AS m FROM ({PLAIN}))""")
def redaction_marks(spark, sf_dir):
    marked = _made(spark, sf_dir, PLAIN).select("k", T.mark_redactions(F.col("x")).alias("marked"), F.size(T.masked_runs(F.col("x"))).cast("long").alias("runs"))
    return marked.select("k", "marked", F.nullif(T.template_sum(F.col("marked")), F.lit(0)).alias("hidden"), "runs")


LINES = ["二〇二四年九月二十八日", "2024年9月28日", "...2024年12月8日", "2024年9月", "审 判 长　王某", "代理审判员李某", "书记员：赵某", "· 人民陪审员 钱某", "校对责任人 孙某", "法官", "原告：张某", "- 12 -", "-12-", "－7", "第 3 页", "第3页共5页", "?", "？", "", "  ", "12", "３", "本院认为", "（二〇二四）"]
LINE = f"SELECT o_orderkey AS k, {_pick([''], '0')} || {_pick(['', ' ', '　', '.'], 'floor(o_orderkey / 24)')} || {_pick(LINES, 'o_orderkey')} || {_pick(['', ' ', 'x'], 'floor(o_orderkey / 7)')} AS x FROM orders"
_BARE = r"regexp_replace(regexp_replace(regexp_replace(x, '^[ \x{3000}]+|[ \x{3000}]+$', '', 'g'), '^[.…．·・、。]+', ''), '^[ \x{3000}]+|[ \x{3000}]+$', '', 'g')"
_SIGNING = "|".join(r"[ \x{3000}]*".join(r) for r in ("审判长", "审判员", "人民陪审员", "书记员", "法官助理", "执行员", "校对人", "校对责任人", "打印人", "打印责任人"))


@query("line_kinds", rf"""SELECT k, x, regexp_full_match(bare, '[〇零一二三四五六七八九]+年[一二三四五六七八九十]+月[一二三四五六七八九十]+日|\d{{4}}年\d{{1,2}}月\d{{1,2}}日') AS is_date,
  regexp_matches(bare, '^(代[ \x{{3000}}]*理[ \x{{3000}}]*)?({_SIGNING})') AS is_signature,
  regexp_full_match(regexp_replace(x, '^[ \x{{3000}}]+|[ \x{{3000}}]+$', '', 'g'), '[-\x{{2010}}-\x{{2015}}－]?[\d０-９]+[-\x{{2010}}-\x{{2015}}－]?|\?|第[ \x{{3000}}]*[\d０-９]+[ \x{{3000}}]*页') AS is_junk
  FROM (SELECT k, x, {_BARE} AS bare FROM ({LINE}))""")
def line_kinds(spark, sf_dir):
    x = F.col("x")
    return _made(spark, sf_dir, LINE).select("k", "x", T.is_date_line(x).alias("is_date"), T.is_signature_line(x).alias("is_signature"), T.is_junk_line(x).alias("is_junk"))


#: Pages by their parts: the template's first line, title, court, type, number, and what follows.
PARTS = f"""SELECT o_orderkey AS k, {_pick(['{{Header/裁判文书', '{{header/裁判文书', '  {{HEADER/裁判文书 ', '{{Header', '{{裁判文书消歧义页', '{{versions'], 'o_orderkey')} AS open,
  {_pick(['甲案', '[[甲案]]', '[[甲案|乙案]]', '甲××案', ''], 'floor(o_orderkey / 2)')} AS title, {_pick(['北京市第一中级人民法院', '  12.乙县人民法院（执行局）', '某委员会', ''], 'floor(o_orderkey / 3)')} AS court,
  {_pick(['民事判决书', ' 执行 裁定书x', '令', ''], 'floor(o_orderkey / 5)')} AS kind, {_pick(['（2024）京01民初1号', '(2023)京02执7号之一', '2024', ''], 'floor(o_orderkey / 7)')} AS number,
  {_pick(['}}', '  }}', ''], 'floor(o_orderkey / 11)')} AS close,
  {_pick(['正文', '甲{{PRC-redact|1|os=yes}}', '[[乙]]和[[Category:丙]][[丁|戊]]', '[[Category:覆盖版本未检查的裁判文书]]', '[[ 分类 : 覆盖版本未检查的裁判文书|x]]余'], 'floor(o_orderkey / 13)')} AS body FROM orders"""
PAGES = f"SELECT *, open || chr(10) || '|title = ' || title || chr(10) || ' | court=old' || chr(10) || '|court = ' || court || chr(10) || '|type = ' || kind || chr(10) || '| 案号= ' || number || chr(10) || close || chr(10) || body || chr(10) AS text FROM ({PARTS})"
_DOC = "(lower(trim(open)) = '{{header/裁判文书' AND trim(close) = '}}')"
_COURT = "CASE WHEN court LIKE '北京%' THEN court WHEN court LIKE '%乙县%' THEN '乙县人民法院' ELSE '' END"
_KIND = "CASE trim(kind) WHEN '民事判决书' THEN '民事判决书' WHEN '执行 裁定书x' THEN '执行裁定书' ELSE kind END"
_NUMBER = "CASE WHEN number LIKE '%号%' THEN replace(replace(number, '(', '（'), ')', '）') ELSE '' END"


@query("page_rules", f"""SELECT k, CASE WHEN {_DOC} AND c <> '' AND t <> '' AND n <> '' THEN 'header' WHEN open LIKE '%消歧义页' OR open LIKE '%versions' THEN 'versions' ELSE 'other' END AS kind,
  CASE WHEN {_DOC} AND c <> '' AND t <> '' AND n <> '' THEN c || n || t END AS case_title, CASE WHEN {_DOC} AND n <> '' THEN n END AS case_number,
  CASE WHEN {_DOC} AND c <> '' THEN c END AS court, CASE WHEN {_DOC} AND t <> '' THEN t END AS doc_type,
  CASE WHEN {_DOC} THEN concat_ws(',', CASE WHEN court = '' THEN 'court' END, CASE WHEN kind = '' THEN 'type' END, CASE WHEN number = '' THEN '案号' END) ELSE 'court,type,案号' END AS missing,
  body LIKE '%os=yes%' AS official, body LIKE '%覆盖版本%' AS in_review,
  CASE title WHEN '[[甲案]]' THEN '甲案' WHEN '[[甲案|乙案]]' THEN '乙案' ELSE title END AS shown,
  replace(text, '|title = ' || title || chr(10), '|title = 新$1题' || chr(10)) AS retitled,
  CASE WHEN title LIKE '[[[[%' THEN text ELSE replace(text, '|title = ' || title || chr(10), '|title = [[' || title || ']]' || chr(10)) END AS linked,
  (CASE WHEN title LIKE '[[[[%' THEN 1 ELSE 0 END) + (CASE WHEN body LIKE '%[[丁%' THEN 2 ELSE 0 END) + (CASE WHEN body LIKE '[[ 分类%' THEN 1 ELSE 0 END) AS links
  FROM (SELECT *, {_COURT} AS c, {_KIND} AS t, {_NUMBER} AS n FROM ({PAGES}))""".replace("[[[[", "[["))
def page_rules(spark, sf_dir):
    x = F.col("text")
    pages = _made(spark, sf_dir, PAGES)
    return pages.select(
        "k", W.page_kind(x).alias("kind"), W.page_case_title(x).alias("case_title"), W.page_case_number(x).alias("case_number"), W.header_court(x).alias("court"), W.header_type(x).alias("doc_type"),
        F.array_join(W.missing_fields(x), ",").alias("missing"), W.has_official_redaction(x).alias("official"), (W.without_review(x) != x).alias("in_review"), W.shown_title(F.col("title")).alias("shown"),
        W.replace_title(x, F.lit("新$1题")).alias("retitled"), W.link_title(x).alias("linked"), W.content_links(x).cast("long").alias("links"),
    )


#: Lists of entries: two courts' headings, bullets of one or two stars, other lines, categories.
ENTRIES = f"""SELECT o_custkey AS page, o_orderkey AS k, {_pick(['== 甲法院 ==', '==乙法院==', '', ''], 'floor(o_orderkey / 4)')} AS heading, {_pick(['*', '**', ' * ', '#'], 'o_orderkey')} AS stars,
  '院（2024）京' || CAST(o_orderkey % 50 AS STRING) || '号' || {_pick(['判决书', '裁定书', '之一'], 'floor(o_orderkey / 2)')} AS entry, {_pick(['', '|x'], 'floor(o_orderkey / 3)')} AS label FROM orders"""


@query("list_rules", f"""WITH e AS ({ENTRIES}), bullets AS (SELECT page, k, entry, stars, last_value(nullif(trim(replace(heading, '=', '')), '') IGNORE NULLS) OVER (PARTITION BY page ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS court FROM e),
  kept AS (SELECT * FROM bullets WHERE stars <> '#'),
  numbered AS (SELECT DISTINCT page, entry, regexp_extract(entry, '^(.*?)([0-9]+)号(.*)$', 1) AS before, CAST(regexp_extract(entry, '京([0-9]+)号', 1) AS BIGINT) AS n, regexp_extract(entry, '京[0-9]+号(.*)$', 1) AS behind FROM kept)
  SELECT p.page, coalesce(a.entries, '') AS entries, coalesce(a.grouped, '') AS grouped, coalesce(a.nested, false) AS nested, coalesce(s.sorted, '') AS sorted, s.same
  FROM (SELECT DISTINCT page FROM e) p LEFT JOIN (SELECT page, string_agg(entry, ',' ORDER BY k) AS entries, string_agg(coalesce(court, '本院') || ':' || entry, ',' ORDER BY k) AS grouped, bool_or(stars = '**') AS nested FROM kept GROUP BY page) a USING (page)
  LEFT JOIN (SELECT x.page, x.sorted, y.same FROM (SELECT page, string_agg(entry, ',' ORDER BY n, behind) AS sorted FROM numbered GROUP BY page) x LEFT JOIN (SELECT page, arg_min(entry, k) AS same FROM kept WHERE regexp_matches(entry, '^院（2024）京7号(判|裁)') GROUP BY page) y USING (page)) s USING (page)""")
def list_rules(spark, sf_dir):
    line = F.concat(F.when(F.col("heading") != "", F.concat("heading", F.lit("\n"))).otherwise(""), "stars", F.lit("[["), "entry", "label", F.lit("]]\n其他"))
    rows = _made(spark, sf_dir, ENTRIES).groupBy("page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", line.alias("line")))), lambda r: r["line"]), "\n").alias("text"))
    x, entries = F.col("text"), W.entries(F.col("text"))
    grouped = F.transform(W.grouped_entries(x, F.lit("本院")), lambda g: F.concat(g["court"], F.lit(":"), g["title"]))
    return rows.select("page", F.array_join(entries, ",").alias("entries"), F.array_join(grouped, ",").alias("grouped"), W.has_nested_entries(x).alias("nested"), F.array_join(W.sort_entries(entries), ",").alias("sorted"), W.same_case_entry(entries, F.lit("院（2024）京7号")).alias("same"))


TITLES = f"SELECT o_orderkey AS k, {_pick(['北京法院', '', '县法院'], 'o_orderkey')} AS court, '（2024）' || CAST(o_orderkey AS STRING) || {_pick(['号', '号之一', ''], 'floor(o_orderkey / 3)')} AS number, {_pick(['判决书', '', ' 裁定书'], 'floor(o_orderkey / 2)')} AS kind, {_pick(['张某', '张×', '李{{PRC-redact|2}}', 'XX', ''], 'floor(o_orderkey / 5)')} AS other FROM orders"


@query("title_rules", r"""SELECT k, CASE WHEN court <> '' THEN court END AS court_of, CASE WHEN number LIKE '%号%' AND trim(replace(split_part(number, '号', 2) || kind, ' ', '')) <> '' THEN trim(split_part(number, '号', 2) || kind) END AS type_of,
  '* [[' || title || ']]' AS bullet, '==' || other || '==' || chr(10) || '[[Category:' || other || ']]' || chr(10) || '* [[' || title || ']]' AS section, '{{PRC-redact|' || length(title) || '|os=yes}}' AS selection,
  CASE WHEN other = title THEN '[[' || title || ']]' ELSE '[[' || title || '|' || other || ']]' END AS link, 'https://w/' || replace(replace(replace(url_encode(replace(title, ' ', '_')), '%7E', '~'), '%2F', '/'), '%3A', ':') AS url,
  CASE WHEN other = '' THEN title WHEN len(regexp_extract_all(replace(other, '{{PRC-redact|2}}', '   '), '[某×Xx ]')) < len(regexp_extract_all(title, '[某×Xx]')) THEN '{{另|' || other || '|' || title || '}}' ELSE '{{另|' || title || '|' || other || '}}' END AS alternate,
  '#REDIRECT [[' || title || ']]' || chr(10) || chr(10) || '[[Category:中华人民共和国法院裁判文书案号重定向]]' || chr(10) AS redirect, trim(title) AS target,
  CASE WHEN court <> '' AND number LIKE '%号%' AND trim(split_part(number, '号', 2) || kind) <> '' THEN '{{裁判文书消歧义页' || chr(10) || ' | title      = t' || chr(10) || ' | court      = ' || court || chr(10) || ' | type       = ' || trim(split_part(number, '号', 2) || kind) || chr(10) || '}}' || chr(10) || '* [[' || trim(title) || ']]' || chr(10) END AS list
  FROM (SELECT *, court || number || kind AS title FROM (""" + TITLES + "))")
def title_rules(spark, sf_dir):
    rows = _made(spark, sf_dir, TITLES).withColumn("title", F.concat("court", "number", "kind"))
    title, other = F.col("title"), F.col("other")
    redirect = W.redirect_text(title)
    return rows.select(
        "k", W.court_of_title(title).alias("court_of"), W.type_of_title(title).alias("type_of"), W.bullet(title).alias("bullet"), W.court_section(other, title).alias("section"), W.redact_selection(title).alias("selection"),
        W.page_link(title, other).alias("link"), W.page_url(title, "https://w/").alias("url"), W.alternate_title(title, other).alias("alternate"), redirect.alias("redirect"), W.redirect_target(redirect).alias("target"),
        W.redirect_to_list(redirect, F.lit("t")).alias("list"),
    )


CATEGORIES = f"""SELECT o_custkey AS page, o_orderkey AS k, {_pick(['2023年民事判决书', '民事判决书', '2024年中华人民共和国刑事裁定书', '中华人民共和国刑事裁定书', '2022年令', '北京市第一中级人民法院', '其他'], 'o_orderkey')} AS c,
  {_pick(['Category', 'category', '分类', ' 分類 '], 'floor(o_orderkey / 7)')} AS word, {_pick(['', '|排序'], 'floor(o_orderkey / 3)')} AS label FROM orders"""


@query("category_rules", f"""WITH e AS (SELECT * FROM ({CATEGORIES})), d AS (SELECT DISTINCT page, c FROM e), dated AS (SELECT page, c, regexp_extract(c, '^(\\d{{4}})年', 1) AS year, regexp_replace(regexp_replace(c, '^\\d{{4}}年', ''), '^中华人民共和国', '') AS kind FROM d WHERE regexp_matches(c, '^\\d{{4}}年.')),
  good AS (SELECT page, arg_min(year, c) AS year, arg_min(kind, c) AS kind FROM dated WHERE EXISTS (SELECT 1 FROM d WHERE d.page = dated.page AND d.c IN (kind, '中华人民共和国' || kind)) GROUP BY page)
  SELECT p.page, p.categories, good.year, good.kind, p.member FROM (SELECT page, string_agg(c, ',' ORDER BY k) AS categories, bool_or(c = '民事判决书') AS member FROM e GROUP BY page) p LEFT JOIN good USING (page)""")
def category_rules(spark, sf_dir):
    line = F.concat(F.lit("[["), "word", F.lit(":"), "c", "label", F.lit("]]"))
    rows = _made(spark, sf_dir, CATEGORIES).groupBy("page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", line.alias("line")))), lambda r: r["line"]), "\n").alias("content"))
    rows = rows.withColumn("title", F.concat(F.lit("页"), "page"))
    members = P.category_members(rows, "民事判决书").withColumn("member", F.lit(True))
    dated = W.year_and_type(F.col("content"))
    return rows.join(members, "title", "left").select("page", F.array_join(W.categories(F.col("content")), ",").alias("categories"), dated["year"].alias("year"), dated["type"].alias("kind"), F.coalesce("member", F.lit(False)).alias("member"))


STATUSES = ["uploaded", "reverted_overwrite", "failed", "skipped", "conflict_resolved", "overwritable"]


@query("upload_counts", "SELECT o_orderstatus AS batch, count(*) FILTER (o_orderkey % 6 IN (0, 1)) AS uploaded, count(*) FILTER (o_orderkey % 6 = 2) AS failed, count(*) FILTER (o_orderkey % 6 = 3) AS skipped, count(*) FILTER (o_orderkey % 6 = 4) AS resolved, count(*) FILTER (o_orderkey % 6 = 5) AS overwritable FROM orders WHERE o_orderstatus = 'O' GROUP BY 1")
def upload_counts(spark, sf_dir):
    results = _made(spark, sf_dir, f"SELECT {_pick(STATUSES, 'o_orderkey')} AS status FROM orders WHERE o_orderstatus = 'O'")
    return P.upload_counters(results).select(F.lit("O").alias("batch"), "*")


@query("job_counts", "SELECT count(*) AS processed, count(*) FILTER (o_orderkey % 7 = 6) AS created, count(*) FILTER (o_orderkey % 7 = 0) AS missing_page, count(*) FILTER (o_orderkey % 7 = 1) AS missing_metadata, count(*) FILTER (o_orderkey % 7 = 2) AS redirect_exists, count(*) FILTER (o_orderkey % 7 = 3) AS invalid_input, count(*) FILTER (o_orderkey % 7 IN (4, 5)) AS failed, count(*) FILTER (o_orderkey % 7 < 4) AS skipped_total FROM orders")
def job_counts(spark, sf_dir):
    rows = _made(spark, sf_dir, f"SELECT nullif({_pick(['missing_page', 'missing_metadata', 'redirect_exists', 'invalid_input', 'failed', 'failed', ''], 'o_orderkey')}, '') AS reason FROM orders")
    return P.job_counters(rows, F.col("reason"))


@query("run_report", "SELECT CASE WHEN o_orderkey % 5 > 0 THEN o_orderpriority END AS action, CASE WHEN o_orderkey % 5 = 0 THEN 'failed' ELSE 'ok' END AS status, count(*) AS n FROM orders GROUP BY 1, 2")
def run_report(spark, sf_dir):
    rows = _made(spark, sf_dir, "SELECT CAST(o_orderkey AS STRING) AS title, o_orderpriority AS action, CASE WHEN o_orderkey % 5 = 0 THEN 'E' END AS error FROM orders")
    return P.run_report(rows)[1]


@query("unclassified_titles", "SELECT 'c' || c_custkey AS title FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def unclassified_titles(spark, sf_dir):
    title = lambda c: F.concat(F.lit("c"), c).alias("title")
    orders, customer = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "customer"))
    return P.unclassified(customer.select(title("c_custkey")), orders.where("o_orderpriority = '1-URGENT'").select(title("o_custkey")), orders.where("o_orderstatus = 'F'").select(title("o_custkey")))


@query("tagged_contributions", "SELECT o_orderkey AS revid FROM orders WHERE o_custkey % 5 = 2 AND o_orderkey % 3 = 1")
def tagged_contributions(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("revid"), F.concat(F.lit("u"), F.col("o_custkey") % 5).alias("user"), F.when(F.col("o_orderkey") % 3 == 1, F.array(F.lit("bot"), F.lit("mw"))).when(F.col("o_orderkey") % 3 == 2, F.array(F.lit("mw"))).alias("tags"))
    return P.tagged_contributions(rows, "u2", "bot").select("revid")


@query("api_page_records", "SELECT 'p' || o_orderkey AS title, o_orderkey % 4 > 0 AS exists, CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey END AS page_id, CASE o_orderkey % 4 WHEN 1 THEN '内\"容' || o_orderkey WHEN 3 THEN '' END AS content FROM orders")
def api_page_records(spark, sf_dir):
    """Answers of ten pages each: missing ones, ones without revision, and revisions without content."""
    k = F.col("o_orderkey")
    main = F.struct(F.when(k % 4 == 1, F.concat(F.lit('内"容'), k.cast("string"))).alias("content"))
    revision = F.when(k % 4 == 2, F.array().cast("array<struct<slots:struct<main:struct<content:string>>>>")).when(k % 4 > 0, F.array(F.struct(F.struct(main.alias("main")).alias("slots"))))
    page = F.struct(F.concat(F.lit("p"), k.cast("string")).alias("title"), F.when(k % 4 > 0, k).alias("pageid"), F.when(k % 4 == 0, F.lit(True)).alias("missing"), revision.alias("revisions"))
    answers = spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy(F.floor(k / 10).alias("a")).agg(F.to_json(F.struct(F.struct(F.collect_list(page).alias("pages")).alias("query"))).alias("value"))
    return P.page_records(answers)


@query("slice_eligible", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' QUALIFY row_number() OVER (ORDER BY o_orderkey) BETWEEN 101 AND 300")
def slice_eligible(spark, sf_dir):
    """The operator is a slice: 200 eligible rows behind the first 100."""
    return R.slice_eligible(spark.read.parquet(f"{sf_dir}/orders.parquet"), F.col("o_orderstatus") == "O", 100, 200, "o_orderkey").select("o_orderkey")


@query("log_tail", "SELECT event_id, event_type FROM events ORDER BY event_id DESC LIMIT 20")
def log_tail(spark, sf_dir):
    """The operator is the end of a log: its last 20 rows."""
    return R.tail(spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type"), "event_id", 20)


@query("ordered_distinct", "SELECT o_orderkey, concat_ws(',', o_orderpriority, CASE WHEN trim(o_orderstatus) <> o_orderpriority THEN o_orderstatus END, 'O' || (o_orderkey % 2)) AS found FROM orders")
def ordered_distinct(spark, sf_dir):
    none = F.lit(None).cast("string")
    found = R.ordered_distinct(F.array(none, F.col("o_orderpriority"), F.lit(" "), F.concat(F.lit(" "), "o_orderstatus"), F.col("o_orderpriority"), F.concat(F.lit("O"), F.col("o_orderkey") % 2), F.col("o_orderstatus")))
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.array_join(found, ",").alias("found"))


@query("guarded_writes", """SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 AND o_custkey IN (SELECT c_custkey FROM customer) THEN false ELSE true END AS creates, o_orderkey % 2 = 0 AND o_custkey % 3 = 0 AND o_custkey IN (SELECT c_custkey FROM customer) AS unchanged,
  o_orderkey % 5 > 1 AS differs FROM orders""")
def guarded_writes(spark, sf_dir):
    """Which writes a page that exists, one that changed meanwhile, or one that reads the same lets through."""
    orders, customer = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "customer"))
    pages = customer.where("c_custkey % 3 = 0").select(F.concat(F.lit("p"), "c_custkey").alias("title"), F.lit(7).alias("ts"))
    k = F.col("o_orderkey")
    wanted = orders.select("o_orderkey", F.concat(F.lit("p"), "o_custkey").alias("title"), F.when(k % 2 == 0, 7).otherwise(6).alias("base_ts"), F.concat(F.lit("a\nb"), k).alias("before"), F.when(k % 5 == 0, F.concat(F.lit("a\r\nb"), k, F.lit(" \n"))).when(k % 5 == 1, F.concat(F.lit("a\rb"), k)).when(k % 5 == 2, F.concat(F.lit("a b"), k)).otherwise("x").alias("after"))
    mark = lambda df, name: df.select("o_orderkey", F.lit(True).alias(name))
    out = wanted.select("o_orderkey")
    for df, name in ((sinks.create_only(wanted, pages), "creates"), (sinks.unchanged_since(wanted, pages), "unchanged"), (sinks.changed(wanted, "before", "after"), "differs")):
        out = out.join(mark(df, name), "o_orderkey", "left")
    return out.select("o_orderkey", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("creates", "unchanged", "differs")])


def _div(style: str, text: str) -> str:
    return f'<div style="{style}">{text}</div>'


_CENTRE, _RIGHT, _INDENT, _NONE = "TEXT-ALIGN: center; FONT-SIZE: 18pt;", "TEXT-ALIGN: right;", "TEXT-INDENT: 30pt;", ""
#: Parts of bodies and what each becomes: blocks of the source, wikitext.
PARAGRAPHS = [
    (_div(_INDENT, "原告张xx，住某地。"), "{{gap}}原告张{{PRC-redact|2}}，住某地。"),
    (_div(_INDENT, "原告张某与被告李某买卖合同纠纷一案，本院于今年立案") + _div(_INDENT, "后依法审理。"), "{{gap}}原告张某与被告李某买卖合同纠纷一案，本院于今年立案后依法审理。"),
    (_div(_INDENT, "被上诉人赵某，女，住某市某区某街某号某楼某室") + _div(_INDENT, "委托诉讼代理人：钱某。"), "{{gap}}被上诉人赵某，女，住某市某区某街某号某楼某室⏎⏎{{gap}}委托诉讼代理人：钱某。"),
    (_div(_NONE, "-3-") + _div(_INDENT, "现 已 审 理 终 结。"), "{{gap}}现已审理终结。"),
    (_div(_NONE, "事实和理由：") + _div(_INDENT, "3 × 4米，编号3×123。"), "{{gap}}事实和理由：⏎⏎{{gap}}3×4米，编号3×123。"),
]
TABLES = [
    ("", ""),
    ('<table><tr><th>项</th><td colspan="2">a|b</td></tr></table>', '{| class="wikitable"⏎|-⏎! 项⏎| colspan="2" |⏎a|b⏎|}'),
    ("<table><caption>表 一</caption><tr><td>甲<br>乙</td><td></td></tr><tr><td rowspan=2>丙</td></tr></table>", '{| class="wikitable"⏎|+ 表一⏎|-⏎|⏎甲⏎乙⏎|⏎|-⏎| rowspan="2" | 丙⏎|}'),
    ("<ul><li>甲</li><li>乙xx</li></ul>", "* 甲⏎* 乙{{PRC-redact|2}}"),
]
SIGNED = [
    (_div(_RIGHT, "审 判 长　王某"), "审判长：王某"),
    (_div(_RIGHT, "审判员李某书记员赵某"), "审判员：李某⏎书记员：赵某"),
    (_div(_RIGHT, "...审判长：王某") + _div(_RIGHT, "人民陪审员  孙某"), "审判长：王某⏎人民陪审员：孙某"),
]
DATES = [("二〇二四年九月二十八日", ("2024", "9", "28")), ("2023年3月8日", ("2023", "3", "8")), ("", ("2021", "", ""))]
_PART = {"p": ("o_orderkey", 5), "t": ("floor(o_orderkey / 5)", 4), "s": ("floor(o_orderkey / 20)", 3), "d": ("floor(o_orderkey / 60)", 3), "n": ("floor(o_orderkey / 180)", 2)}
_NOTES = ["", "附：相关法律条文"]
_of = lambda part, values: _pick(list(values), _PART[part][0])
_BODY = " || ".join([
    f"'{_div(_CENTRE, '北京市第一中级人民法院') + _div(_CENTRE, '民 事 判 决 书')}'",
    "'<div style=\"TEXT-ALIGN: right;\">..(2021)京01民初' || CAST(o_orderkey AS STRING) || '号</div>'",
    _of("p", (a for a, _ in PARAGRAPHS)), _of("t", (a for a, _ in TABLES)), _of("s", (a for a, _ in SIGNED)),
    f"CASE WHEN floor(o_orderkey / 60) % 3 = 2 THEN '' ELSE '{_div(_RIGHT, '...')[:-9]}' || {_of('d', (a for a, _ in DATES))} || '</div>' || CASE WHEN floor(o_orderkey / 180) % 2 = 1 THEN '{_div(_NONE, _NOTES[1])}' ELSE '' END END",
])
BODIES = f"SELECT o_orderkey AS doc_num, '甲案民事判决书' AS s1, '' AS s2, '' AS s7, '' AS s22, '' AS s31, 'doc-' || CAST(o_orderkey AS STRING) AS wsKey, {_BODY} AS qwContent FROM orders"
_DATED = "floor(o_orderkey / 60) % 3 < 2"


@query("convert_wikitext", f"""SELECT o_orderkey AS doc_num, '北京市第一中级人民法院' AS court, '民事判决书' AS doc_type, '（2021）京01民初' || o_orderkey || '号' AS doc_id, replace(
  '{{{{Header/裁判文书⏎|title = 甲案民事判决书⏎|court = 北京市第一中级人民法院⏎|type = 民事判决书⏎|案号 = （2021）京01民初' || o_orderkey || '号⏎|year = ' || {_of("d", (y for _, (y, _, _) in DATES))} || '⏎|month = ' || {_of("d", (m for _, (_, m, _) in DATES))} || '⏎|day = ' || {_of("d", (d for _, (_, _, d) in DATES))} || '⏎|loc = 北京市⏎|docid = doc-' || o_orderkey || '⏎}}}}⏎'
  || {_of("p", (b for _, b in PARAGRAPHS))} || CASE WHEN floor(o_orderkey / 5) % 4 > 0 THEN '⏎⏎' ELSE '' END || {_of("t", (b for _, b in TABLES))}
  || '⏎⏎{{{{裁判文书署名|1=⏎' || {_of("s", (b for _, b in SIGNED))} || CASE WHEN {_DATED} THEN '⏎' || {_of("d", (a for a, _ in DATES))} ELSE '' END || '⏎}}}}⏎'
  || CASE WHEN {_DATED} AND floor(o_orderkey / 180) % 2 = 1 THEN '⏎{_NOTES[1]}⏎⏎' ELSE '' END || '{{{{PD-PRC-exempt}}}}⏎', '⏎', chr(10)) AS wikitext FROM orders""")
def convert_wikitext(spark, sf_dir):
    """The whole job on bodies of known parts: paragraphs, tables, lists, signatures, dates, notes."""
    found = C.convert(_made(spark, sf_dir, BODIES), as_of=AS_OF)
    return C.successes(found.withColumn("title", F.col("doc_num").cast("string"))).select(F.col("title").cast("long").alias("doc_num"), "court", "doc_type", "doc_id", "wikitext")


#: Lines of a page, and the points that each adds for redactions, structure and formatting, and its links.
SCORED = [
    ("{{gap}}张xx诉称。", 1, 0, 0, 0), ("{{gap}}李{{PRC-redact|2}}**到庭。", 4, 0, 0, 0), ("{{gap}}**{{PRC-redact|2}}到庭。", 4, 0, 0, 0), ("{{gap}}赵{{PRC-redact}}到庭。", 10, 0, 0, 0),
    ("{{裁判文书署名|1=}}", 0, 12, 0, 0), ("{{gap}}..审判长王某。", 0, 10, 0, 0), ("..（2020）京1号", 0, 10, 0, 0), ("审判员王某书记员李某。", 0, 8, 0, 0),
    ("事实和理由：", 0, 0, 4, 0), ("{{gap}}被告辩称⏎⏎{{gap}}不同意。", 0, 0, 8, 0), ("见[[甲]]和[[乙|丙]]。", 0, 0, 0, 2), ("[[Category:丁]]。", 0, 0, 0, 0), ("{{gap}}3×4米。", 0, 0, 0, 0),
]
_SCORED = [f"o_orderkey * {a} + floor(o_orderkey / {b})" for a, b in ((1, 13), (3, 7), (5, 3))]
SCORED_PAGES = f"SELECT o_orderkey AS ordinal, replace('{{{{Header/裁判文书⏎|title = 张xx案⏎}}}}⏎完。⏎' || {" || '⏎完。⏎' || ".join(_pick([s[0] for s in SCORED], n) for n in _SCORED)}, '⏎', chr(10)) AS content FROM orders"


@query("quality_rules", "SELECT o_orderkey AS ordinal, " + ", ".join(f"{' + '.join(f"CAST({_pick([str(s[i]) for s in SCORED], n)} AS BIGINT)" for n in _SCORED)} AS {name}" for i, name in enumerate(("redactions", "structure", "formatting", "links"), 1)) + " FROM orders")
def quality_rules(spark, sf_dir):
    x = F.col("content")
    scores = [c.cast("long").alias(n) for c, n in ((W.redaction_penalty(x), "redactions"), (W.structure_penalty(x), "structure"), (W.formatting_penalty(x), "formatting"), (W.content_links(x), "links"))]
    return _made(spark, sf_dir, SCORED_PAGES).select("ordinal", *scores)


#: A page as it stands, the import that was undone, and what is decided on it.
_BODY_OF = "{{{{Header/裁判文书⏎|title = 甲案⏎|案号 = {}⏎}}}}⏎{}⏎"
IMPORTS = [
    (("（2024）京1号", "{{gap}}张某诉称。"), ("（2024）京1号", "{{gap}}张某诉称。"), "import_matches_current"),
    (("（2024）京1号", "{{gap}}张{{PRC-redact|2}}诉称。"), ("（2024）京1号", "{{gap}}张xx诉称。"), "redaction_template_loss"),
    (("（2024）京1号", "{{gap}}张某诉称。"), ("(2024)京1号", "{{gap}}张某诉称。"), "current_has_safe_header_fix"),
    (("（2024）京1号", "{{gap}}张{{PRC-redact|3}}诉称。"), ("（2024）京1号", "{{gap}}张{{PRC-redact|2}}{{PRC-redact|1}}xx诉称。"), "import_not_obviously_bad"),
    (("（2024）京1号", "{{gap}}张某诉称被告欠款。"), ("（2024）京1号", "{{gap}}张某诉称⏎⏎{{gap}}被告欠款。"), "current_has_safe_formatting_fix"),
    (("（2024）京1号", "{{gap}}张某诉称。⏎{{裁判文书署名|1=⏎审判长：王某⏎}}"), ("（2024）京1号", "{{gap}}张某诉称。⏎{{gap}}..审判长王某⏎{{裁判文书署名|1=⏎}}"), "current_has_safe_signature_structure_fix"),
    (("（2024）京1号", "{{gap}}张某诉称。"), ("（2024）京1号", "{{gap}}李某诉称。"), "import_not_obviously_bad"),
]


def import_histories(spark, sf_dir) -> DataFrame:
    """title, revid, ts, user, comment, text: each customer's orders are a history; the import before the newest was undone."""
    text = lambda pair: _BODY_OF.format(*pair).replace("⏎", "\n")
    kind = (F.col("o_custkey") % len(IMPORTS)).cast("int")
    choose = lambda side: F.element_at(F.array(*[F.lit(text(row[side])) for row in IMPORTS]), kind + 1)
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("rank", F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_orderkey"))))
    body = F.when(F.col("rank") == 1, W.with_review(choose(0))).when(F.col("rank") == 2, choose(1)).otherwise(choose(0))
    return o.select(F.concat(F.lit("p"), "o_custkey").alias("title"), F.col("o_orderkey").alias("revid"), F.col("o_orderkey").alias("ts"), F.lit("u").alias("user"), F.when(F.col("rank") == 1, REVERT_SUMMARY).otherwise(IMPORT_SUMMARY).alias("comment"), body.alias("text"))


@query("import_decisions", f"""SELECT title, reason, CASE WHEN reason IN ('import_not_obviously_bad', 'fewer_than_three_revisions') THEN 'skip' ELSE 'fix' END AS action
  FROM (SELECT 'p' || o_custkey AS title, CASE WHEN count(*) < 3 THEN 'fewer_than_three_revisions' ELSE {_pick([r for _, _, r in IMPORTS], 'o_custkey')} END AS reason FROM orders GROUP BY o_custkey)""")
def import_decisions(spark, sf_dir):
    return V.clear_bad_imports(import_histories(spark, sf_dir)).select("title", "action", "reason")


#: Masks side by side, what they are when they are merged, and their form in comparisons.
_SIDE = [("{{PRC-redact|1}}{{PRC-redact|2}}", "{{PRC-redact|3}}", "{{PRC-redact|3}}"), ("{{PRC-redact|1}}×", "{{PRC-redact|2}}", "{{PRC-redact|2}}"), ("×{{PRC-redact|2}}×", "{{PRC-redact|4}}", "{{PRC-redact|4}}"), ("××", "{{PRC-redact|2}}", "{{PRC-redact|2}}"), ("×", "×", "{{PRC-redact|1}}"), ("{{PRC-redact|5}}", "{{PRC-redact|5}}", "{{PRC-redact|5}}"), ("丁", "丁", "丁")]


def _sides(part: int) -> str:
    return f"'甲' || {_pick([s[part] for s in _SIDE], 'o_orderkey')} || '乙' || {_pick([s[part] for s in _SIDE], 'floor(o_orderkey / 7)')} || '丙'"


@query("redaction_forms", f"SELECT o_orderkey AS k, {_sides(1)} AS merged, {_sides(2)} AS canonical FROM orders")
def redaction_forms(spark, sf_dir):
    """Masks that stand side by side, merged, and in the form that texts are compared in."""
    rows = _made(spark, sf_dir, f"SELECT o_orderkey AS k, {_sides(0)} AS x FROM orders")
    return rows.select("k", T.merge_redactions(F.col("x")).alias("merged"), T.canonical_redactions(F.col("x")).alias("canonical"))
