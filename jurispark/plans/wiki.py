"""Queries on pages, histories and logs, derived from the same tables, and on documents and web pages."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jurispark.functions import html, render
from jurispark.functions import text as T
from jurispark.functions import wiki as W
from jurispark.functions.chars import MARKERS, X_MARKERS
from jurispark.operators import jobs as J
from jurispark.operators import relational as R
from jurispark.operators import revisions as V
from jurispark.operators.planner import IMPORT_SUMMARY, REVERT_SUMMARY, plan_uploads
from jurispark.plans.court import AS_OF
from jurispark.plans.registry import query, table


def _title(n):
    return F.concat(F.lit("共享标题"), n.cast("string"))


def drafts(spark, sf_dir, key: str | None = "o_orderkey") -> DataFrame:
    """ordinal, title, wenshu_id, wikitext: three orders share a title; case numbers repeat every so often."""
    o = table(spark, sf_dir, "orders", key).withColumn("n", F.floor(F.col("o_orderkey") / 3))
    number = F.concat(F.lit("（2024）京01民初"), F.when(F.col("o_orderkey") % 7 == 0, F.col("n")).otherwise(F.col("o_orderkey")).cast("string"), F.lit("号"))
    court = F.when(F.col("o_orderkey") % 4 == 0, "上海市第一中级人民法院").otherwise("北京市第一中级人民法院")
    return o.select(F.col("o_orderkey").alias("ordinal"), _title(F.col("n")).alias("title"), F.concat(F.lit("doc-"), F.col("o_orderkey").cast("string")).alias("wenshu_id"), _page(_title(F.col("n")), court, number, F.concat(F.lit("doc-"), F.col("o_orderkey").cast("string")), F.when(F.col("o_orderkey") % 5 == 0, "张xx诉称").otherwise("原告诉称")).alias("wikitext"))


def _page(title, court, number, docid, body):
    return F.concat(F.lit("{{Header/裁判文书\n|title = "), title, F.lit("\n|court = "), court, F.lit("\n|type = 民事判决书\n|案号 = "), number, F.lit("\n|year = 2024\n|month = 1\n|day = 1\n|loc = \n|docid = "), docid, F.lit("\n}}\n{{gap}}"), body, F.lit("。\n\n{{裁判文书署名|1=\n审判长：王某\n}}\n{{PD-PRC-exempt}}\n"))


def wiki_pages(spark, sf_dir) -> DataFrame:
    """title, content, revisions: some titles of the drafts are taken by documents, lists or redirects."""
    o = table(spark, sf_dir, "orders").where(F.col("o_orderkey") % 3 == 0).withColumn("n", F.floor(F.col("o_orderkey") / 3)).dropDuplicates(["n"])
    key = F.col("o_orderkey").cast("string")
    case = F.concat(F.lit("北京市第一中级人民法院（2024）京01民初"), key, F.lit("号民事判决书"))
    document = _page(_title(F.col("n")), F.lit("北京市第一中级人民法院"), F.concat(F.lit("(2024)京01民初"), key, F.lit("号")), F.concat(F.lit("doc-"), key), F.when(F.col("n") % 10 == 1, "张{{PRC-redact|2}}诉称").otherwise("原告诉称"))
    listed = W.versions_page(_title(F.col("n")), F.lit("北京市第一中级人民法院"), F.array(case), F.lit("民事判决书"))
    content = F.when(F.col("n") % 5 == 0, document).when(F.col("n") % 5 == 1, listed).when(F.col("n") % 5 == 2, W.redirect_text(F.concat(F.lit("别处"), key)))
    return o.select(_title(F.col("n")).alias("title"), content.alias("content"), F.lit(1).alias("revisions")).where("content IS NOT NULL")


def marked_sql(text: str) -> str:
    """Runs of masking characters as templates, in DuckDB: a text is split into runs of these and of others; what stands
    before and behind a run decides. For texts without templates."""
    runs = f"regexp_extract_all({text}, '[{MARKERS}]+|[^{MARKERS}]+')"
    lone = "(r = '×' AND regexp_matches(coalesce(runs[i + 1], ''), '^[0-9.]'))"
    sure = f"(regexp_matches(r, '[{X_MARKERS}][{X_MARKERS}]') OR NOT regexp_matches(r, '[{X_MARKERS}]'))"
    latin = "regexp_matches(coalesce(runs[i - 1], ''), '[A-WYZa-wyz]$') OR regexp_matches(coalesce(runs[i + 1], ''), '^[A-WYZa-wyz]')"
    rule = f"CASE WHEN regexp_matches(r, '^[{MARKERS}]') AND NOT {lone} AND ({sure} OR NOT ({latin})) THEN '{{{{PRC-redact|' || length(r) || '}}}}' ELSE r END"
    return f"(SELECT array_to_string(list_transform(runs, lambda r, i: {rule}), '') FROM (SELECT {runs} AS runs))"


@query("upload_plan")
def upload_plan(spark, sf_dir):
    plan = plan_uploads(drafts(spark, sf_dir), wiki_pages(spark, sf_dir))
    return plan.select("ordinal", "title", "status", "final_title", "case_title", "redirect_status", "message", "route", F.size("actions").alias("writes"))


@query("page_lookup_left", """SELECT o_orderkey AS ordinal, p.n IS NOT NULL AS found, CASE p.n % 5 WHEN 0 THEN 'header' WHEN 1 THEN 'versions' WHEN 2 THEN 'other' END AS kind
  FROM orders LEFT JOIN (SELECT DISTINCT o_orderkey // 3 AS n FROM orders WHERE o_orderkey % 3 = 0 AND (o_orderkey // 3) % 5 < 3) p ON p.n = o_orderkey // 3""")
def page_lookup_left(spark, sf_dir):
    pages = wiki_pages(spark, sf_dir).select("title", F.lit(True).alias("found"), W.page_kind(F.col("content")).alias("kind"))
    docs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ordinal"), _title(F.floor(F.col("o_orderkey") / 3)).alias("title"))
    return docs.join(pages, "title", "left").select("ordinal", F.coalesce("found", F.lit(False)).alias("found"), "kind")


@query("redirect_resolve", "SELECT 'p' || c_custkey AS title, CASE WHEN 'p' || CAST(ceil(c_custkey / 4.0) * 4 AS BIGINT) IN (SELECT 'p' || c_custkey FROM customer) THEN 'p' || CAST(ceil(c_custkey / 4.0) * 4 AS BIGINT) END AS resolved FROM customer")
def redirect_resolve(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    pages = c.select(F.concat(F.lit("p"), "c_custkey").alias("title"), F.when(F.col("c_custkey") % 4 != 0, F.concat(F.lit("p"), F.col("c_custkey") + 1)).alias("target"))
    return R.resolve_redirects(pages).select("title", "resolved")


@query("anti_dedupe_redirects", """WITH r AS (SELECT o_orderkey AS line, 'case' || o_custkey AS key, o_custkey FROM orders) SELECT line, key,
  CASE WHEN o_custkey % 3 = 0 AND o_custkey IN (SELECT c_custkey FROM customer) THEN 'exists' WHEN line > min(line) OVER (PARTITION BY key) THEN 'duplicate' ELSE 'new' END AS outcome FROM r""")
def anti_dedupe_redirects(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("line"), F.concat(F.lit("case"), "o_custkey").alias("key"))
    known = table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(F.concat(F.lit("case"), "c_custkey").alias("key"))
    return R.anti_dedupe(rows, known, "key", "line").select("line", "key", "outcome")


@query("positional_diff", """WITH a AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS position, o_orderkey AS line, o_orderpriority AS p FROM orders WHERE o_orderkey % 2 = 0),
  b AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS position, o_orderkey AS new_line, o_orderpriority AS new_p FROM orders WHERE o_orderkey % 3 = 0)
  SELECT position, line, new_line, p <> new_p AS differs FROM a JOIN b USING (position)""")
def positional_diff(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("line"), F.col("o_orderpriority").alias("p"))
    pairs = R.positional_join(o.where("line % 2 = 0"), o.where("line % 3 = 0"), "line")
    return pairs.select("position", "line", "new_line", (F.col("p") != F.col("new_p")).alias("differs"))


@query("wanted_semi_join", "SELECT o_custkey AS id, arg_max(o_orderkey, o_orderkey) AS line, arg_max(o_orderpriority, o_orderkey) AS priority FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3) GROUP BY o_custkey")
def wanted_semi_join(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("line"), F.col("o_orderpriority").alias("priority"))
    wanted = table(spark, sf_dir, "customer").where("c_nationkey = 3").select(F.col("c_custkey").alias("id"))
    return R.semi_join_last(o, wanted, "id", "line")


@query("versions_sort", "SELECT o_custkey AS custkey, string_agg('院（2024）民' || o_orderkey || '号', '|' ORDER BY o_orderkey) AS entries FROM orders GROUP BY o_custkey")
def versions_sort(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), F.concat(F.lit("院（2024）民"), F.col("o_orderkey").cast("string"), F.lit("号")).alias("t"))
    return o.groupBy("custkey").agg(F.array_join(W.sort_entries(F.collect_list("t")), "|").alias("entries"))


@query("export_union_sort", """SELECT o_orderdate AS ts, CASE WHEN o_orderkey % 9 = 0 THEN 'create' ELSE 'normal edit' END AS type, 'p' || o_orderkey AS name, NULL::VARCHAR AS target_name FROM orders WHERE o_orderkey % 2 = 0
  UNION ALL SELECT o_orderdate, 'move', 'p' || o_orderkey, 'q' || o_orderkey FROM orders WHERE o_orderkey % 2 = 1""")
def export_union_sort(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.lit("u").alias("user"), F.col("o_orderdate").alias("ts"), F.concat(F.lit("p"), "o_orderkey").alias("title"), F.concat(F.lit("q"), "o_orderkey").alias("target"), (F.col("o_orderkey") % 9 == 0).alias("is_new"), "o_orderkey")
    return J.export_edits(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 2 = 1"), "u", F.lit("1900-01-01").cast("timestamp"), F.lit("2100-01-01").cast("timestamp"))


@query("export_type_counts", "SELECT CASE WHEN o_orderkey % 2 = 1 THEN 'move' WHEN o_orderkey % 9 = 0 THEN 'create' ELSE 'normal edit' END AS type, count(*) AS n FROM orders GROUP BY 1")
def export_type_counts(spark, sf_dir):
    return export_union_sort(spark, sf_dir).groupBy("type").agg(F.count(F.lit(1)).alias("n"))


@query("category_first_wins", "SELECT o_custkey AS title, arg_min(o_orderpriority, o_orderkey) AS category FROM orders GROUP BY o_custkey")
def category_first_wins(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("title"), F.col("o_orderpriority").alias("category"), F.col("o_orderkey").alias("seen"))
    return R.first_tag(o, "title", "category", "seen")


def revisions(spark, sf_dir) -> DataFrame:
    """title, revid, ts, user, comment, text: each customer's orders are a page's history, newest last."""
    o = table(spark, sf_dir, "orders")
    kind = F.col("o_custkey") % 6
    place = F.col("o_orderkey")
    newest = F.max("o_orderkey").over(Window.partitionBy("o_custkey"))
    body = lambda name: F.concat(F.lit("{{Header/裁判文书\n|title = t\n|court = 甲法院\n|type = 判决书\n|案号 = （2024）1号\n}}\n"), name, F.lit("诉称。\n"))
    current, second = place == newest, F.col("rank") == 2
    plain_, marked, other = body(F.lit("张xx")), body(F.lit("张{{PRC-redact|2}}")), body(F.lit("李某"))
    imported = F.when(kind == 1, marked).when(kind == 2, other).when(kind == 3, F.concat(plain_, F.lit("{{PRC-redact|1|os=yes}}"))).otherwise(marked)
    text = F.when(current, F.when(kind == 4, plain_).otherwise(W.with_review(F.when(kind == 5, other).otherwise(plain_)))).when(second, imported).otherwise(plain_)
    o = o.withColumn("rank", F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_orderkey"))))
    return o.select(F.concat(F.lit("p"), "o_custkey").alias("title"), F.col("o_orderkey").alias("revid"), F.col("o_orderkey").alias("ts"), F.concat(F.lit("u"), F.col("o_orderkey") % 5).alias("user"), F.when(current, REVERT_SUMMARY).otherwise(IMPORT_SUMMARY).alias("comment"), text.alias("text"))


_REASON = "CASE WHEN n < 3 THEN 'fewer_than_three_revisions' WHEN k % 6 = 4 THEN 'current_page_not_in_unchecked_category' WHEN k % 6 = 5 THEN 'current_without_category_does_not_match_pre_import_revision' ELSE {} END"


@query("revision_triplet_decision", f"SELECT 'p' || k AS title, CASE WHEN {_REASON.format("'x'")} = 'x' AND k % 6 IN (0, 1) THEN 'fix' ELSE 'skip' END AS action, {_REASON.format("CASE k % 6 WHEN 2 THEN 'non_redaction_difference' WHEN 3 THEN 'contains_os_redaction' ELSE 'redaction_markup_only' END")} AS reason FROM (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1)")
def revision_triplet_decision(spark, sf_dir):
    return V.rescue_redactions(revisions(spark, sf_dir)).select("title", "action", "reason")


@query("bad_import_decision", f"SELECT 'p' || k AS title, 'skip' AS action, {_REASON.format("'import_not_obviously_bad'")} AS reason FROM (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1)")
def bad_import_decision(spark, sf_dir):
    return V.clear_bad_imports(revisions(spark, sf_dir)).select("title", "action", "reason")


@query("first_author", "SELECT 'p' || o_custkey AS title, 'u' || (min(o_orderkey) % 5) AS creator FROM orders GROUP BY o_custkey")
def first_author(spark, sf_dir):
    return V.first_author(revisions(spark, sf_dir).select("title", "revid", "user"))


@query("latest_revisions", "SELECT 'p' || o_custkey AS title, o_orderkey AS revid, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS place FROM orders QUALIFY place <= 3")
def latest_revisions(spark, sf_dir):
    return R.latest(revisions(spark, sf_dir).select("title", "revid"), "title", [F.desc("revid")], 3)


@query("redaction_counts", f"SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[{MARKERS}]')) AS raw_markers FROM documents")
def redaction_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.raw_marker_count(F.col("text")).alias("raw_markers"))


@query("redaction_normalize", f"SELECT doc_id, CAST(CASE WHEN text IS NULL THEN 0 ELSE coalesce(list_sum(list_transform(regexp_extract_all(m, 'PRC-redact\\|(\\d+)', 1), lambda v: v::BIGINT)), 0) END AS BIGINT) AS masked_characters, sha256(m) AS sha256 FROM (SELECT doc_id, text, {marked_sql('text')} AS m FROM documents)")
def redaction_normalize(spark, sf_dir):
    marked = table(spark, sf_dir, "documents", "doc_id").select("doc_id", T.mark_redactions(F.col("text")).alias("marked"))
    return marked.select("doc_id", T.template_sum(F.col("marked")).alias("masked_characters"), F.sha2("marked", 256).alias("sha256"))


@query("quality_penalties", "SELECT o_orderkey AS ordinal, CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS redactions, 0 AS structure, 8 AS formatting, 0 AS links FROM orders")
def quality_penalties(spark, sf_dir):
    text = F.col("wikitext")
    return drafts(spark, sf_dir).select("ordinal", W.redaction_penalty(text).alias("redactions"), W.structure_penalty(text).alias("structure"), W.formatting_penalty(text).alias("formatting"), W.content_links(text).alias("links"))


@query("invisible_char_histogram", "SELECT 8203 AS codepoint, count(*) AS n FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT 65279, count(*) FROM documents WHERE doc_id % 3 = 1")
def invisible_char_histogram(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    extra = F.when(F.col("doc_id") % 3 == 0, "​").when(F.col("doc_id") % 3 == 1, "﻿").otherwise("")
    return J.invisible_histogram(d.select(F.concat(T.or_empty(F.col("text")), extra).alias("content")))


@query("row_hash_id", "SELECT c_custkey, substr(sha1(c_name || '|' || c_mktsegment || '|||'), 1, 12) AS row_id FROM customer")
def row_hash_id(spark, sf_dir):
    none = F.lit(None).cast("string")
    return table(spark, sf_dir, "customer").select("c_custkey", T.sha1_id([F.col("c_name"), F.col("c_mktsegment"), none, none, none], F.col("c_custkey")).alias("row_id"))


@query("failure_classify", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'existing_header_metadata' WHEN 1 THEN 'court_mismatch' WHEN 2 THEN 'title' ELSE 'generic' END AS kind FROM orders")
def failure_classify(spark, sf_dir):
    said = F.element_at(F.array(*map(F.lit, ["Could not extract court/type/year from existing page header", "Court mismatch: a", "Requested page title is too long", "timeout"])), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", W.failure_kind(said, "Could not extract court/type/year from existing page header").alias("kind"))


@query("category_repair", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '[[Category:2023年中华人民共和国民事判决书]]' WHEN o_orderkey % 3 = 1 THEN '[[Category:中华人民共和国民事判决书]]' ELSE '[[Category:2023年中华人民共和国刑事判决书]]' END AS fixed FROM orders")
def category_repair(spark, sf_dir):
    text = F.when(F.col("o_orderkey") % 3 == 0, "[[Category:2023年民事判决书]]").when(F.col("o_orderkey") % 3 == 1, "[[Category:民事判决书]]").otherwise("[[Category:2023年中华人民共和国刑事判决书]]")
    return table(spark, sf_dir, "orders").select("o_orderkey", W.fix_country_categories(text).alias("fixed"))


@query("local_day_events", "SELECT event_id, event_type FROM events WHERE ts >= (SELECT min(date_trunc('day', ts)) + INTERVAL 1 DAY - INTERVAL 8 HOUR FROM events) AND ts < (SELECT min(date_trunc('day', ts)) + INTERVAL 2 DAY - INTERVAL 8 HOUR FROM events)")
def local_day_events(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    day = events.agg(F.date_format(F.min("ts") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd")).first()[0]
    since, until = R.day_window(day, "Asia/Shanghai")
    at = F.col("ts").cast("timestamp_ntz")
    return events.where((at >= since) & (at < until)).select("event_id", "event_type")


@query("year_repair", "SELECT 'p' || o_orderkey AS title, CASE WHEN o_orderkey % 3 = 0 THEN 'skip' ELSE 'fix' END AS action, CASE WHEN o_orderkey % 3 = 0 THEN 'current_year_already_valid' END AS reason, CASE o_orderkey % 3 WHEN 1 THEN '2021' WHEN 2 THEN '2019' END AS inferred_year FROM orders")
def year_repair(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.concat(F.lit("p"), "o_orderkey").alias("title"), "o_orderkey", "o_orderpriority")
    year = F.when(F.col("o_orderkey") % 3 == 0, "2020").otherwise("2205")
    number = F.when(F.col("o_orderkey") % 3 == 1, "（2021）京1号").otherwise("京1号")
    pages = o.select("title", F.concat(F.lit("{{Header/裁判文书\n|year = "), year, F.lit("\n|案号 = "), number, F.lit("\n}}\n{{裁判文书署名|1=\n二〇一九年三月八日\n}}\n")).alias("content"))
    fixed = J.fix_years(o.select("title", F.col("o_orderpriority").alias("category"), F.col("o_orderkey").alias("seen")), pages, as_of=AS_OF)
    return fixed.select("title", "action", "reason", "inferred_year")


@query("case_redirect_job", """WITH r AS (SELECT o_orderkey AS line, o_orderkey // 3 AS n, CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey // 3 ELSE o_orderkey END AS number, o_orderkey % 4 = 0 AS shanghai FROM orders)
  SELECT line, CASE WHEN (p.n IS NULL) THEN 'source_page_missing' WHEN p.n % 5 > 0 THEN 'header_missing' WHEN line > min(line) OVER (PARTITION BY p.n) THEN 'redirect_page_exists' END AS reason
  FROM r LEFT JOIN (SELECT DISTINCT o_orderkey // 3 AS n FROM orders WHERE o_orderkey % 3 = 0 AND (o_orderkey // 3) % 5 < 3) p ON p.n = r.n""")
def case_redirect_job(spark, sf_dir):
    records = drafts(spark, sf_dir, key=None).select(F.col("ordinal").alias("line"), "title", "wenshu_id")
    return J.case_redirects(records, wiki_pages(spark, sf_dir)).select("line", "reason")


@query("record_search", "SELECT o_orderkey AS line FROM orders WHERE o_orderkey % 4 = 1 AND o_orderpriority = '2-HIGH'")
def record_search(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_orderkey")
    value = F.to_json(F.struct(F.when(F.col("o_orderkey") % 4 == 1, "北京法院").otherwise("上海法院").alias("s2"), F.struct(F.col("o_orderpriority").alias("docType")).alias("document")))
    return J.search_records(o.select(F.col("o_orderkey").alias("line"), value.alias("value")), {"court": "^北京", "doc_type": "HIGH"}).select("line")


BLOCKS = "page_id long, ord int, kind string, text string, indent boolean, items array<string>"


#: Pages whose blocks are held at once.
HELD = 128


def pieces(batches):
    """Batches of a few pages each: what a task holds goes with these, not with the rows that Spark sends at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, HELD):
            yield batch.slice(at, HELD)


def page_blocks_of(pages: DataFrame) -> DataFrame:
    """A row for each block of each page, wrappers looked into."""

    def run(batches):
        kinds = (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.list_(pa.string()))
        for batch in pieces(batches):
            rows = [(i, n, b.kind, b.text, b.indent, b.items) for i, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for n, b in enumerate(html.blocks(source or "", descend=True))]
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in BLOCKS.split(", ")])

    return pages.select("page_id", "html").mapInArrow(run, BLOCKS)


@query("page_blocks")
def page_blocks(spark, sf_dir):
    return page_blocks_of(table(spark, sf_dir, "pages", "page_id")).select("page_id", "ord", "kind", "text", "indent", F.size("items").alias("n_items"))


@query("block_type_counts")
def block_type_counts(spark, sf_dir):
    return page_blocks_of(table(spark, sf_dir, "pages", "page_id")).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("items")).alias("items"))


@query("page_lists", "SELECT page_id, CAST(len(regexp_extract_all(html, '<li>')) AS BIGINT) AS items FROM pages WHERE html LIKE '%<li>%'")
def page_lists(spark, sf_dir):
    return page_blocks_of(table(spark, sf_dir, "pages", "page_id")).where("kind = 'LIST'").groupBy("page_id").agg(F.sum(F.size("items")).alias("items"))


@query("paragraph_merge")
def paragraph_merge(spark, sf_dir):
    """Bodies of pages as wikitext, with broken sentences joined."""

    def run(batches):
        for batch in pieces(batches):
            found = [html.blocks(s or "", descend=True) for s in batch.column(1).to_pylist()]
            merged = [render.merge(b) for b in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, found), pa.int32()), pa.array(map(len, merged), pa.int32()), pa.array([render.body(b) for b in found], pa.string())], names=["page_id", "blocks", "merged", "wikitext"])

    return table(spark, sf_dir, "pages", "page_id").select("page_id", "html").mapInArrow(run, "page_id long, blocks int, merged int, wikitext string")


@query("untouched_sample", "SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) = 1 ORDER BY md5('7:' || o_custkey), o_custkey LIMIT 50")
def untouched_sample(spark, sf_dir):
    """The operator is a sample: 50 pages whose newest revision is their first, in an order that the seed fixes."""
    pages = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return R.seeded_sample(pages, "o_custkey", F.col("n") == 1, 50, 7).select("o_custkey")
