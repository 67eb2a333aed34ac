"""Queries on whole jobs: pages and logs that are put together from known parts, so that SQL can tell what comes out."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from jurispark.functions import metadata as M
from jurispark.functions import text as T
from jurispark.operators import convert as C
from jurispark.operators import history
from jurispark.operators import jobs as J
from jurispark.operators import places as L
from jurispark.plans.court import AS_OF, RAW, raw
from jurispark.plans.registry import query, table
from jurispark.plans.rules import TEXTS, _made, _pick
from jurispark.sources import commits, dumps, early, sinks
from jurispark.sources.shared import cut, delete, passing, shared_dir
from jurispark.streaming.first import first_wins_stream

#: Files that a made log is written to.
FILES = 16
REVIEW_LINE = "[[Category:覆盖版本未检查的裁判文书]]"
#: Parts of a page as it stands, and what each becomes.
INTROS = ["", "文书内容⏎甲市人民法院⏎民 事 判 决 书⏎", "甲市人民法院⏎⏎", "甲市人民法院民事判决书"]
BODIES = [
    ("第一段。⏎{{gap}}第二段。", "{{gap}}第一段。⏎⏎{{gap}}第二段。"),
    ("首段。⏎<b>甲</b>⏎⏎⏎{{other}}⏎[[乙]]", "{{gap}}首段。⏎<b>甲</b>⏎{{other}}⏎[[乙]]"),
    ("首段。⏎驳回诉讼请求，本判决为终审判决。审判长王某某审判员李某二〇二四年一月二日书记员赵某", "{{gap}}首段。⏎⏎{{gap}}驳回诉讼请求，本判决为终审判决⏎⏎{{裁判文书署名|1=⏎审判长：王某某⏎审判员：李某⏎二〇二四年一月二日⏎书记员：赵某⏎}}"),
]
ENDS = [("", ""), ("{{署名|⏎{{印|x}}⏎审判员　李某⏎}}⏎书记员：赵某", "{{裁判文书署名|1=⏎审判员：李某⏎书记员：赵某⏎}}"), ("审 判 长 王某⏎2024年1月2日", "{{裁判文书署名|1=⏎审判长：王某⏎2024年1月2日⏎}}"), ("{{裁判文书署名|1=⏎⏎}}", "")]
_B, _E = "o_orderkey", "CASE WHEN o_orderkey % 3 = 2 THEN 0 ELSE floor(o_orderkey / 3) END"
OLD_PAGES = f"""SELECT o_orderkey AS k, replace({_pick(['', '{{header⏎|title = x⏎}}⏎', '{{Header/裁判文书⏎|title = x⏎|docid = 9⏎}}⏎'], 'floor(o_orderkey / 2)')} || {_pick(INTROS, 'floor(o_orderkey / 7)')} || {_pick([a for a, _ in BODIES], _B)} || '⏎⏎' || {_pick([a for a, _ in ENDS], _E)}
  || '⏎' || {_pick(['', REVIEW_LINE + '⏎'], 'floor(o_orderkey / 5)')} || '{{{{PD-PRC-exempt}}}}⏎', '⏎', chr(10)) AS content FROM orders"""


@query("page_rebuild", f"""SELECT o_orderkey AS k, replace('{{{{Header/裁判文书⏎|title = 甲案⏎|court = 甲市人民法院⏎|type = 民事判决书⏎|案号 = （2024）甲01民初' || o_orderkey || '号⏎|year = ⏎|month = ⏎|day = ⏎|loc = ⏎|docid = d' || o_orderkey || '⏎}}}}⏎'
  || {_pick([b for _, b in BODIES], _B)} || CASE WHEN {_pick([b for _, b in ENDS], _E)} = '' THEN '' ELSE CASE WHEN o_orderkey % 3 = 1 THEN '⏎' ELSE '⏎⏎' END || {_pick([b for _, b in ENDS], _E)} END
  || '⏎{{{{PD-PRC-exempt}}}}⏎', '⏎', chr(10)) AS content, NULL::VARCHAR AS error FROM orders""")
def page_rebuild(spark, sf_dir):
    k = F.col("k").cast("string")
    values = F.create_map(F.lit("title"), F.lit("甲案"), F.lit("court"), F.lit("甲市人民法院"), F.lit("type"), F.lit("民事判决书"), F.lit("案号"), F.concat(F.lit("（2024）甲01民初"), k, F.lit("号")), F.lit("docid"), F.concat(F.lit("d"), k))
    pages = _made(spark, sf_dir, OLD_PAGES).select(k.alias("title"), "content", values.alias("values"))
    return J.rebuild_pages(pages).select(F.col("title").cast("long").alias("k"), "content", "error")


_INTRO = ["{{gap}}文书内容⏎⏎甲法院⏎判决书⏎案号：(2024)甲1号⏎⏎余文", "无⏎余文", "{{gap}}文书内容⏎甲法院⏎⏎判决书", "{{gap}}文书内容⏎甲法院⏎判决书⏎（2024）甲1号"]
_HEADS = [("{{Header/裁判文书⏎|title = 甲案⏎|court = 旧⏎}}⏎", "{{Header/裁判文书⏎|title = [[甲案]]⏎|court = 甲法院⏎|type = 判决书⏎|案号 = （2024）甲1号⏎}}⏎"), ("{{Header/裁判文书⏎|title = [[甲案]]⏎|案号 =⏎}}⏎", "{{Header/裁判文书⏎|title = [[甲案]]⏎|案号 =（2024）甲1号⏎|court = 甲法院⏎|type = 判决书⏎}}⏎"), ("{{Header/裁判文书⏎|court = x⏎}}⏎", ""), ("", "")]
_PROBLEM = "CASE o_orderkey % 4 WHEN 1 THEN 'no introduction' WHEN 2 THEN '2 lines of introduction' ELSE CASE floor(o_orderkey / 4) % 4 WHEN 2 THEN 'no title' WHEN 3 THEN 'no header' END END"


@query("intro_split", f"""SELECT o_orderkey AS k, error, CASE WHEN error IS NULL THEN '甲法院' END AS court, CASE WHEN error IS NULL THEN '（2024）甲1号' END AS case_number,
  CASE WHEN error IS NULL THEN replace({_pick([b for _, b in _HEADS], 'floor(o_orderkey / 4)')} || CASE WHEN o_orderkey % 4 = 0 THEN '余文' ELSE '' END, '⏎', chr(10)) END AS content FROM (SELECT o_orderkey, {_PROBLEM} AS error FROM orders)""")
def intro_split(spark, sf_dir):
    pages = _made(spark, sf_dir, f"SELECT CAST(o_orderkey AS STRING) AS title, replace({_pick([a for a, _ in _HEADS], 'floor(o_orderkey / 4)')} || {_pick(_INTRO, 'o_orderkey')}, '⏎', chr(10)) AS content FROM orders")
    return J.split_intros(pages).select(F.col("title").cast("long").alias("k"), "error", "court", "case_number", "content")


_DATED = [("2023年民事判决书", "民事判决书", "2023", "民事判决书"), ("2024年中华人民共和国刑事裁定书", "中华人民共和国刑事裁定书", "2024", "刑事裁定书"), ("2024年令", "民事判决书", "", ""), ("令", "令", "", "")]
_LEGACY = f"""SELECT o_orderkey AS k, {_pick([d for d, _, _, _ in _DATED], 'o_orderkey')} AS dated, {_pick([t for _, t, _, _ in _DATED], 'o_orderkey')} AS undated, {_pick([y for _, _, y, _ in _DATED], 'o_orderkey')} AS year, {_pick([t for _, _, _, t in _DATED], 'o_orderkey')} AS kind,
  {_pick(['甲市人民法院', '无'], 'floor(o_orderkey / 4)')} AS court, {_pick(['{{versions', '{{Versions', '{{裁判文书消歧义页'], 'floor(o_orderkey / 8)')} AS open FROM orders"""


@query("legacy_lists", f"""SELECT k, replace('{{{{裁判文书消歧义页⏎ | title      = 甲案⏎ | court      = ' || court || '⏎ | type       = ' || kind || '⏎ | year       = ' || year || '⏎}}}}⏎* [[' || k || ']]⏎[[Category:其他]]⏎', '⏎', chr(10)) AS content
  FROM ({_LEGACY}) WHERE year <> '' AND court LIKE '%法院' AND lower(open) = '{{{{versions'""")
def legacy_lists(spark, sf_dir):
    rows = _made(spark, sf_dir, _LEGACY)
    line = lambda c: F.concat(F.lit("[[Category:"), F.col(c), F.lit("]]\n"))
    text = F.concat("open", F.lit("\n| title = 甲案\n| noauthor = x\n}}\n* [["), F.col("k").cast("string"), F.lit("]]\n"), line("dated"), line("undated"), F.lit("[[Category:其他]]\n"), line("court"))
    return J.convert_versions(rows.select(F.col("k").cast("string").alias("title"), text.alias("content"))).select(F.col("title").cast("long").alias("k"), "content")


@query("masked_lists", """SELECT o_orderkey AS k, '张××案' || o_orderkey AS clean_title, CASE o_orderkey % 5 WHEN 0 THEN 'moved' WHEN 1 THEN 'absorbed' WHEN 2 THEN 'case_title_exists' WHEN 3 THEN 'merged' ELSE 'destination_exists_unhandled' END AS outcome,
  CASE o_orderkey % 5 WHEN 3 THEN '* [[甲法院（2024）1号判决书]]' || chr(10) || '* [[甲法院（2024）2号判决书]]' || chr(10) WHEN 4 THEN NULL WHEN 2 THEN NULL ELSE '* [[甲法院（2024）2号判决书]]' || chr(10) END AS bullets FROM orders""")
def masked_lists(spark, sf_dir):
    """Lists under titles with raw masks, with nothing, a document, a list or something else under the clean title."""
    k = F.col("o_orderkey").cast("string")
    listed = lambda title, n: F.concat(F.lit("{{裁判文书消歧义页\n | title      = "), title, F.lit(f"\n | court      = 甲法院\n | type       = 判决书\n}}}}\n* [[甲法院（2024）{n}号判决书]]\n"))
    document = F.concat(F.lit("{{Header/裁判文书\n|title = x\n|court = 甲法院\n|type = 判决书\n|案号 = （2024）"), k, F.lit("号\n}}\n"))
    orders = table(spark, sf_dir, "orders", "o_orderkey").withColumn("kind", F.col("o_orderkey") % 5)
    clean = F.concat(F.lit("张××案"), k)
    sources = orders.select(F.concat(F.lit("张xx案"), k).alias("title"), listed(F.concat(F.lit("张xx案"), k), 2).alias("content"))
    there = orders.where("kind > 0").select(clean.alias("title"), F.when(F.col("kind") < 3, document).when(F.col("kind") == 3, listed(clean, 1)).otherwise("其他").alias("content"))
    cases = orders.where("kind = 2").select(F.concat(F.lit("甲法院（2024）"), k, F.lit("号判决书")).alias("title"), F.lit("x").alias("content"))
    found = J.merge_versions(sources.unionByName(there).unionByName(cases))
    return found.select(F.regexp_extract("clean_title", "案(\\d+)$", 1).cast("long").alias("k"), "clean_title", "outcome", F.regexp_extract("page_text", r"(?s)\}\}\n(.*)$", 1).alias("bullets"))


@query("resumed_convert", f"""WITH raw AS ({RAW}), r AS (SELECT doc_num, s1 <> '' AND qwContent <> '' AS ok FROM raw WHERE doc_num > 500 AND (s1 LIKE '%民事判决书' OR s1 LIKE '%决定书' OR s1 = '')),
  b AS (SELECT *, coalesce(sum(CAST(ok AS INT)) OVER (ORDER BY doc_num ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM r) SELECT doc_num, CASE WHEN NOT ok THEN 'field_extraction' END AS error_stage FROM b WHERE before < 150""")
def resumed_convert(spark, sf_dir):
    """The job with a filter of its own, behind what is done, up to its 150th success: the limit is the feature."""
    keep = T.glob_filter(F.col("s1"), "*民事判决书;*决定书") | (F.col("s1") == "")
    return C.convert_job(raw(spark, sf_dir), as_of=AS_OF, keep=keep, start_from=500, max_success=150).select("doc_num", "error_stage")


_LOG = """SELECT o_orderkey AS k, CASE o_orderkey % 6 WHEN 0 THEN '{"type": "create", "name": "p' || CAST(o_orderkey AS STRING) || '"}' WHEN 1 THEN '{"type": "move", "name": "p"}' WHEN 2 THEN '{broken' WHEN 3 THEN '' WHEN 4 THEN '[1, 2]' ELSE '  {"type": "create", "name": ""}' END AS value FROM orders"""


def _log(spark, sf_dir) -> str:
    """A log in many files that follow one another by name, in the order of the keys."""
    return _written(_made(spark, sf_dir, _LOG), "log")


def _written(rows, name: str) -> str:
    path = f"{shared_dir(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows.repartitionByRange(FILES, "k").sortWithinPartitions("k").select("value").write.text(path)
    return path


@query("log_rows", "SELECT row_number() OVER (ORDER BY o_orderkey) AS line, o_orderkey % 6 <> 2 AS valid, CASE WHEN o_orderkey % 6 = 2 THEN 'Invalid JSON' END AS message FROM orders QUALIFY o_orderkey % 6 IN (0, 1, 2, 5)")
def log_rows(spark, sf_dir):
    """A log with broken lines: these become failed rows, empty lines and values that are no objects go."""
    rows = cut(dumps.read_rows(spark, _log(spark, sf_dir)))
    return rows.select("line", "valid", F.get_json_object("value", "$.message").alias("message"))


@query("log_candidates", "SELECT row_number() OVER (ORDER BY o_orderkey) AS line, 'p' || o_orderkey AS name FROM orders QUALIFY o_orderkey % 6 = 0")
def log_candidates(spark, sf_dir):
    return cut(dumps.read_candidates(spark, _log(spark, sf_dir)))


@query("draft_slice", """WITH l AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders WHERE o_orderkey % 4 > 0)
  SELECT n AS ordinal, CASE WHEN o_orderkey % 4 < 3 THEN 'f' || o_orderkey END AS title, CASE WHEN o_orderkey % 4 < 3 THEN 'w' || o_orderkey END AS wenshu_id FROM l WHERE n BETWEEN 101 AND 300""")
def draft_slice(spark, sf_dir):
    """200 converted rows behind the first 100; empty lines don't count, broken ones do."""
    k = "CAST(o_orderkey AS STRING)"
    lines = f"""SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN ' ' WHEN 1 THEN '{{"title": "t", "final_title": "f' || {k} || '", "wenshu_id": "", "wenshuID": "w' || {k} || '"}}' WHEN 2 THEN '{{"title": "f' || {k} || '", "wenshu_id": "w' || {k} || '"}}' ELSE '{{broken' END AS value FROM orders"""
    path = _written(_made(spark, sf_dir, lines), "drafts")
    return cut(dumps.read_drafts(spark, path, skip=100, limit=200, overwrite=True).select("ordinal", "title", "wenshu_id"))


@query("conversion_outputs", f"WITH raw AS ({RAW}), r AS (SELECT *, s1 <> '' AND qwContent <> '' AS ok FROM raw) SELECT 'success' AS output, count(*) FILTER (ok) AS n, count(DISTINCT wsKey) FILTER (ok) AS ids FROM r UNION ALL SELECT 'errors', count(*) FILTER (NOT ok), count(DISTINCT wsKey) FILTER (NOT ok) FROM r UNION ALL SELECT 'original', count(*), count(DISTINCT wsKey) FROM r")
def conversion_outputs(spark, sf_dir):
    """Both outputs and the copy of the raw rows, written and read back as objects. Each is counted and then goes, with
    what was made to read it."""
    folder = f"{shared_dir(spark)}/convert-{uuid.uuid4().hex}"
    paths = {name: f"{folder}/{name}" for name in ("success", "errors", "original")}
    sinks.write_conversion(C.convert(raw(spark, sf_dir), as_of=AS_OF), paths["success"], paths["errors"], original=paths["original"], compression="gzip")
    key = {"success": "$.wenshu_id", "errors": "$.raw_json", "original": "$.wsKey"}
    at = lambda name: F.get_json_object(F.get_json_object("value", key[name]), "$.wsKey") if name == "errors" else F.get_json_object("value", key[name])
    parts = []
    for name, p in paths.items():
        with passing(spark):
            ids = dumps.read_json_objects(spark, p).select(at(name).alias("id"))
            parts.append(cut(ids.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids")).select(F.lit(name).alias("output"), "n", "ids")))
        delete(spark, p)
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


#: Courts that tell province and city, and courts that tell a city only.
_TEACH = ["四川省绵阳市中级人民法院", "广东省深圳市福田区人民法院", "云南省大理白族自治州中级人民法院", "内蒙古自治区锡林郭勒盟中级人民法院", "山东省青岛市中级人民法院", "北京市第一中级人民法院", "某某仲裁委"]
_ASK = [("绵阳市涪城区人民法院", "四川省绵阳市"), ("深圳铁路运输法院", "广东省深圳市"), ("青岛海事法院", "山东省青岛市"), ("锡林郭勒盟中级人民法院", "内蒙古自治区锡林郭勒盟"), ("鄂托克前旗人民法院", "内蒙古自治区"), ("上海市浦东新区人民法院", "上海市"), ("江西省南昌市红谷滩区人民法院", "江西省南昌市"), ("乙县人民法院", "")]


@query("learnt_places", f"""SELECT o_orderkey AS k, nullif({_pick([b for _, b in _ASK], 'o_orderkey')}, '') AS place, nullif({_pick(['四川省', '广东省', '山东省', '内蒙古自治区', '内蒙古自治区', '上海市', '江西省', ''], 'o_orderkey')}, '') AS province FROM orders""")
def learnt_places(spark, sf_dir):
    """Places of courts whose names don't tell the province, from a table that other courts' names teach."""
    taught = L.learn_places(_made(spark, sf_dir, f"SELECT {_pick(_TEACH, 'o_orderkey')} AS court FROM orders"), "court")
    cities = L.place_table(taught)
    court = F.col("court")
    asked = _made(spark, sf_dir, f"SELECT o_orderkey AS k, {_pick([a for a, _ in _ASK], 'o_orderkey')} AS court FROM orders")
    return asked.select("k", M.location_of_hierarchy(F.concat(court, F.lit("\n民事判决书")), cities).alias("place"), M.province(court, cities).alias("province"))


_SHOWN = [("{{gap}}文书内容'''北京市第一中级人民法院'''⏎民事判决书⏎", "北京市第一中级人民法院", "民事判决书"), ("{{gap}}乙县人民法院⏎", "乙县人民法院", ""), ("无⏎", "", "")]
_NUMBERED = [("（2023）京01民初5号", "（2023）京01民初5号"), ("合同编号（2020）甲字9号，本案(2023)京02民终7号之一", "（2023）京02民终7号之一"), ("账号（2021）第3号", ""), ("文" * 3000 + "（2022）京03执8号", "（2022）京03执8号"), ("", "")]


@query("text_inference", f"""SELECT o_orderkey AS k, {_pick([c for _, c, _ in _SHOWN], 'o_orderkey')} AS court, {_pick([t for _, _, t in _SHOWN], 'o_orderkey')} AS doc_type, {_pick([b for _, b in _NUMBERED], 'floor(o_orderkey / 3)')} AS case_number,
  {_pick(['2024', '2023', ''], 'floor(o_orderkey / 15)')} AS year FROM orders""")
def text_inference(spark, sf_dir):
    pages = _made(spark, sf_dir, f"SELECT o_orderkey AS k, replace({_pick([a for a, _, _ in _SHOWN], 'o_orderkey')} || {_pick([a for a, _ in _NUMBERED], 'floor(o_orderkey / 3)')} || '⏎' || {_pick(['二〇二三年五月六日⏎二〇二四年一月二日', '2023年3月8日', ''], 'floor(o_orderkey / 15)')}, '⏎', chr(10)) AS content FROM orders")
    return J.infer_from_text(pages).select("k", "court", "doc_type", "case_number", T.or_empty(F.col("date.year")).alias("year"))


#: Histories of customers' pages: ids in no order, every fifth edit made on the one before the last, every thirteenth lost.
_EDITS = """SELECT * FROM (SELECT o_custkey AS page, o_orderkey % 97 * 1000000 + o_orderkey AS revid,
    coalesce(CASE WHEN o_orderkey % 5 = 0 THEN lag(o_orderkey % 97 * 1000000 + o_orderkey, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) ELSE lag(o_orderkey % 97 * 1000000 + o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) END, 0) AS parentid
  FROM orders) AS e WHERE revid % 13 > 0"""


@query("parent_chains", f"""WITH RECURSIVE e AS ({_EDITS}), own AS (SELECT e.*, parentid > 0 AND up.revid IS NULL AS orphan, up.revid IS NULL AS first FROM e LEFT JOIN (SELECT revid FROM e) AS up ON up.revid = e.parentid),
  chain AS (SELECT revid, revid AS root, 1 AS depth FROM own WHERE first UNION ALL SELECT own.revid, chain.root, chain.depth + 1 FROM own JOIN chain ON own.parentid = chain.revid)
  SELECT page, revid, root, CAST(depth AS BIGINT) AS depth, (SELECT count(*) FROM e AS c WHERE c.parentid = own.revid) AS children, orphan FROM own JOIN chain USING (revid)""")
def parent_chains(spark, sf_dir):
    """Where each edit stands in its page's history, by the links between edits alone."""
    return history.parent_chains(_made(spark, sf_dir, _EDITS)).select("page", "revid", "root", "depth", "children", "orphan")


@query("movable_redirects", f"""WITH e AS ({_EDITS}), n AS (SELECT page, count(*) AS n FROM e GROUP BY page)
  SELECT c_custkey AS source, c_custkey + 1 AS target, coalesce(c_custkey % 3 > 0 AND n = 1, false) AND c_custkey < (SELECT max(c_custkey) FROM customer) AS movable FROM customer LEFT JOIN n ON page = c_custkey + 1""")
def movable_redirects(spark, sf_dir):
    """Moves of customers' pages to their neighbours, of which two in three redirect to them."""
    edits = _made(spark, sf_dir, _EDITS).select(F.col("page").cast("string").alias("title"))
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    before = (F.col("c_custkey") - 1).cast("string")
    pages = customers.select(F.col("c_custkey").cast("string").alias("title"), F.when((F.col("c_custkey") - 1) % 3 > 0, before).alias("redirect"))
    moves = customers.select(F.col("c_custkey").cast("string").alias("source"), (F.col("c_custkey") + 1).cast("string").alias("target"))
    found = history.movable(moves, pages, edits)
    return found.select(F.col("source").cast("long").alias("source"), F.col("target").cast("long").alias("target"), "movable")


@query("committed_runs", f"""WITH raw AS ({RAW}), r AS (SELECT *, s1 <> '' AND qwContent <> '' AS ok, CASE WHEN doc_num <= (SELECT max(doc_num) FROM raw) / 2 THEN 0 ELSE 1 END AS run FROM raw)
  SELECT run, CASE WHEN ok THEN 'success' ELSE 'errors' END AS output, count(*) AS n, count(DISTINCT wsKey) AS ids, (SELECT max(doc_num) FROM raw) AS last_doc_num FROM r GROUP BY run, ok""")
def committed_runs(spark, sf_dir):
    """The convert job in two runs, each with its outputs and totals committed together, and an attempt in between that
    stopped before its manifest."""
    root, rows = f"{shared_dir(spark)}/runs-{uuid.uuid4().hex}", raw(spark, sf_dir)
    half = rows.agg(F.max("doc_num")).first()[0] / 2
    commits.convert_run(rows.where(F.col("doc_num") <= half), root, as_of=AS_OF, compression="gzip")
    rows.select("wsKey").write.json(f"{root}/success/run-000000001-stopped")
    state = commits.convert_run(rows, root, as_of=AS_OF, compression="gzip")
    key = {"success": F.col("wenshu_id"), "errors": F.get_json_object("raw_json", "$.wsKey")}
    parts = [commits.read_committed(spark, root, n).select("run", F.lit(n).alias("output"), k.alias("id")) for n, k in key.items()]
    counts = parts[0].unionByName(parts[1]).groupBy("run", "output").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids"))
    return counts.withColumn("last_doc_num", F.lit(state["last_doc_num"]).cast("long"))


_DIRTY = f"SELECT k, CAST(k AS STRING) || ':' || replace(replace(x, chr(10), '/'), chr(13), '/') || CASE k % 3 WHEN 0 THEN chr(13) ELSE '' END AS value FROM ({TEXTS}) AS t"


@query("stripped_file", f"SELECT CAST(split_part(value, ':', 1) AS BIGINT) AS k, hex(encode(replace(replace(value, chr(8203), ''), chr(65279), ''))) AS bytes FROM ({_DIRTY}) AS d")
def stripped_file(spark, sf_dir):
    """Files of dirty lines, some of which end with a carriage return, read back as bytes when they are clean."""
    folder = f"{shared_dir(spark)}/strip-{uuid.uuid4().hex}"
    _made(spark, sf_dir, _DIRTY).repartitionByRange(4, "k").select("value").write.option("lineSep", "\n").text(f"{folder}/in")
    sources = spark.read.text(f"{folder}/in").inputFiles()
    for i, source in enumerate(sources):
        dumps.strip_file(spark, source, f"{folder}/out/{i}")
    lines = spark.read.option("lineSep", "\n").text([f"{folder}/out/{i}" for i in range(len(sources))])
    return lines.select(F.substring_index("value", ":", 1).cast("long").alias("k"), F.hex(F.col("value").cast("binary")).alias("bytes"))


@query("first_seen_stream", "SELECT CAST(o_custkey AS VARCHAR) AS title, min(o_orderkey) AS revid FROM orders WHERE o_custkey % 7 > 0 GROUP BY o_custkey UNION ALL SELECT NULL, o_orderkey FROM orders WHERE o_custkey % 7 = 0")
def first_seen_stream(spark, sf_dir):
    """A stream of edits, of each page the first; edits without a title stand for themselves."""
    folder = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    edits = _made(spark, sf_dir, "SELECT CASE WHEN o_custkey % 7 > 0 THEN CAST(o_custkey AS STRING) END AS title, o_orderkey AS revid FROM orders")
    edits.repartitionByRange(FILES, "revid").write.json(f"{folder}/in")
    first_wins_stream(spark, f"{folder}/in", "title string, revid long", f"{folder}/out", f"{folder}/state", key="title", order="revid", otherwise="revid").awaitTermination()
    return spark.read.parquet(f"{folder}/out")


_PLACES = "SELECT o_orderkey AS k, sum(octet_length(encode(value)) + 1) OVER (ORDER BY o_orderkey) - octet_length(encode(value)) - 1 AS bytes, row_number() OVER (ORDER BY o_orderkey) AS line, value FROM (SELECT o_orderkey, '{\"id\": ' || o_custkey || ', \"k\": ' || o_orderkey || ', \"张\": 1}' AS value FROM orders)"
_RECORDS = "SELECT o_orderkey AS k, '{\"id\": ' || CAST(o_custkey AS STRING) || ', \"k\": ' || CAST(o_orderkey AS STRING) || ', \"张\": 1}' AS value FROM orders"


@query("early_lines", f"""WITH p AS ({_PLACES}), m AS (SELECT max(k) AS m FROM p) SELECT q AS part, min(line) AS line, CAST(min(bytes) AS BIGINT) AS bytes, arg_min(value, k) AS value
  FROM p, m, (VALUES (0), (1), (3), (7)) AS t(q) WHERE k >= m * q // 8 AND k % 3 = 0 GROUP BY q""")
def early_lines(spark, sf_dir):
    """The first record at or behind some places of a log, found without reading what is behind; line and byte over all files."""
    path = _written(_made(spark, sf_dir, _RECORDS), "records")
    last, k = table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0], F.get_json_object("value", "$.k").cast("long")
    found = [(q, early.first_line(spark, path, (k >= last * q // 8) & (k % 3 == 0), first=2)) for q in (0, 1, 3, 7)]
    return spark.createDataFrame([(q, f.total_line, f.total_offset, f.value) for q, f in found if f], "part int, line long, bytes long, value string")


@query("early_ids", "SELECT o_custkey AS id, min(o_orderkey) AS k FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3) GROUP BY o_custkey")
def early_ids(spark, sf_dir):
    """Of each wanted customer the first record, in rounds that look for those not found yet."""
    path = _written(_made(spark, sf_dir, _RECORDS), "records")
    wanted = table(spark, sf_dir, "customer").where("c_nationkey = 3").select(F.col("c_custkey").alias("id"))
    found, _ = early.first_rows(spark, path, F.get_json_object("value", "$.id").cast("long"), wanted, first=2)
    return found.select("id", F.get_json_object("value", "$.k").cast("long").alias("k"))
