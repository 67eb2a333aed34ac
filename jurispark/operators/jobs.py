"""Maintenance jobs over tables of pages and logs. Each gives decisions and new texts; nothing is written to a wiki."""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jurispark.functions import metadata as M
from jurispark.functions import pages as P
from jurispark.functions import plain, rebuild
from jurispark.functions import text as T
from jurispark.functions import wiki as W
from jurispark.functions.chars import CITIES
from jurispark.operators.relational import anti_dedupe, first_tag, ordered_distinct, positional_join, union_ragged
from jurispark.sources.shared import spread


def case_redirects(records: DataFrame, pages: DataFrame) -> DataFrame:
    """records: line, title, wenshu_id; pages: title, content. Adds redirect_title, status and reason; of equal new
    redirects the first line's is made, later ones count as existing."""
    value = lambda k: W.header_value(F.col("block"), k)
    # the header is read once for each page, not for each of its values
    said = pages.select("title", W.header_block(F.col("content")).alias("block"))
    said = said.select("title", (F.col("block") != "").alias("header"), value("court").alias("court"), T.wide_parentheses(value("案号")).alias("number"), value("type").alias("kind"))
    known = said.select("title", F.lit(True).alias("there"), "header", F.when(F.col("header"), F.concat("court", "number", "kind")).alias("redirect_title"), F.expr("court = '' OR number = '' OR kind = ''").alias("empty"))
    rows = spread(records, records.count(), "title").join(known, "title", "left")
    early = F.when(F.col("there").isNull(), "source_page_missing").when(~F.col("header"), "header_missing").when(F.col("empty"), "required_metadata_missing").when(F.col("redirect_title") == F.col("title"), "redirect_title_matches_source_title")
    rows = rows.withColumn("early", early).withColumn("key", F.when(F.col("early").isNull(), F.col("redirect_title")))
    rows = anti_dedupe(rows, pages.select(F.col("title").alias("key")), "key", "line")
    reason = F.coalesce("early", F.when(F.col("outcome") != "new", "redirect_page_exists"))
    return rows.select("line", "title", "wenshu_id", "redirect_title", F.when(reason.isNull(), "would_create").otherwise("skipped").alias("status"), reason.alias("reason"), F.when(reason.isNull(), W.redirect_text(F.col("title"))).alias("redirect_text"))


def fix_years(titles: DataFrame, pages: DataFrame, *, as_of: int) -> DataFrame:
    """titles: title, category, seen. Header years that can't be right get the case number's year, else the signature's."""
    rows = first_tag(titles, "title", "category", "seen").join(pages.select("title", "content"), "title", "left")
    h = W.header(F.col("content"))
    rows = rows.withColumn("current", h["year"]).withColumn("has_header", h.isNotNull()).withColumn("has_year", F.coalesce(F.map_contains_key(h, "year"), F.lit(False)))
    signature = F.regexp_extract(T.or_empty(F.col("content")), r"(?s)\{\{裁判文书署名.*?\}\}", 0)
    signed = F.coalesce(M.valid_date(M.date_of_text(signature), as_of)["year"])
    rows = rows.withColumn("inferred", F.coalesce(M.year_of_case_number(h["案号"], as_of), signed))
    reason = F.when(~F.coalesce("has_header", F.lit(False)), "missing_header").when(~F.col("has_year"), "missing_year_field").when(M.valid_year(F.col("current"), as_of), "current_year_already_valid").when(F.col("inferred").isNull(), "no_valid_case_number_year")
    text = F.regexp_replace("content", F.lit(r"(?im)\A((?s:.*?)^\s*\|\s*year\s*=[^\S\n]*)[^\n]*"), F.concat(F.lit("$1"), F.col("inferred")))
    return rows.select("title", "category", F.when(reason.isNull(), "fix").otherwise("skip").alias("action"), reason.alias("reason"), F.col("current").alias("current_year"), F.when(reason.isNull(), F.col("inferred")).alias("inferred_year"), F.when(reason.isNull(), text).alias("content"))


def fix_categories(pages: DataFrame) -> DataFrame:
    return pages.withColumn("fixed", W.fix_country_categories(F.col("content"))).where(F.col("fixed") != T.or_empty(F.col("content")))


def strip_invisible(pages: DataFrame) -> DataFrame:
    """Pages that lose invisible characters, with their new text."""
    return pages.withColumn("fixed", T.drop_invisible(F.col("content"))).where(F.col("fixed") != F.col("content"))


def invisible_histogram(pages: DataFrame, column: str = "content") -> DataFrame:
    """How often each invisible character occurs, by code point. Only these characters leave the scan."""
    chars = F.filter(F.split(T.or_empty(F.col(column)), ""), lambda c: (c != "") & (T.drop_invisible(c) == ""))
    return pages.where(T.drop_invisible(F.col(column)) != F.col(column)).select(F.explode(chars).alias("char")).groupBy("char").agg(F.count(F.lit(1)).alias("n")).select(F.conv(F.hex(F.encode("char", "UTF-32")), 16, 10).cast("int").alias("codepoint"), "n")


def export_edits(contributions: DataFrame, moves: DataFrame, user: str, since, until) -> DataFrame:
    """contributions: user, ts, title, is_new; moves: user, ts, title, target. One log in the order of time, type and name."""
    window = lambda df: df.where((F.col("user") == user) & (F.col("ts") >= since) & (F.col("ts") < until)) if user else df.where((F.col("ts") >= since) & (F.col("ts") < until))
    a = window(contributions).select("ts", F.when(F.col("is_new"), "create").otherwise("normal edit").alias("type"), F.col("title").alias("name"))
    b = window(moves).select("ts", F.lit("move").alias("type"), F.col("title").alias("name"), F.col("target").alias("target_name"))
    return union_ragged(a, b).orderBy("ts", "type", "name")


#: Names of one logical field, in the order in which they are tried, and places in which they are looked for. Fixed values.
ALIASES = {
    "title": ("title", "case_title", "final_title", "page_title", "s1"),
    "court": ("court", "court_name", "courtName", "noauthor", "s2"),
    "doc_type": ("doc_type", "doctype", "docType", "document_type", "type"),
    "case_number": ("doc_id", "case_number", "caseNumber", "case_no", "caseNo", "案号", "s7"),
    "docid": ("docid", "wenshu_id", "wenshuID", "wenshuId", "wsKey", "wskey", "docId", "docID"),
}
CONTAINERS = ("data", "document", "doc", "metadata", "page_metadata", "header", "raw_json")


def record_metadata(records: DataFrame, column: str = "value") -> DataFrame:
    """Every logical field's values of a JSON row: at the top and in known containers, then in its wikitext's header,
    then what an original row's hierarchy tells."""
    # a row is parsed for the names that stand in it only; one with escapes may have any name
    said = lambda name: F.contains(F.col(column), F.lit(name)) | F.contains(F.col(column), F.lit("\\"))
    value = lambda path, name: F.when(said(name), F.get_json_object(column, path))
    none = F.array().cast("array<string>")
    inner = lambda c, names: F.when(said(c), F.array(*[value(f"$['{c}']['{a}']", a) for a in names])).otherwise(none)
    at = lambda names: F.concat(F.array(*[value(f"$['{a}']", a) for a in names]), *[inner(c, names) for c in CONTAINERS])
    rows = records.withColumns({f: ordered_distinct(at(names)) for f, names in ALIASES.items()})
    rows = rows.withColumn("__h", W.header(F.get(F.array_compact(at(("wikitext", "wiki_text", "text", "content"))), 0)))
    inside = {"title": ["title"], "court": ["court"], "doc_type": ["type"], "case_number": ["案号"]}
    rows = rows.withColumns({f: ordered_distinct(F.concat(f, F.array(*[F.col("__h")[k] for k in keys]))) for f, keys in inside.items()})
    ids = F.map_values(F.map_filter(F.coalesce("__h", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))), lambda k, _: F.lower(k).startswith("docid")))
    rows = rows.withColumn("docid", ordered_distinct(F.concat("docid", ids))).withColumn("__s", F.get_json_object(column, "$.s22"))
    first = lambda f: T.or_empty(F.when(F.size(f) > 0, F.get(F.col(f), 0)))
    one = lambda c: F.filter(F.array(c), lambda v: v.isNotNull() & (v != ""))
    rows = rows.withColumn("case_number", F.when((F.size("case_number") == 0) & F.col("__s").isNotNull(), one(M.case_number(F.col("__s")))).otherwise(F.col("case_number")))
    parts = F.filter(F.transform(F.split(T.or_empty(F.col("__s")), r"[\r\n]+"), lambda p: M.doc_type(F.replace(F.replace(p, first("court")), first("case_number")))), lambda p: p != "")
    rows = rows.withColumn("doc_type", F.when((F.size("doc_type") == 0) & (F.size(parts) > 0), F.slice(parts, 1, 1)).otherwise(F.col("doc_type")))
    return rows.drop("__h", "__s")


def _any_matches(field: str, pattern: str):
    return F.exists(field, lambda v: v.rlike(pattern))


def search_records(records: DataFrame, criteria: dict[str, str], docid: str | None = None) -> DataFrame:
    """Rows where each named field has a value in which its pattern is found, and the id is among the ids."""
    rows = record_metadata(records)
    for field, pattern in criteria.items():
        rows = rows.where(_any_matches(field, pattern))
    return rows.where(F.array_contains("docid", docid)) if docid is not None else rows


def _texts(df: DataFrame, rule, schema: str, columns: list[str]) -> DataFrame:
    """Rows through a rule on strings that gives a tuple, or None to leave a row out."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        for b in batches:
            yield pd.DataFrame([r for r in map(rule, *(b[c] for c in columns)) if r is not None], columns=names)

    return df.select(columns).mapInPandas(run, schema)


def convert_versions(pages: DataFrame) -> DataFrame:
    """Legacy lists with a dated type, its type and a court among their categories become disambiguation pages."""

    def rule(title, text):
        span = P.template_span(text or "", "versions")
        if not span or "法院]]" not in text:
            return None
        found = [m[1].strip() for s in text.splitlines() if (m := P.CATEGORY.match(s))]
        dated = [(m[1], m[2], c) for c in found if (m := P.DATED.match(c))]
        courts = [c for c in found if c.endswith("法院") and not P.DATED.match(c)]
        hit = next(((y, k, c, t) for y, k, c in dated for t in ("中华人民共和国" + k, k) if t in found), None)
        if not hit or not courts:
            return None
        year, kind, dated_category, type_category = hit
        params = {m[1].strip().lower(): m[2].strip() for s in text[span[0] : span[1]].splitlines() if (m := re.match(r"^\s*\|\s*([^=]+?)\s*=(.*)$", s))}
        head = "\n".join(["{{裁判文书消歧义页", f" | title      = {params.get('title') or title}", f" | court      = {courts[0]}", f" | type       = {kind}", f" | year       = {year}", "}}"])
        gone = {dated_category, type_category, courts[0]}
        lines = [s for s in (text[: span[0]] + head + text[span[1] :]).splitlines(keepends=True) if not ((m := P.CATEGORY.match(s.rstrip("\r\n"))) and m[1].strip() in gone)]
        out = "".join(lines).rstrip() + "\n"
        return None if out == text else (title, out)

    return _texts(pages, rule, "title string, content string", ["title", "content"])


def merge_versions(pages: DataFrame) -> DataFrame:
    """Disambiguation pages whose title has raw masks: moved to the clean title, merged into the page there, or, where a
    document stands there, put in its place once that has moved to its case title."""
    wanted = pages.withColumn("clean", T.mark_title_redactions(F.col("title"))).where((F.col("clean") != F.col("title")) & W.is_disambiguation(F.col("content")))
    there = pages.select(F.col("title").alias("clean"), F.col("content").alias("there"))
    rows = wanted.join(there, "clean", "left").withColumn("case_title", W.page_case_title(F.col("there")))
    known = pages.select(F.col("title").alias("case_title"), F.lit(True).alias("taken"))
    rows = rows.join(known, "case_title", "left").withColumn("taken", F.coalesce("taken", F.lit(False)).cast("string"))

    def named(text, title):
        return re.sub(r"(?m)^(\s*\|\s*title\s*=\s*).*$", lambda m: m[1] + title, text, count=1)

    def rule(title, clean, text, there, case, taken):
        if there is None:
            return title, clean, "moved", named(text, clean), None
        if case:
            return (title, clean, "case_title_exists", None, None) if taken == "true" else (title, clean, "absorbed", named(text, clean), P.replace_link(there, clean))
        if not P.is_disambiguation(there):
            return title, clean, "destination_exists_unhandled", None, None
        found = [m[2].strip() for s in text.splitlines() if (m := P.ENTRY.match(s)) and len(m[1]) == 1]
        if not found:
            return title, clean, "source_versions_has_no_entries", None, None
        merged = there
        for entry in found:
            merged = P.add_entry(merged, entry)
        tagged = text if text.lstrip().lower().startswith("{{sdelete|1=author's request}}") else "{{Sdelete|1=Author's request}}\n" + text
        return title, clean, "merged", named(merged, clean), tagged

    return _texts(rows, rule, "title string, clean_title string, outcome string, page_text string, other_text string", ["title", "clean", "content", "there", "case_title", "taken"])


def reconcile(old: DataFrame, new: DataFrame, pages: DataFrame, order: str = "line") -> DataFrame:
    """Two versions of a dump, row by row: line, title, court, doc_id, doc_type, wikitext. What to do about titles that
    changed, and landing pages whose masks are to be written anew."""
    pairs = positional_join(old, new, order).withColumn("redirect_title", F.concat(T.strip(T.or_empty(F.col("new_court"))), T.wide_parentheses(T.strip(T.or_empty(F.col("new_doc_id")))), T.strip(T.or_empty(F.col("new_doc_type")))))
    page = lambda key, out: pages.select(F.col("title").alias(key), F.col("content").alias(out))
    rows = pairs.join(page("redirect_title", "case_text"), "redirect_title", "left").withColumn("landing", W.redirect_target(F.col("case_text")))
    rows = rows.join(page("landing", "landing_text"), "landing", "left").join(page("title", "old_text"), "title", "left")
    renamed, edited = F.col("title") != F.col("new_title"), T.or_empty(F.col("wikitext")) != T.or_empty(F.col("new_wikitext"))
    rows = rows.withColumn("clean_old", T.mark_title_redactions(F.col("title"))).withColumn("clean_landing", T.mark_title_redactions(F.col("landing")))
    at_old = renamed & F.col("landing").isin(F.col("title"), F.col("clean_old"))
    desired = F.when(at_old, F.col("new_title")).when(F.col("clean_landing") != F.col("landing"), F.col("clean_landing"))
    rows = rows.withColumn("desired", desired)
    is_page = F.col("case_text").isNotNull() & F.col("landing").isNull()
    case = (
        F.when(T.blank(F.col("title")) | T.blank(F.col("new_title")), "invalid")
        .when(~renamed & ~edited, "unchanged")
        .when(F.col("desired").isNotNull(), "1.1")
        .when(renamed & F.col("landing").isNotNull(), "landing_title_unexpected")
        .when(renamed & is_page & F.col("old_text").isNull(), "old_title_page_missing")
        .when(renamed & is_page & W.redirect_target(F.col("old_text")).isNotNull(), "1.2.2")
        .when(renamed & is_page & F.contains(T.or_empty(F.col("old_text")), F.lit("{{Versions")), "1.2.1")
        .when(renamed & is_page, "old_title_page_not_versions_or_redirect")
        .when(renamed, "redirect_page_missing")
        .otherwise("text_only")
    )
    rows = rows.withColumn("case", case)
    moved_from = F.when((F.col("case") == "1.1") & (F.col("landing") != F.col("desired")), F.col("landing")).when(F.col("case") == "1.2.1", F.col("title"))
    moved_to = F.when(F.col("case") == "1.1", F.col("desired")).when(F.col("case") == "1.2.1", F.col("new_title"))
    body = F.when(F.col("landing").isNotNull(), F.col("landing_text")).when(renamed & is_page, F.col("case_text"))
    marked = T.merge_redactions(T.mark_redactions(body))
    text = F.when(edited & (marked != body), marked)
    return rows.select("position", "title", "new_title", "redirect_title", "case", F.when(moved_from.isNotNull(), moved_from).alias("move_from"), F.when(moved_from.isNotNull(), moved_to).alias("move_to"), F.coalesce("desired", "landing", F.when(is_page, F.col("redirect_title"))).alias("landing_title"), text.alias("marked_text"))


def unified_diff(df: DataFrame, before: str, after: str, key: str) -> DataFrame:
    """A readable diff of two texts; empty for equal ones."""

    def rule(k, a, b):
        a, b = plain.same_lines(a), plain.same_lines(b)
        return k, "" if a == b else "\n".join(difflib.unified_diff(a.split("\n"), b.split("\n"), "before", "after", lineterm=""))

    return _texts(df, rule, f"{key} string, diff string", [key, before, after])


def rescued_drafts(revisions: DataFrame, *, prefix: str = "Imported from 裁判文书网") -> DataFrame:
    """revisions: title, revid, parentid, comment, text. Imports that stand in a page's history under an id other than the
    page's, the first of each id, as drafts of the upload plan: its walk then gives each a page of its own and lists them."""
    rows = revisions.withColumn("docid", T.or_empty(W.header(F.col("text"))["docid"]))
    current = rows.groupBy("title").agg(F.max_by("docid", "revid").alias("own"))
    found = rows.where(F.startswith("comment", F.lit(prefix)) & (F.col("parentid") != 0) & (F.col("docid") != "")).join(current, "title").where("docid <> own")
    first = found.groupBy("title", "docid").agg(F.min_by(F.struct("revid", "text"), F.col("revid")).alias("r"))
    return first.select(F.col("r.revid").alias("ordinal"), "title", F.col("docid").alias("wenshu_id"), F.col("r.text").alias("wikitext"))


#: What a number may belong to that is no case number, and how far before or behind it that is looked for. Fixed values.
OTHER_NUMBERS, NEAR = ("车架号", "房产证号", "发票号", "账号", "合同编号", "身份证号", "统一社会信用代码"), 10
_BEHIND = "|".join(rf"{w}[\s\S]{{0,{NEAR - len(w)}}}" for w in OTHER_NUMBERS)
_AHEAD = "|".join(rf"[\s\S]{{0,{NEAR - len(w)}}}{w}" for w in OTHER_NUMBERS)
#: What is cheap to see is asked first: a parenthesis with a year, then what stands before it.
_CASE = rf"(?=[（(]20\d{{2}}[）)])(?<!(?:{_BEHIND}))((?>[（(]20\d{{2}}[）)](?:(?!{'|'.join(OTHER_NUMBERS)})[^，。；：:\s\n]){{1,35}}?号(?:之[一二三四五六七八九十百千万〇零○]+)?))(?!{_AHEAD})"


def infer_from_text(pages: DataFrame, *, cities=CITIES) -> DataFrame:
    """Court, case number, type, date and place of pages without header, from the start of their visible text: the court
    from 2000 characters, the type from 1000, the number from 4000, but for numbers of other things, the date from the
    last date there is."""
    parted = F.regexp_replace(T.or_empty(F.col("content")), r"\{\{gap\}\}|文书内容", "\n")
    shown = F.regexp_replace(F.regexp_replace(parted, r"\{\{[^{}]*\}\}|<[^<>]*>|'''?", ""), r"\[\[(?:[^\]|]*\|)?([^\]]*)\]\]", "$1")
    # long runs of Han characters are gone through for what is there only: no pattern without its last word
    ending = lambda text, words, pattern: F.when(text.rlike(words), F.regexp_extract(text, pattern, 1)).otherwise(F.when(text.isNotNull(), ""))
    rows = pages.withColumn("shown", shown).withColumn("head", F.substring("shown", 1, 2000))
    rows = rows.withColumn("court", M.court_name(ending(F.col("head"), "法院", r"([一-鿿]{2,30}?法院)"))).withColumn("case_number", M.case_number(F.regexp_extract(F.substring("shown", 1, 4000), _CASE, 1)))
    rows = rows.withColumn("doc_type", ending(F.substring("shown", 1, 1000), "裁定书|判决书|决定书|通知书|调解书", r"([一-鿿]{0,8}(?:裁定书|判决书|决定书|通知书|调解书))"))
    dates = F.regexp_extract_all("shown", F.lit(r"([〇零一二三四五六七八九]{4}年[一二三四五六七八九十]+月[一二三四五六七八九十]+日|\d{4}年\d{1,2}月\d{1,2}日)"), F.lit(1))
    rows = rows.withColumn("date", M.date_of_text(F.when(F.size(dates) > 0, F.element_at(dates, -1))))
    return rows.withColumn("place", M.location(F.col("court"), cities)).drop("shown", "head")


def rebuild_pages(pages: DataFrame, *, drop_intro: bool = True) -> DataFrame:
    """pages: title, content, values (a map of header parameters). title, content in its new form, and error for pages that
    can't be rebuilt (content is null then)."""

    def rule(title, content, values):
        try:
            return title, rebuild.rebuild_page(content, dict(values or {}), drop_intro=drop_intro), None
        except ValueError as e:
            return title, None, str(e)

    return _texts(pages, rule, "title string, content string, error string", ["title", "content", "values"])


def split_intros(pages: DataFrame) -> DataFrame:
    """pages: title, content. Pages with an introduction below its marker: the text without it, with court, type and number
    in the header and a linked title; error where that can't be told."""

    def rule(title, content):
        try:
            text, values = rebuild.take_intro(content or "")
            return title, values["court"], values["type"], values["案号"], rebuild.set_params(text, values, link_title=True), None
        except ValueError as e:
            return title, None, None, None, None, str(e)

    return _texts(pages, rule, "title string, court string, doc_type string, case_number string, content string, error string", ["title", "content"])
