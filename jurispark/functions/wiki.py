"""Wiki pages as column expressions: templates, links, redirects, disambiguation entries, quality scores."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from jurispark.functions.chars import HAN, MARKERS, PARTY, SPACE, SPACES
from jurispark.functions.metadata import case_number, case_title, court_name, doc_type
from jurispark.functions.text import let, masked_runs, or_empty, rstrip, same_lines, strip, templates_to_crosses, title_score

#: Template names in lower case, and the category of redirects. Fixed values.
HEADER, DISAMBIGUATION, LEGACY = "{{header/裁判文书", "{{裁判文书消歧义页", "{{versions"
REDIRECT_CATEGORY = "中华人民共和国法院裁判文书案号重定向"
REVIEW_CATEGORY = "覆盖版本未检查的裁判文书"
REVIEW = rf"(?i)\[\[\s*(?:Category|分类|分類)\s*:\s*{REVIEW_CATEGORY}(?:\|[^\]\n]*)?\]\]"
_GAP = r"[^\S\n]*"


def lines(text: Column) -> Column:
    return F.split(or_empty(text), r"\r\n|[\n\x0B\f\r\x1c-\x1e\x85\u2028\u2029]", -1)


def starts(text: Column, *names: str) -> Column:
    return reduce(or_, (F.startswith(text, F.lit(n)) for n in names))


def template(text: Column, *names: str) -> Column:
    """Parameters of the first template with one of the names, one on each line, up to a line ``}}``; of equal keys the
    last counts. Null without the template or its end."""
    def behind(stripped: Column) -> Column:
        start = F.array_position(F.transform(stripped, lambda s: starts(F.lower(s), *names)), True)
        return let(start, lambda at: F.when(at > 0, F.slice(stripped, at.cast("int") + 1, F.size(stripped))))

    def pairs(rest: Column) -> Column:
        inside = let(F.array_position(rest, "}}"), lambda end: F.when(end > 0, F.slice(rest, F.lit(1), end.cast("int") - 1)))
        return F.transform(F.filter(inside, lambda s: F.startswith(s, F.lit("|")) & F.contains(s, F.lit("="))), lambda s: F.struct(strip(F.substring(F.substring_index(s, "=", 1), F.lit(2), F.length(s))).alias("key"), strip(F.substring(s, F.instr(s, "=") + 1, F.length(s))).alias("value")))

    def last(found: Column) -> Column:
        return F.map_from_entries(F.filter(found, lambda p, i: ~F.exists(F.slice(found, i + 2, F.size(found)), lambda q: q["key"] == p["key"])))

    return let(let(let(F.transform(lines(text), strip), behind), pairs), last)


def header(text: Column) -> Column:
    return template(text, HEADER)


#: What ends a line, and white space inside one.
_BREAK, _BLANK = r"\n\x0B\f\r\x1c\x1d\x1e\x85\u2028-\u2029", r"\t\x1f \xa0\u1680\u2000-\u200a\u202f\u205f\u3000"
_BLOCK = rf"\A(?>(?s:.*?)(?:\A|[{_BREAK}])[{_BLANK}]*+(?i:{HEADER.replace('{', chr(92) + '{')}))((?s:.*?)[{_BREAK}])[{_BLANK}]*+\}}\}}[{_BLANK}]*+(?:\z|[{_BREAK}])"


def header_block(text: Column) -> Column:
    """The lines of the header between its name and its end, each behind a line feed and without blanks in front, for
    ``header_value``; empty where ``header`` is null. Keep it in a column of its own."""
    return F.regexp_replace(F.regexp_extract(or_empty(text), _BLOCK, 1), rf"[{_BREAK}][{_BLANK}]*+", "\n")


def header_value(block: Column, key: str) -> Column:
    """``header(text)[key]`` from the header's block, empty where it is missing: for a few keys this takes a fraction of
    what a map of all of them does."""
    return strip(F.regexp_extract(block, rf"\A(?s:.*)\n\|[{_BLANK}]*+{key}[{_BLANK}]*+=([^\n]*)", 1))


def disambiguation(text: Column) -> Column:
    return template(text, DISAMBIGUATION, LEGACY)


def page_case_title(text: Column) -> Column:
    return let(header(text), lambda h: case_title(h["court"], h["案号"], h["type"]))


def page_case_number(text: Column) -> Column:
    number = case_number(header(text)["案号"])
    return F.when(number != "", number)


def is_document(text: Column) -> Column:
    return F.coalesce(page_case_title(text).isNotNull(), F.lit(False))


def _starts(text: Column, *names: str) -> Column:
    return let(F.lower(F.substring(F.ltrim(or_empty(text), F.lit(SPACES)), 1, 2 * max(map(len, names)))), lambda t: starts(t, *names))


def is_disambiguation(text: Column) -> Column:
    return _starts(text, DISAMBIGUATION, LEGACY)


def is_legacy(text: Column) -> Column:
    return _starts(text, LEGACY)


def page_kind(text: Column) -> Column:
    return F.when(is_document(text), "header").when(is_disambiguation(text), "versions").otherwise("other")


def redirect_target(text: Column) -> Column:
    target = strip(F.regexp_extract(or_empty(text), r"(?im)^\s*#redirect\s*\[\[([^\]]+)\]\]", 1))
    return F.when(target != "", target)


def redirect_text(title: Column) -> Column:
    return F.concat(F.lit("#REDIRECT [["), title, F.lit(f"]]\n\n[[Category:{REDIRECT_CATEGORY}]]\n"))


def has_official_redaction(text: Column) -> Column:
    return or_empty(text).rlike(r"\{\{PRC-redact\|\d+\|os=yes\}\}")


_ENTRY = rf"(?m)^{_GAP}\*+{_GAP}\[\[([^\]|\n]+)(?:\|[^\]\n]*)?\]\]"


def entries(text: Column) -> Column:
    """Titles that bullets of any depth link to."""
    return F.transform(F.regexp_extract_all(or_empty(text), F.lit(_ENTRY), F.lit(1)), strip)


def has_nested_entries(text: Column) -> Column:
    return or_empty(text).rlike(rf"(?m)^{_GAP}\*\*+{_GAP}\[\[[^\]|\n]+(?:\|[^\]\n]*)?\]\]")


def sort_key(title: Column) -> Column:
    """Text before the case number, the number, text behind it; then the title, so that no two are equal."""
    pattern = r"(?s)^(.*?)(\d+)号(.*)$"
    part = lambda i: F.regexp_extract(title, pattern, i)
    found = title.rlike(pattern)
    return F.struct(
        F.when(found, part(1)).otherwise(title).alias("before"),
        F.when(found, part(2).cast("decimal(38,0)")).otherwise(F.lit(-1).cast("decimal(38,0)")).alias("number"),
        F.when(found, part(3)).otherwise("").alias("behind"),
        title.alias("title"),
    )


def sort_entries(titles: Column) -> Column:
    """Distinct titles in the natural order of case numbers."""
    return F.transform(F.array_sort(F.transform(F.array_distinct(titles), sort_key)), lambda k: k["title"])


def same_case_entry(titles: Column, title: Column) -> Column:
    """The first entry with the case number of a title; null without one."""
    wanted = case_number(title)
    found = F.filter(titles, lambda t: case_number(t) == wanted)
    return F.when((wanted != "") & (F.size(found) > 0), F.get(found, 0))


def grouped_entries(text: Column, court: Column | None = None) -> Column:
    """(court, title) of every entry; a court's heading holds until the next one."""
    none = F.array().cast("array<struct<court:string,title:string>>")
    start = F.struct((court if court is not None else F.lit("")).cast("string").alias("court"), none.alias("out"))

    def step(state: Column, line: Column) -> Column:
        heading = F.regexp_extract(line, rf"^[{SPACE}]*==[{SPACE}]*(.*?)[{SPACE}]*==[{SPACE}]*$", 1)
        is_heading = line.rlike(rf"^[{SPACE}]*==.*==[{SPACE}]*$")
        entry = strip(F.regexp_extract(line, rf"^[{SPACE}]*\*+[{SPACE}]*\[\[([^\]|]+)(?:\|[^\]]*)?\]\]", 1))
        one = F.array(F.struct(state["court"].alias("court"), entry.alias("title")))
        return F.struct(F.when(is_heading, heading).otherwise(state["court"]).alias("court"), F.when(~is_heading & (entry != ""), F.concat(state["out"], one)).otherwise(state["out"]).alias("out"))

    return F.aggregate(lines(text), start, step, lambda s: s["out"])


def categories(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(or_empty(text), F.lit(rf"(?im)^{_GAP}\[\[\s*(?:Category|分类|分類)\s*:\s*([^\]\|\n]+)(?:\|[^\]\n]*)?\]\]{_GAP}$"), F.lit(1)), strip)


def year_and_type(text: Column) -> Column:
    """Year and type of a dated category whose undated one is there as well; the first by code point."""
    every = F.array_distinct(categories(text))
    pattern = r"^(\d{4})年(?:中华人民共和国)?(.+)$"
    dated = F.filter(F.array_sort(every), lambda c: c.rlike(pattern) & (F.array_contains(every, F.regexp_extract(c, pattern, 2)) | F.array_contains(every, F.concat(F.lit("中华人民共和国"), F.regexp_extract(c, pattern, 2)))))
    first = F.get(dated, 0)
    return F.when(F.size(dated) > 0, F.struct(F.regexp_extract(first, pattern, 1).alias("year"), F.regexp_extract(first, pattern, 2).alias("type")))


def shown_title(value: Column) -> Column:
    """What a title parameter shows: the label of a link, else its target, else the value."""
    value = strip(or_empty(value))
    pattern = rf"^[{SPACE}]*\[\[([^\]|]+)(?:\|([^\]]+))?\]\][{SPACE}]*$"
    label = F.regexp_extract(value, pattern, 2)
    return F.when(value.rlike(pattern), strip(F.when(label != "", label).otherwise(F.regexp_extract(value, pattern, 1)))).otherwise(value)


def literal(value: Column) -> Column:
    """A value as the replacement of a regular expression."""
    return F.regexp_replace(value, r"([\\$])", r"\\$1")


def replace_title(text: Column, value: Column) -> Column:
    """The first title parameter gets a new value."""
    return F.regexp_replace(text, F.lit(r"(?im)\A((?s:.*?)^\s*\|\s*title\s*=[^\S\n]*)[^\n]*"), F.concat(F.lit("$1"), literal(value)))


def link_title(text: Column) -> Column:
    """The first title parameter becomes a link, unless it is one."""
    return F.regexp_replace(text, r"\A((?s:.*?))\|\s*title\s*=[^\S\n]*+(?!\[\[)([^\n|]*?)[^\S\n]*(?=\n|\||\z)", r"$1|title = [[$2]]")


def versions_page(title: Column, court: Column, titles: Column, kind: Column) -> Column:
    """A disambiguation page of one court."""
    bullets = F.array_join(F.transform(sort_entries(titles), lambda t: F.concat(F.lit("* [["), t, F.lit("]]"))), "\n")
    return F.concat(F.lit("{{裁判文书消歧义页\n | title      = "), title, F.lit("\n | court      = "), court, F.lit("\n | type       = "), kind, F.lit("\n}}\n"), bullets, F.lit("\n"))


def without_review(text: Column) -> Column:
    return F.regexp_replace(or_empty(text), REVIEW, "")


def with_review(text: Column) -> Column:
    """With the category that asks for a review, unless it is there."""
    return F.when(or_empty(text).rlike(REVIEW), text).otherwise(F.concat(rstrip(or_empty(text)), F.lit(f"\n[[Category:{REVIEW_CATEGORY}]]\n")))


def without_bookkeeping(text: Column) -> Column:
    """Without source ids and the review category, which alone make no revision."""
    plain = F.regexp_replace(without_review(text), r"\r\n?", "\n")
    kept = F.array_join(F.filter(F.split(plain, "\n", -1), lambda s: ~s.rlike(r"(?i)^\s*\|\s*docid\d*\s*=")), "\n")
    return same_lines(F.regexp_replace(kept, r"\n{3,}", "\n\n"))


# Quality: the more, the worse. Weights and patterns are fixed values.


def _without_title_line(text: Column) -> Column:
    """Comparison form without the header's title line."""
    return F.array_join(_in_header(text, lambda s: ~s.rlike(r"^\s*\|\s*title\s*="), F.filter), "\n")


def _in_header(text: Column, rule, over) -> Column:
    """The lines, with those of the header through a rule: ``over`` is filter or transform."""
    opens = r"(?i)^\s*\{\{\s*header/裁判文书(?U:\b)"

    def bounds(found: Column) -> Column:
        start = F.array_position(F.transform(found, lambda s: s.rlike(opens)), True).cast("int")
        end = let(start, lambda a: F.when(a > 0, F.array_position(F.transform(F.slice(found, a + 1, F.size(found)), strip), "}}").cast("int")))
        return F.struct(start.alias("start"), end.alias("end"))

    def walk(found: Column) -> Column:
        def marked(b: Column) -> Column:
            inside = lambda i: F.coalesce((b["end"] > 0) & (i + 1 >= b["start"]) & (i + 1 <= b["start"] + b["end"]), F.lit(False))
            if over is F.filter:
                return F.filter(found, lambda s, i: ~inside(i) | rule(s))
            return F.transform(found, lambda s, i: F.when(inside(i), rule(s)).otherwise(s))

        return let(bounds(found), marked)

    return let(F.split(same_lines(text), "\n", -1), walk)


def redaction_penalty(text: Column) -> Column:
    """Raw masks, masks split over text and template, malformed templates."""

    def score(body: Column) -> Column:
        count = lambda p: F.regexp_count(body, F.lit(p))
        return F.size(masked_runs(body)) + 3 * count(rf"\{{\{{PRC-redact\|\d+\}}\}}[{MARKERS}]+") + 3 * count(rf"[{MARKERS}]+\{{\{{PRC-redact\|\d+\}}\}}") + 10 * count(r"\{\{PRC-redact(?!\|\d+(?:\|os=yes)?\}\})")

    return let(_without_title_line(text), score)


def structure_penalty(text: Column) -> Column:
    """Empty and dotted signatures, stray case numbers, lines with two roles."""
    body = same_lines(text)
    count = lambda p: F.regexp_count(body, F.lit(p))
    rest = r"[^\n\x0B\f\r\x1c-\x1e\x85\u2028\u2029]*"
    merged = count(f"(?:法官助理|审判长|审判员|人民陪审员|书记员)[:：]?{rest}(?:书记员|人民陪审员|法官助理)[:：]?{rest}")
    return 12 * count(r"\{\{裁判文书署名\|1=\s*\}\}") + 10 * count(r"(?m)^\s*\{\{gap\}\}\.+(?:审判|人民陪审员|书记员|法官助理|二[〇零])") + 10 * count(r"(?m)^\s*\.+（[^）\n]+）[^\n]*号\s*$") + 8 * merged


SENTENCE_END = r"[。！？；：:，,、）)】］》”\"'0-9０-９]$"
BLOCK_START = r"^(?:[一二三四五六七八九十百千万]+、|[0-9０-９]+[.．、]|[《（(])"


def continues(previous: Column, following: Column) -> Column:
    """Whether a line is the rest of the sentence in the line before."""
    return (following != "") & ~previous.rlike(SENTENCE_END) & ~following.rlike(BLOCK_START) & ~following.rlike(PARTY)


def formatting_penalty(text: Column) -> Column:
    """Headings without gap, and sentences that a gap or an empty line breaks."""
    body = same_lines(text)
    start = F.struct(F.lit(0).alias("sum"), F.lit("").alias("filled"), F.lit(True).alias("first"), F.lit(False).alias("blank"))

    def step(state: Column, line: Column) -> Column:
        return let(strip(line), lambda s: stepped(state, s))

    def stepped(state: Column, s: Column) -> Column:
        gapped = F.startswith(s, F.lit("{{gap}}"))
        rest = F.when(gapped, strip(F.substring(s, F.lit(8), F.length(s)))).when(s.rlike(f"^[{HAN}]"), s).otherwise("")
        broken = (gapped | (~state["first"] & state["blank"])) & (state["filled"] != "") & let(rest, lambda r: continues(state["filled"], r))
        return F.struct((state["sum"] + F.when(broken, 8).otherwise(0)).alias("sum"), F.when(s != "", s).otherwise(state["filled"]).alias("filled"), F.lit(False).alias("first"), (s == "").alias("blank"))

    return 4 * F.regexp_count(body, F.lit(rf"(?m)^(?!\{{\{{gap\}}\}})[{HAN}][^\n]{{1,40}}：\s*$")) + F.aggregate(lines(body), start, step, lambda s: s["sum"])


def content_links(text: Column) -> Column:
    return F.regexp_count(same_lines(text), F.lit(r"(?i)\[\[(?!(?:Category|分类|分類)\s*:)[^\]]+\]\]"))


def fix_header(text: Column) -> Column:
    """Safe repairs of an existing page: wide parentheses in the case number, no templates in the title."""
    def fix(line: Column) -> Column:
        head = F.regexp_extract(line, r"^(\s*\|\s*[^=|\n]+?\s*=\s*)", 1)
        key = strip(F.regexp_extract(line, r"^\s*\|\s*([^=|\n]+?)\s*=", 1))
        value = F.substring(line, F.length(head) + 1, F.length(line))
        return F.when(key == "案号", F.concat(head, F.translate(value, "()", "（）"))).when(key == "title", F.concat(head, templates_to_crosses(value))).otherwise(line)

    return F.array_join(_in_header(text, fix, F.transform), "\n")


def header_court(text: Column) -> Column:
    court = court_name(header(text)["court"], committee=False)
    return F.when(court != "", court)


def header_type(text: Column) -> Column:
    kind = doc_type(header(text)["type"])
    return F.when(kind != "", kind)


def missing_fields(text: Column) -> Column:
    return let(header(text), lambda h: F.filter(F.array(*[F.when(or_empty(h[k]) == "", F.lit(k)) for k in ("court", "type", "案号")]), lambda k: k.isNotNull()))


def fix_country_categories(text: Column) -> Column:
    """Categories of judgments get the country's name: behind the year where there is one, else in front."""
    country = "中华人民共和国"
    dated = F.regexp_replace(or_empty(text), rf"\[\[Category:(\d+年)(?!{country})([^{SPACE}]+判决书)\]\]", rf"[[Category:$1{country}$2]]")
    return F.regexp_replace(dated, rf"\[\[Category:(?!\d)(?!{country})([^{SPACE}]+判决书)\]\]", rf"[[Category:{country}$1]]")


def failure_kind(message: Column, header_error: str = "could not extract {{header/裁判文书}} metadata") -> Column:
    """A failed upload's kind, by the first of the known texts that its message holds."""
    said = F.lower(or_empty(message))
    has = lambda *t: said.rlike("|".join(t))
    return F.when(F.contains(said, F.lit(header_error.lower())), "existing_header_metadata").when(has("court mismatch"), "court_mismatch").when(has("title is too long", "illegal", "invalid title", "bad title"), "title").otherwise("generic")


# Titles and single edits.


def court_of_title(title: Column) -> Column:
    """The court in front of a case number; null without one."""
    court = strip(F.regexp_extract(or_empty(title), r"^(.*?法院)[（(]", 1))
    return F.when(court != "", court)


def type_of_title(title: Column) -> Column:
    """What stands behind the last 号; null without one."""
    kind = strip(F.regexp_extract(or_empty(title), "^.*号(.*)$", 1))
    return F.when(kind != "", kind)


def redact_selection(text: Column) -> Column:
    """The template that hides a selection officially, by its length in code points."""
    return F.concat(F.lit("{{PRC-redact|"), F.length(text).cast("string"), F.lit("|os=yes}}"))


def page_url(title: Column, base: str) -> Column:
    """A page's address: spaces as underscores, everything but letters, digits and ``_.-~/:`` by its bytes."""
    encoded = F.url_encode(F.replace(or_empty(title), F.lit(" "), F.lit("_")))
    for a, b in (("*", "%2A"), ("%7E", "~"), ("%2F", "/"), ("%3A", ":")):
        encoded = F.replace(encoded, F.lit(a), F.lit(b))
    return F.concat(F.lit(base), encoded)


def page_link(title: Column, label: Column | None = None) -> Column:
    same = F.concat(F.lit("[["), title, F.lit("]]"))
    return same if label is None else F.when(label == title, same).otherwise(F.concat(F.lit("[["), title, F.lit("|"), label, F.lit("]]")))


def alternate_title(current: Column, other: Column) -> Column:
    """Two titles of one page, the one with less masked first; equal ones are one."""
    pair = lambda a, b: F.concat(F.lit("{{另|"), a, F.lit("|"), b, F.lit("}}"))
    return F.when((or_empty(other) == "") | (current == other), current).when(title_score(other) < title_score(current), pair(other, current)).otherwise(pair(current, other))


def bullet(title: Column) -> Column:
    return F.concat(F.lit("* [["), title, F.lit("]]"))


def court_section(court: Column, title: Column) -> Column:
    """What a list of several courts gets for a new court."""
    return F.concat(F.lit("=="), court, F.lit("==\n[[Category:"), court, F.lit("]]\n"), bullet(title))


def redirect_to_list(text: Column, title: Column) -> Column:
    """A redirect as a disambiguation page with its target as the only entry; null where no court or type is told."""
    target = redirect_target(text)
    return F.when(court_of_title(target).isNotNull() & type_of_title(target).isNotNull(), versions_page(title, court_of_title(target), F.array(target), type_of_title(target)))
