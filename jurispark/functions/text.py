"""Text normalisation as column expressions: nothing here leaves the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from jurispark.functions.chars import CJK, MARKERS, MASKED, NEWER, SIGNING, SPACE, SPACES, TEMPLATE, java_class


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once: a bound name, so that plans do not grow with every mention."""
    return F.get(F.transform(F.array(value), body), 0)


def replace_each(text: Column, pattern: str, make: Callable[[Column], Column]) -> Column:
    """Replaces every match by ``make(match)``: the pieces between the matches and the new texts, zipped."""

    def replaced(t: Column) -> Column:
        made = F.concat(F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), make), F.array(F.lit("")))
        return F.when(t.rlike(pattern), F.array_join(F.zip_with(F.split(t, pattern, -1), made, lambda a, b: F.concat(a, b)), "")).otherwise(t)

    return let(text, replaced)


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(SPACES))


def rstrip(text: Column) -> Column:
    return F.rtrim(text, F.lit(SPACES))


def compact(text: Column) -> Column:
    """Without any white space; null is empty."""
    return F.regexp_replace(or_empty(text), rf"[{SPACE}]+", "")


def blank(text: Column) -> Column:
    return strip(or_empty(text)) == ""


def first_filled(*texts: Column) -> Column:
    """The first text that is neither null nor blank, trimmed; else null."""
    return F.coalesce(*[F.when(~blank(t), strip(t)) for t in texts])


def drop_invisible(text: Column) -> Column:
    """Without control, format, private and unassigned characters, but for line feed, return and tab."""
    return F.regexp_replace(text, rf"[\p{{C}}&&[^\n\r\t{java_class(NEWER)}]]", "")


def drop_cjk_spaces(text: Column) -> Column:
    """Without runs of spaces between two CJK characters."""
    return let(text, lambda t: F.when(F.contains(t, F.lit(" ")), F.regexp_replace(t, rf"(?<=[{CJK}]) +(?=[{CJK}])", "")).otherwise(t))


def template_sum(text: Column) -> Column:
    """The sum of the counts in redaction templates."""
    return F.aggregate(F.regexp_extract_all(or_empty(text), F.lit(TEMPLATE), F.lit(1)), F.lit(0).cast("long"), lambda a, n: a + n.cast("long"))


def _template(count: Column) -> Column:
    return F.concat(F.lit("{{PRC-redact|"), count.cast("string"), F.lit("}}"))


def collapse_templates(text: Column) -> Column:
    """Templates that touch become one with the sum of their counts."""
    return replace_each(text, r"(?:\{\{PRC-redact\|\d+\}\}){2,}", lambda m: _template(template_sum(m)))


def mark_redactions(text: Column) -> Column:
    """Runs of masking characters become templates with their length."""
    return let(text, lambda t: F.when(t.rlike(f"[{MARKERS}]"), collapse_templates(replace_each(t, MASKED, lambda m: _template(F.length(m))))).otherwise(collapse_templates(t)))


def mark_title_redactions(text: Column) -> Column:
    """Runs of masking characters become as many ×: titles can't hold templates."""
    return let(text, lambda t: F.when(t.rlike(f"[{MARKERS}]"), replace_each(t, MASKED, lambda m: F.repeat(F.lit("×"), F.length(m)))).otherwise(t))


def masked_runs(text: Column) -> Column:
    return let(or_empty(text), lambda t: F.when(t.rlike(f"[{MARKERS}]"), F.regexp_extract_all(t, F.lit(MASKED), F.lit(0))).otherwise(F.array().cast("array<string>")))


def raw_marker_count(text: Column) -> Column:
    return F.length(or_empty(text)) - F.length(F.regexp_replace(or_empty(text), f"[{MARKERS}]", ""))


def tighten_products(text: Column) -> Column:
    """No space around a × between numbers or units."""
    return F.regexp_replace(text, rf"(?<=[0-9０-９%％）)元平方米])[{SPACE}]*×[{SPACE}]*(?=[0-9０-９（(])", "×")


def wide_parentheses(text: Column) -> Column:
    return F.translate(text, "()", "（）")


def drop_leading_dots(text: Column) -> Column:
    return strip(F.regexp_replace(strip(or_empty(text)), r"^[.\u2026．·・、。]+", ""))


def clean(text: Column) -> Column:
    """The cleaning that every block of text gets; null is empty."""
    out = F.regexp_replace(drop_invisible(or_empty(text)), r"[\t\r\n\f\x0B]+", " ")
    return mark_redactions(tighten_products(drop_cjk_spaces(strip(F.regexp_replace(out, "  +", " ")))))


def clean_title(text: Column) -> Column:
    """A title: invisible characters and stray spaces go, masks become ×, dots become one kind."""
    return F.translate(mark_title_redactions(drop_cjk_spaces(strip(drop_invisible(text)))), "．‧•･・", "·····")


def same_lines(text: Column) -> Column:
    """The form in which texts are compared: line feeds only, nothing blank at the end."""
    return rstrip(F.regexp_replace(or_empty(text), r"\r\n?", "\n"))


def remove_once(text: Column, fragment: Column) -> Column:
    """Without the first occurrence of a fragment; an empty one leaves the text."""

    def cut(b: Column) -> Column:
        at = F.position(b["fragment"], b["text"])
        rest = F.substring(b["text"], at + F.length(b["fragment"]), F.length(b["text"]))
        return F.when((at > 0) & (b["fragment"] != ""), F.concat(F.substring(b["text"], F.lit(1), at - 1), rest)).otherwise(b["text"])

    return let(F.struct(text.alias("text"), fragment.alias("fragment")), cut)


def _merged(masks: Column) -> Column:
    return _template(template_sum(masks) + raw_marker_count(F.regexp_replace(masks, TEMPLATE, "")))


def merge_redactions(text: Column) -> Column:
    """Two or more masks side by side, raw or as templates, become one template; a longer raw run as well."""
    return replace_each(text, rf"(?:\{{\{{PRC-redact\|\d+\}}\}}|[{MARKERS}]){{2,}}", _merged)


def canonical_redactions(text: Column) -> Column:
    """Equal for texts that differ only in how masks are written."""
    touching = rf"[{MARKERS}]*(?:\{{\{{PRC-redact\|\d+\}}\}}[{MARKERS}]*)+"
    return replace_each(mark_redactions(same_lines(text)), touching, _merged)


def templates_to_crosses(text: Column) -> Column:
    return replace_each(or_empty(text), TEMPLATE, lambda m: F.repeat(F.lit("×"), F.regexp_extract(m, TEMPLATE, 1).cast("int")))


def hide_redactions(text: Column) -> Column:
    """Every masked character, raw or in a template, becomes U+E000."""
    hidden = replace_each(or_empty(text), TEMPLATE, lambda m: F.repeat(F.lit("\ue000"), F.regexp_extract(m, TEMPLATE, 1).cast("int")))
    return F.translate(hidden, MARKERS, "\ue000" * len(MARKERS))


def append_message(message: Column, extra: str | Column) -> Column:
    extra = F.lit(extra) if isinstance(extra, str) else extra
    return F.when(or_empty(message) == "", extra).otherwise(F.concat(message, F.lit("; "), extra))


def truncate(text: Column, limit: int = 300) -> Column:
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit - 1), F.lit("…"))).otherwise(text)


def title_score(text: Column) -> Column:
    """How much of a title is masked: one for each 某, × and X, three for each template."""
    plain = F.regexp_replace(or_empty(text), TEMPLATE, "")
    return F.regexp_count(plain, F.lit("[某×Xx]")) + 3 * F.regexp_count(or_empty(text), F.lit(TEMPLATE))


def sha1_id(values: list[Column], index: Column) -> Column:
    """The first 12 hex digits of a digest of all values; rows without values are named by their index."""
    joined = F.concat_ws("|", *[or_empty(v) for v in values])
    return F.when(F.regexp_replace(joined, r"\|", "") == "", F.concat(F.lit("row-"), index.cast("string"))).otherwise(F.substring(F.sha1(joined), 1, 12))


DATE_LINE = r"^(?:[〇零一二三四五六七八九]+年[一二三四五六七八九十]+月[一二三四五六七八九十]+日|(?U:\d{4}年\d{1,2}月\d{1,2}日))\z"
SIGNATURE_LINE = "^(?:" + "|".join(rf"(?:代[{SPACE}]*理[{SPACE}]*)?" + rf"[{SPACE}]*".join(role) for role in SIGNING) + ")"
JUNK_LINE = r"^(?:[\-\u2010-\u2015\uff0d]?(?U:\d+)[\-\u2010-\u2015\uff0d]?|\?|第[" + SPACE + r"]*(?U:\d+)[" + SPACE + r"]*页)\z"


def is_date_line(text: Column) -> Column:
    return drop_leading_dots(text).rlike(DATE_LINE)


def is_signature_line(text: Column) -> Column:
    return drop_leading_dots(clean(text)).rlike(SIGNATURE_LINE)


def is_junk_line(text: Column) -> Column:
    """Page numbers, with or without dashes, and single question marks."""
    return strip(or_empty(text)).rlike(JUNK_LINE)


def glob_filter(column: Column, patterns: str) -> Column:
    """True where the raw value matches one of the ``;``-separated globs as a whole; without patterns never."""
    globs = [p.strip() for p in patterns.split(";") if p.strip()]
    if not globs:
        return F.lit(False)
    return or_empty(column).rlike("(?s)^(?:" + "|".join(map(_glob, globs)) + r")\z")


def _glob(pattern: str) -> str:
    out, i = [], 0
    while i < len(pattern):
        c = pattern[i]
        end = pattern.find("]", i + 2) if c == "[" else -1
        if c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif end > 0:
            body = pattern[i + 1 : end].replace("\\", r"\\").replace("[", r"\[").replace("&", r"\&")
            out.append("[^" + body[1:] + "]" if body.startswith("!") else "[" + body.replace("^", r"\^", 1) + "]")
            i = end
        else:
            out.append(c if c.isalnum() else "\\" + c if ord(c) < 128 else c)
        i += 1
    return "".join(out)
