"""The text rules as functions on single strings, for code that walks trees or page states.

The column expressions in ``text``, ``metadata`` and ``wiki`` are the main path; tests hold both to the same cases.
"""

from __future__ import annotations

import re
import unicodedata

from jurispark.functions.chars import CJK_RANGES, HAN, MARKERS, PARTY, ROLES, SIGNING, TYPE_ENDINGS, X_MARKERS

_CJK = "".join(f"{chr(a)}-{chr(b)}" for a, b in CJK_RANGES)
_SPACES = re.compile(rf"(?<=[{_CJK}]) +(?=[{_CJK}])")
_RUN = re.compile(f"[{MARKERS}]+")
_TWO_X = re.compile(f"[{X_MARKERS}]{{2}}")
#: Forms of templates, products, dates, junk lines, numbers and roles. Fixed values.
TEMPLATE = re.compile(r"\{\{PRC-redact\|(\d+)\}\}")
_TEMPLATES = re.compile(r"(?:\{\{PRC-redact\|\d+\}\}){2,}")
_TOUCHING = re.compile(rf"[{MARKERS}]*(?:\{{\{{PRC-redact\|\d+\}}\}}[{MARKERS}]*)+")
_PRODUCT = re.compile(r"(?<=[0-9０-９%％）)元平方米])\s*×\s*(?=[0-9０-９（(])")
_DOTS = re.compile(r"^[.…．·・、。]+")
_DATE = re.compile(r"[〇零一二三四五六七八九]+年[一二三四五六七八九十]+月[一二三四五六七八九十]+日|\d{4}年\d{1,2}月\d{1,2}日")
_SIGNATURE = re.compile("|".join(r"(?:代\s*理\s*)?" + r"\s*".join(r) for r in SIGNING))
_FIRST = frozenset(["代", *(r[0] for r in SIGNING)])
_LINES, _WIDE = re.compile(r"[\t\r\n\f\v]+"), re.compile("  +")
_JUNK = re.compile(r"[\-‐-―－]?\d+[\-‐-―－]?|\?|第\s*\d+\s*页")
_ROLE = re.compile("|".join(sorted([*ROLES, *("代理" + r for r in ROLES)], key=len, reverse=True)))
_CASE = re.compile(r"（.*?号(?:之[一二三四五六七八九十百千万〇零]+)?")
_TYPE = re.compile(rf"[{HAN}]*(?:{'|'.join(TYPE_ENDINGS)})")
_PARTY = re.compile(PARTY)


def masks(text: str, at: re.Match) -> bool:
    """Whether a run of markers hides something: a lone × before a number multiplies, a single X in a Latin word is a letter."""
    run, after = at[0], text[at.end() : at.end() + 1]
    if run == "×" and after and (after == "." or after.isdecimal()):
        return False
    if _TWO_X.search(run) or not any(c in X_MARKERS for c in run):
        return True
    latin = lambda c: c.isascii() and c.isalpha() and c not in "Xx"
    return not any(latin(c) for c in (text[max(0, at.start() - 1) : at.start()], after) if c)


def masked_runs(text: str) -> list[str]:
    return [m[0] for m in _RUN.finditer(text) if masks(text, m)]


def template(count: int) -> str:
    return "{{PRC-redact|%d}}" % count


def template_sum(text: str) -> int:
    return sum(map(int, TEMPLATE.findall(text)))


def mark_redactions(text: str) -> str:
    marked = _RUN.sub(lambda m: template(len(m[0])) if masks(text, m) else m[0], text)
    return _TEMPLATES.sub(lambda m: template(template_sum(m[0])), marked) if "}}{{" in marked else marked


def crosses(text: str) -> str:
    return TEMPLATE.sub(lambda m: "×" * int(m[1]), text)


def same_lines(text: str | None) -> str:
    return (text or "").replace("\r\n", "\n").replace("\r", "\n").rstrip()


def canonical_redactions(text: str) -> str:
    return _TOUCHING.sub(lambda m: template(template_sum(m[0]) + len(TEMPLATE.sub("", m[0]))), mark_redactions(same_lines(text)))


def clean(text: str | None) -> str:
    out = text or ""
    if not out.isprintable():  # printable texts have neither control characters nor lines
        out = "".join(c for c in out if c in "\n\r\t" or c.isprintable() or unicodedata.category(c)[0] != "C")
        out = _LINES.sub(" ", out)
    out = (_WIDE.sub(" ", out) if "  " in out else out).strip()
    if " " in out:
        out = _SPACES.sub("", out)
    return mark_redactions(_PRODUCT.sub("×", out) if "×" in out else out)


def drop_dots(text: str | None) -> str:
    return _DOTS.sub("", (text or "").strip()).strip()


def is_date(text: str) -> bool:
    return "年" in text and bool(_DATE.fullmatch(drop_dots(text)))


def is_signature(text: str) -> bool:
    # cleaning never makes a role's first character, so most texts need none
    return not _FIRST.isdisjoint(text) and bool(_SIGNATURE.match(drop_dots(clean(text))))


def is_junk(text: str) -> bool:
    return bool(_JUNK.fullmatch(text.strip()))


def is_party(text: str) -> bool:
    return bool(_PARTY.match(text))


def compact(text: str | None) -> str:
    return "".join((text or "").split())


def wide(text: str) -> str:
    return text.replace("(", "（").replace(")", "）")


def court_name(text: str | None) -> str:
    """Up to the last 法院, as page titles have it."""
    found = re.search(r"(?s)^(.*法院)", re.sub(f"^[^{HAN}]+", "", compact(text)))
    return found[1] if found else ""


def case_number(text: str | None) -> str:
    found = _CASE.search(wide(compact(text)))
    return found[0] if found else ""


def doc_type(text: str | None) -> str:
    han = re.sub(f"[^{HAN}]+", "", compact(text))
    found = _TYPE.search(han)
    return found[0] if found else han


def signatures(text: str) -> list[tuple[str, str]]:
    """(role, name) pairs of a line that starts with a role; none if a name is missing."""
    line = compact(drop_dots(text)).replace("：", ":")
    roles = [*_ROLE.finditer(line)]
    if not roles or roles[0].start():
        return []
    ends = [r.start() for r in roles[1:]] + [len(line)]
    pairs = [(r[0], line[r.end() : e].lstrip(":")) for r, e in zip(roles, ends, strict=True)]
    return pairs if all(name for _, name in pairs) else []
