"""Courts, case numbers, document types, dates and places, inferred in column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from jurispark.functions.chars import CITIES, HAN, MUNICIPALITIES, PROVINCES, SPACE, TYPE_ENDINGS, TYPE_SUFFIXES
from jurispark.functions.text import compact, drop_leading_dots, let, or_empty, remove_once, strip, wide_parentheses

CASE_NUMBER = r"（.*?号(?:之[一二三四五六七八九十百千万〇零]+)?"
FIRST_YEAR = 1949


def first_match(items, test) -> Column:
    """The first of some fixed strings, in their order, for which ``test(item)`` holds; else null."""
    return F.element_at(F.filter(F.array(*map(F.lit, items)), test), 1)


def _try_first(found: Column) -> Column:
    return let(found, lambda f: F.when(F.size(f) > 0, F.get(f, 0)))


def court_name(court: Column, *, committee: bool = True) -> Column:
    """From the first Han character to the last 法院, and with ``committee`` a …委员会 of up to 12 characters behind it."""
    text = F.regexp_replace(compact(court), rf"^[^{HAN}]+", "")
    return F.regexp_extract(text, rf"^(?s)(.*法院(?:[{HAN}]{{1,12}}委员会)?)" if committee else "^(?s)(.*法院)", 1)


def case_number(text: Column) -> Column:
    """From （ to the next 号, with a suffix 之 and a numeral; empty without one."""
    return F.regexp_extract(wide_parentheses(compact(text)), CASE_NUMBER, 0)


def doc_type(text: Column) -> Column:
    """Han characters up to the last type ending; all Han characters where there is none."""
    han = F.regexp_replace(compact(text), rf"[^{HAN}]+", "")
    return F.regexp_extract(han, f"^(.*(?:{'|'.join(TYPE_ENDINGS)})|.*)", 1)


def doc_type_of_title(title: Column) -> Column:
    """The first known ending that a title has; else empty."""
    return or_empty(let(compact(title), lambda text: _try_first(F.filter(F.array(*map(F.lit, TYPE_SUFFIXES)), lambda s: F.endswith(text, s)))))


def doc_type_of_hierarchy(hierarchy: Column, court: Column, number: Column) -> Column:
    """What is left of the hierarchy without courts and case numbers, as a type."""
    rest = let(wide_parentheses(compact(hierarchy)), lambda r: remove_once(r, court_name(r)))
    rest = remove_once(rest, court_name(court))
    rest = F.regexp_replace(rest, rf"^(.*?){CASE_NUMBER}", "$1")
    return doc_type(remove_once(rest, case_number(number)))


def infer_court(court: Column, hierarchy: Column) -> Column:
    return let(court_name(hierarchy), lambda full: F.when(full != "", full).otherwise(court_name(court)))


def case_title(court: Column, number: Column, kind: Column) -> Column:
    """Court, case number and type in one; null if one of them is empty. Committees do not count here."""
    parts = F.array(court_name(court, committee=False), case_number(number), doc_type(kind))
    return let(parts, lambda p: F.when(~F.array_contains(p, ""), F.array_join(p, "")))


def valid_year(year: Column, as_of: int | Column) -> Column:
    """True from 1949 to the year ``as_of``; a parameter, so that results don't change with the calendar."""
    return F.coalesce(strip(year).try_cast("int").between(F.lit(FIRST_YEAR), F.lit(as_of) if isinstance(as_of, int) else as_of), F.lit(False))


DATE = "struct<year:string,month:string,day:string>"


def _date(year: Column, month: Column, day: Column) -> Column:
    return F.struct(year.cast("string").alias("year"), month.cast("string").alias("month"), day.cast("string").alias("day"))


def _numeral(text: Column) -> Column:
    """Han digits one by one, or as tens and ones where 十 stands."""
    digits = lambda t: F.translate(t, "〇零一二三四五六七八九", "00123456789")


    def read(t: Column) -> Column:
        tens, ones = F.substring_index(t, "十", 1), F.substring_index(t, "十", -1)
        return F.when(F.contains(t, F.lit("十")), F.concat(F.when(tens == "", "1").otherwise(digits(tens)), F.when(ones == "", "0").otherwise(digits(ones)))).otherwise(digits(t))

    return let(text, read)


def date_of_text(text: Column) -> Column:
    """Year, month and day of the first date in Han numerals, else of the first in digits (zeros stay); else null."""
    han = "([〇零一二三四五六七八九]+)年([一二三四五六七八九十]+)月([一二三四五六七八九十]+)日"
    plain = r"(?U)(\d{4})年(\d{1,2})月(\d{1,2})日"
    part = lambda t, p, i: F.regexp_extract(t, p, i)
    return let(text, lambda t: F.when(t.rlike(han), _date(*[_numeral(part(t, han, i)) for i in (1, 2, 3)])).when(t.rlike(plain), _date(*[part(t, plain, i) for i in (1, 2, 3)])))


def valid_date(date: Column, as_of) -> Column:
    """The date as a whole, or null if its year is not valid."""
    return let(date, lambda d: F.when(valid_year(d["year"], as_of), d))


def date_of_iso(text: Column, as_of) -> Column:
    """Year, month and day of yyyy-m-d without leading zeros; only the year is checked."""
    pattern = rf"^[{SPACE}]*(\d{{4}})-(\d{{1,2}})-(\d{{1,2}})[{SPACE}]*\z"
    part = lambda i: F.regexp_extract(text, pattern, i)
    return F.when(text.rlike(pattern), valid_date(_date(part(1), part(2).cast("int"), part(3).cast("int")), as_of))


def year_of_case_number(number: Column, as_of) -> Column:
    year = F.regexp_extract(or_empty(number), rf"[（(][{SPACE}]*(\d{{4}})[{SPACE}]*[）)]", 1)
    return let(year, lambda y: F.when(valid_year(y, as_of), y))


def resolve_date(found: Column, fallback: Column, number: Column, as_of) -> Column:
    """The document's own date, else the fallback, else the year of the case number; parts are never mixed."""
    none = F.lit(None).cast("string")
    of_case = let(year_of_case_number(number, as_of), lambda y: F.when(y.isNotNull(), _date(y, none, none)))
    return F.coalesce(valid_date(found, as_of), valid_date(fallback, as_of), of_case)


def _city(court: Column, cities: Mapping[str, str]) -> Column:
    """(city, province) of the first city, in the table's order, that stands in the name; else null.

    The name is cut into its pieces of the lengths that cities have, and these are looked up in a hash set (which Spark
    makes of a long list of literals), so that a table of thousands costs what one of thirty does. Only cities that
    were found get their place in the order.
    """
    names = [c for c in cities if c]
    if not names:
        return F.lit(None).cast("struct<city:string,province:string>")
    # one string each, so that a long table is a short plan
    listed = lambda values: F.split(F.lit("|".join(values)), r"\|")
    lengths = sorted({len(n) for n in names})
    pieces = F.flatten(F.transform(F.sequence(F.lit(1), F.greatest(F.length(court), F.lit(1))), lambda i: F.array(*[F.substring(court, i, F.lit(n)) for n in lengths])))
    places = F.transform(F.filter(pieces, lambda c: c.isin(names)), lambda c: F.array_position(listed(names), c).cast("int"))
    at = lambda i, values: F.element_at(listed(values), i)
    return let(F.array_min(places), lambda i: F.when(i.isNotNull(), F.struct(at(i, names).alias("city"), at(i, [cities[c] for c in names]).alias("province"))))


def location(court: Column, cities: Mapping[str, str] = CITIES) -> Column:
    """Province and city of a court, null where neither its start, a city in it, nor 旗 tells.

    ``cities`` maps names to provinces and is tried in its order; give a fuller table for fuller coverage.
    """
    return let(compact(court), lambda text: _location(text, cities))


def _location(text: Column, cities: Mapping[str, str]) -> Column:
    province = _try_first(F.filter(F.array(*map(F.lit, PROVINCES)), lambda p: F.startswith(text, p)))
    city = _city(text, cities)
    suffix = lambda c: F.when(c["city"].rlike("(?:州|盟|地区)$"), "").otherwise("市")
    place = let(city, lambda c: F.when(c["province"].isin(*MUNICIPALITIES), c["province"]).otherwise(F.concat(c["province"], c["city"], suffix(c))))
    of_province = let(province, lambda p: F.concat(p, F.regexp_extract(F.substring(text, F.length(p) + 1, F.length(text)), "^([^市州盟]+(?:市|州|盟|地区))", 1)))
    return F.when(text != "", F.coalesce(of_province, place, F.when(F.contains(text, F.lit("旗")), F.lit("内蒙古自治区"))))


def location_of_hierarchy(hierarchy: Column, cities: Mapping[str, str] = CITIES) -> Column:
    return location(F.substring_index(strip(or_empty(hierarchy)), "\n", 1), cities)


def province(court: Column, cities: Mapping[str, str] = CITIES) -> Column:
    start = lambda text: _try_first(F.filter(F.array(*map(F.lit, PROVINCES)), lambda p: F.startswith(text, p)))
    return let(compact(court), lambda text: F.coalesce(start(text), _city(text, cities)["province"], F.when(F.contains(text, F.lit("旗")), F.lit("内蒙古自治区"))))


def header(title: Column, court: Column, kind: Column, number: Column, date: Column, place: Column, source_id: Column) -> Column:
    """The header template of a document page."""
    values = [("title", title), ("court", court), ("type", kind), ("案号", number), ("year", date["year"]), ("month", date["month"]), ("day", date["day"]), ("loc", place), ("docid", source_id)]
    return F.concat_ws("\n", F.lit("{{Header/裁判文书"), *[F.concat(F.lit(f"|{k} = "), or_empty(v)) for k, v in values], F.lit("}}"))


def signature_number(text: Column) -> Column:
    return wide_parentheses(F.regexp_replace(drop_leading_dots(text), " ", ""))
