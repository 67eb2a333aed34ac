"""Secret scans in DataFrame operations only: patterns, and sliding-window entropy of candidate strings."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jurispark.functions.text import let

#: The kinds in the order in which spans with one start are listed. Fixed values.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Parts of a candidate that are no secrets: parts of a path with a placeholder's word, a character over and over. They
#: are cut out, and what is left is judged.
PLACEHOLDERS = r"(?i)[^/=]*(?:example|placeholder|changeme|dummy|sample|your_|xxxx)[^/=]*|([A-Za-z0-9+/_=-])\1{7,}"
#: Characters in a window, and bits a character that a window must reach, by the class of what it stands in: the first
#: whose characters are all that there are. Without bits no entropy makes a secret: words and paths, and numbers.
WINDOW = 20
CLASSES = (("words", "A-Za-z_=/+-", None), ("numbers", "0-9_=/+-", None), ("hex", "0-9a-fA-F", 3.0), ("alphanumeric", "A-Za-z0-9", 3.8), ("base64", "A-Za-z0-9+/=", 3.8), ("base64url", "A-Za-z0-9_=-", 3.8), ("mixed", "A-Za-z0-9+/_=-", 3.9))
#: What one bit counts in sums of entropies.
UNIT = 1 << 40
#: Matches whose places are summed up together.
CHUNK = 512


def _spans(text: Column, pattern: str, kind: str) -> Column:
    """All matches, leftmost and non-overlapping: array of (start, rank, kind, end, found), code points from 0.

    Splitting at the matches gives what lies between them, so lengths add up to positions.
    """
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,found:string>>")

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["between"])
        end = start + F.length(pair["found"])
        one = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"), pair["found"].alias("found"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    # places are summed up in chunks, so that a text with very many matches doesn't copy a long array for each
    pairs = F.arrays_zip(F.slice(between, 1, F.size(found)).alias("between"), found.alias("found"))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / CHUNK).cast("int")), lambda k: F.slice(pairs, k * CHUNK + 1, CHUNK))
    placed = F.transform(chunks, lambda chunk: F.aggregate(chunk, F.struct(F.lit(0).alias("at"), none.alias("out")), add))
    ends = lambda state, chunk: F.struct((state["at"] + chunk["at"]).alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out"))
    offsets = lambda p: F.aggregate(p, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), ends, lambda state: state["out"])

    def move(chunk: Column, by: Column) -> Column:
        return F.transform(chunk["out"], lambda s: F.struct((s["start"] + by).alias("start"), s["rank"].alias("rank"), s["kind"].alias("kind"), (s["end"] + by).alias("end"), s["found"].alias("found")))

    return F.when(text.rlike(pattern), F.flatten(let(placed, lambda p: F.zip_with(p, offsets(p), move)))).otherwise(none)


def _entropy(string: Column) -> Column:
    """The greatest Shannon entropy of any WINDOW characters in a row, in bits a character.

    The window slides over the string as its WINDOW characters and the sum of c * log2(c) over their counts c. A step takes
    the first out and one in, looks up how often the window holds either, and moves the sum by what these two counts
    change. So a step takes the time of a window, whatever the length of the string.
    """
    # in whole numbers, so that a long way of steps doesn't drift
    weights = F.array(*[F.lit(round(c * math.log2(c) * UNIT) if c else 0).cast("long") for c in range(WINDOW + 1)])
    weight = lambda c: F.get(weights, c)
    count = lambda window, c: F.size(F.filter(window, lambda x: x == c))

    def move(state: Column, new: Column) -> Column:
        def counted(change: Column) -> Column:
            # the character that goes leaves one less behind; the one that comes adds to what is left
            total = state["sum"] - weight(change["out"]) + weight(change["out"] - 1) - weight(change["in"]) + weight(change["in"] + 1)
            window = F.concat(F.slice(state["window"], 2, WINDOW - 1), F.array(new))
            return F.struct(window.alias("window"), total.alias("sum"), F.least(state["least"], total).alias("least"))

        old = state["window"][0]
        change = F.struct(count(state["window"], old).alias("out"), (count(state["window"], new) - F.when(new == old, 1).otherwise(0)).alias("in"))
        return let(change, counted)

    def slid(codes: Column) -> Column:
        first = F.slice(codes, 1, WINDOW)
        total = F.aggregate(F.array_distinct(first), F.lit(0).cast("long"), lambda s, c: s + weight(count(first, c)))
        start = let(total, lambda t: F.struct(first.alias("window"), t.alias("sum"), t.alias("least")))
        return F.aggregate(F.slice(codes, WINDOW + 1, F.size(codes)), start, move, lambda s: s["least"])

    codes = F.transform(F.filter(F.split(string, ""), lambda c: c != ""), lambda c: F.ascii(c))
    bits = F.lit(WINDOW).cast("double")
    return F.log2(bits) - let(codes, slid) / (bits * UNIT)


def find_secrets(docs: DataFrame, *, text_col: str = "text", out: str = "secrets") -> DataFrame:
    """Adds an array of (start, rank, kind, end, found), ordered by start, then kind; ends are exclusive.

    assign: a secret's name, then ``:`` or ``=``, then a value of 12 or more characters; access: AKIA and 14 or
    more; hex: 16 or more of 0-9a-f. A match whose value is too short is dropped, and the scan goes on behind
    it. entropy: strings of 20 or more of ``[A-Za-z0-9+/_=-]`` that hold a window of high entropy for its class (see
    ``CLASSES``); what the allow-list names is cut out before, so that a placeholder hides itself only.

    Null texts and texts without secrets get an empty array. Each row is judged by itself: repeated rows get
    equal arrays, and all other columns stay as they are (a column named like ``out`` is replaced).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    assign = F.filter(_spans(text, ASSIGN, "assign"), lambda s: F.length(F.regexp_extract(s["found"], ASSIGN, 2)) >= 12)
    entropic = F.filter(_spans(text, CANDIDATE, "entropy"), lambda s: _is_random(s["found"]))
    return docs.withColumn(out, F.array_sort(F.concat(assign, _spans(text, ACCESS, "access"), _spans(text, HEX, "hex"), entropic)))


def _is_random(string: Column) -> Column:
    """Whether a window of the string, outside of placeholders, has the entropy of its class."""

    def judged(part: Column) -> Column:
        least = F.lit(None).cast("double")
        for _, characters, bits in reversed(CLASSES):
            least = F.when(part.rlike(f"^[{characters}]+$"), F.lit(bits).cast("double")).otherwise(least)
        return F.when(F.length(part) < WINDOW, False).otherwise(F.coalesce(let(least, lambda bits: F.when(bits.isNull(), False).otherwise(_entropy(part) >= bits)), F.lit(False)))

    return F.exists(F.split(F.regexp_replace(string, PLACEHOLDERS, " "), " "), judged)


def digest(docs: DataFrame, secrets: str = "secrets") -> list[Column]:
    """Counts of the base kinds, SHA-256 of the base spans, all spans as text."""
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    spans = F.col(secrets)
    of = lambda kind: F.filter(spans, lambda s: s["kind"] == kind)
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    return [*counts, F.sha2(said(F.filter(spans, lambda s: s["rank"] < 3)), 256).alias("base_sha256"), said(spans).alias("spans")]


def redact(docs: DataFrame, *, text_col: str = "text", length_col: str | None = "n_chars", mask: str = "[REDACTED]") -> DataFrame:
    """Texts with each stretch that spans cover replaced by the mask; texts without secrets stay as they are.

    Spans that touch or overlap become one stretch. Null texts stay null. ``length_col`` is set to the new
    length in code points where it exists.
    """
    found = find_secrets(docs, text_col=text_col, out="__secrets")
    text = F.col(text_col)

    def add(state: Column, span: Column) -> Column:
        fresh = span["start"] > state["at"]
        gap = F.substring(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        touching = (span["start"] <= state["at"]) & (state["at"] > 0) & state["open"]
        piece = F.when(touching, F.lit("")).otherwise(F.concat(F.when(fresh, gap).otherwise(F.lit("")), F.lit(mask)))
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), F.concat(state["out"], piece).alias("out"), F.lit(True).alias("open"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"), F.lit(False).alias("open"))
    clean = F.aggregate("__secrets", start, add, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    some = F.size("__secrets") > 0
    found = found.withColumn(text_col, F.when(some, clean).otherwise(text))
    if length_col in docs.columns:
        found = found.withColumn(length_col, F.when(some, F.length(text_col).cast(docs.schema[length_col].dataType)).otherwise(F.col(length_col)))
    return found.drop("__secrets")
