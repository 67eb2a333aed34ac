"""Fill-in-middle: texts cut in three at unit ends and put together in another order, as a pandas UDF over Arrow batches."""

from __future__ import annotations

import hashlib
from array import array
from bisect import bisect_right
from itertools import islice

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jurispark.llm.common import lean_batches

#: One code point.
CODE_POINT = r"(?s:.)"
#: What stands before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: Units that one match takes where that many follow one another.
RUN = 64
FIELDS = "n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string, restored_sha256 string"


class Units:
    """Where the units of a text end. Runs of RUN units that touch are one match and one entry, other units one each, so the
    arrays stay small for texts of any length; an end inside a run is found by going through that run again."""

    def __init__(self, unit: str):
        self.runs, self.one = regex.compile(rf"((?>{unit}){{{RUN}}}+)|(?>{unit})"), regex.compile(rf"(?>{unit})")

    def of(self, text: str) -> tuple[array, array]:
        """Ends of the matches, and how many units there are up to each."""
        ends, units, n = array("q", [0]), array("q", [0]), 0
        for m in self.runs.finditer(text):
            n += RUN if m.lastindex else 1
            ends.append(m.end())
            units.append(n)
        return ends, units

    def end(self, text: str, found: tuple[array, array], count: int) -> int:
        """Where the first ``count`` units end."""
        ends, units = found
        at = bisect_right(units, count) - 1
        rest = count - units[at]
        return next(islice(self.one.finditer(text, ends[at]), rest - 1, None)).end() if rest else ends[at]


def seeds(key: str) -> tuple[int, ...]:
    digest = hashlib.sha256(key.encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in range(0, 32, 8))


def arrange(prefix: str, middle: str, suffix: str, form: str, marks: tuple[str, str, str] = MARKS) -> str:
    p, s, m = marks
    return f"{p}{prefix}{s}{suffix}{m}{middle}" if form == "psm" else f"{s}{suffix}{p}{prefix}{m}{middle}"


def restore(output: str, form: str, marks: tuple[str, str, str] = MARKS) -> str:
    """The text that an output was made from.

    Texts with a mark in them are plain, and no mark's end is the beginning of a mark, so the first place of each mark
    behind the one before is where it was put.
    """
    if form == "plain":
        return output
    p, s, m = marks
    first, second = (p, s) if form == "psm" else (s, p)
    a, rest = output.removeprefix(first).split(second, 1)
    b, middle = rest.split(m, 1)
    return a + middle + b if form == "psm" else b + middle + a


def fill_in_middle(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", out: str = "fim", unit: str = CODE_POINT, seed: str = "1", moved: int = 90, spm: int = 20, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """Adds a struct: n (units), form, prefix_chars and middle_chars (code points, null if plain), output, and the SHA-256 of
    the output and of what is restored from it.

    ``unit`` is a pattern without groups and without empty matches; what lies behind the last unit belongs to the suffix,
    what lies between two units to the one behind. The hash of ``seed:id`` gives four numbers: two choose where prefix and
    middle end, the third the share (``moved`` in 100) of texts that are not left plain, the fourth the share (``spm`` in
    100) of those whose suffix comes first. Empty texts and texts with a mark in them are plain. The marks must differ, and
    none may begin with what another ends with.

    Null texts count as empty, null ids as an empty id. Rows are worked on one by one: repeated rows get equal structs, and
    no column but one named like ``out`` changes. No row meets another, so nothing is shuffled.
    """
    lean_batches(docs.sparkSession)
    units = Units(unit)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()

    def one(key: str, text: str) -> tuple:
        h1, h2, h3, h4 = seeds(f"{seed}:{key}")
        found = units.of(text)
        n = found[1][-1]
        if not text or any(m in text for m in marks) or h3 % 100 >= moved:
            digest = sha(text)
            return n, "plain", None, None, text, digest, digest
        form = "spm" if h4 % 100 < spm else "psm"
        a, b = (units.end(text, found, c) for c in sorted((h1 % (n + 1), h2 % (n + 1))))
        output = arrange(text[:a], text[a:b], text[b:], form, marks)
        return n, form, a, b - a, output, sha(output), sha(restore(output, form, marks))

    @F.pandas_udf(FIELDS)
    def moved_texts(keys: pd.Series, texts: pd.Series) -> pd.DataFrame:
        names = [f.split()[0] for f in FIELDS.split(", ")]
        made = pd.DataFrame([one(k, t) for k, t in zip(keys, texts, strict=True)], columns=names, dtype=object)
        return made.astype({c: "Int64" for c in ("n", "prefix_chars", "middle_chars")})

    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    return docs.withColumn(out, moved_texts(text(id_col), text(text_col)))
