"""Fill-in-middle against slices of the whole text, with odd rows and other units."""

import hashlib

import pytest
import regex
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jurispark.llm import middle as M


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(key, text):
    """One text by the contract, without the module."""
    text, key = text or "", "" if key is None else key
    digest = sha(f"1:{key}")
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    spm = h[3] % 100 < 20
    made = f"<S>{suf}<P>{pre}<M>{mid}" if spm else f"<P>{pre}<S>{suf}<M>{mid}"
    return n, "spm" if spm else "psm", a, b - a, sha(made), sha(text)


def test_rows_against_slices(spark):
    texts = ["", None, "a", "<P>", "x <S> y", "é😀\n\r\n" * 40, "<", "<<M", ">P<S", "a" * 63, "b" * 64, "c" * 65, "long é " * 30000, "\x00퟿"]
    rows = [(i, texts[i % len(texts)]) for i in range(300)] + [(None, "no id"), (5, texts[5]), (5, texts[5])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("own") for c in ("n", "form", "output", "fim")})
    found = M.fill_in_middle(df).select("doc_id", "text", "n", "fim").collect()
    assert len(found) == len(rows) and {r.n for r in found} == {"own"}
    forms = set()
    for r in found:
        f = r.fim
        assert (f.n, f.form, f.prefix_chars, f.middle_chars, f.output_sha256, f.restored_sha256) == expected(r.doc_id, r.text)
        assert sha(f.output) == f.output_sha256 and M.restore(f.output, f.form) == (r.text or "")
        forms.add(f.form)
    assert forms == {"plain", "psm", "spm"}
    assert M.fill_in_middle(df.limit(0)).count() == 0


@given(st.text(alphabet="<PSM>ab\n", max_size=12), st.text(alphabet="<PSM>a", max_size=6), st.text(alphabet="<PSM>b", max_size=6))
def test_restored(a, b, c):
    if not any(m in a + b + c for m in M.MARKS):
        assert all(M.restore(M.arrange(a, b, c, f), f) == a + b + c for f in ("psm", "spm"))


@pytest.mark.parametrize("unit", [M.CODE_POINT, r"\X", r"\w+", r"\w+\W*|\W+", r"[ab]"])
@given(text=st.text(alphabet="ab é́\n👩‍", max_size=400))
def test_unit_ends(unit, text):
    """Runs and single units give what one match after another gives."""
    units = M.Units(unit)
    ends = [0, *(m.end() for m in regex.finditer(f"(?>{unit})", text))]
    found = units.of(text)
    assert found[1][-1] == len(ends) - 1
    assert [units.end(text, found, k) for k in range(len(ends))] == ends


def test_ends_of_long_texts():
    units = M.Units(M.CODE_POINT)
    text = "é" * 1_000_003
    found = units.of(text)
    assert found[1][-1] == len(text) and len(found[0]) < 16_000
    assert all(units.end(text, found, k) == k for k in (0, 1, 63, 64, 65, 999_999, 1_000_003))
