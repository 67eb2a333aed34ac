"""Decisions on page histories: the newest three revisions of a page side by side."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jurispark.functions import pages as P
from jurispark.functions import plain, quality
from jurispark.functions import text as T
from jurispark.functions import wiki as W
from jurispark.operators.planner import REVERT_SUMMARY
from jurispark.operators.relational import latest

IMPORT_PREFIX = "Imported from 裁判文书网"


def triplets(revisions: DataFrame) -> DataFrame:
    """revisions: title, revid, ts, comment, text. One row for each title: its newest three (null where there are fewer)."""
    newest = latest(revisions, "title", [F.desc("ts"), F.desc("revid")], 3)
    at = lambda n, c: F.max(F.when(F.col("place") == n, F.col(c))).alias(f"{c}{n}")
    return newest.groupBy("title").agg(F.count(F.lit(1)).alias("n"), *[at(n, c) for n in (1, 2, 3) for c in ("text", "comment")])


def first_author(revisions: DataFrame) -> DataFrame:
    return revisions.groupBy("title").agg(F.min_by("user", "revid").alias("creator"))


def _common(pair: bool) -> Column:
    """The reasons to skip that both decisions begin with."""
    bare = lambda c: T.same_lines(F.regexp_replace(W.without_review(F.col(c)), r"\n{3,}", "\n\n"))
    out = F.when(F.col("n") < 3, "fewer_than_three_revisions").when(~T.or_empty(F.col("text1")).rlike(W.REVIEW), "current_page_not_in_unchecked_category")
    if pair:
        out = out.when(~F.contains(T.or_empty(F.col("comment1")), F.lit(REVERT_SUMMARY)), "latest_revision_is_not_standard_overwrite_revert")
        out = out.when(~F.startswith(T.or_empty(F.col("comment2")), F.lit(IMPORT_PREFIX)), "previous_revision_is_not_standard_import")
    return out.when(bare("text1") != bare("text3"), "current_without_category_does_not_match_pre_import_revision")


def mark_for_save(text: str) -> str:
    """Masks become templates on every line but the header's title."""
    lines = text.split("\n")
    span = quality.header_span(lines)
    title = lambda i, s: span and span[0] <= i <= span[1] and s.lstrip().lstrip("|").strip().startswith("title") and s.lstrip().startswith("|")
    return "\n".join(s if title(i, s) else plain.mark_redactions(s) for i, s in enumerate(lines))


def _rescue(current: str, imported: str) -> tuple[str, str | None]:
    current, candidate = P.without_review(current), P.without_review(mark_for_save(P.without_review(imported)))
    if quality.official(current) or quality.official(imported):
        return "contains_os_redaction", None
    if plain.same_lines(current) == plain.same_lines(candidate):
        return "candidate_matches_current_after_category_removal", None
    form = lambda t: plain.same_lines(plain.crosses(plain.canonical_redactions(mark_for_save(t))))
    if form(current) != form(candidate):
        return "non_redaction_difference", None
    count = lambda t: plain.template_sum(plain.canonical_redactions(t))
    if count(candidate) <= count(current) and quality.redactions(candidate) >= quality.redactions(current):
        return "candidate_is_not_redaction_markup_improvement", None
    return "redaction_markup_only", candidate.rstrip() + "\n"


def _undo(current: str, imported: str) -> tuple[str, str | None]:
    current = P.without_review(current)
    reason = quality.bad_import(current, imported)
    return (reason, current.rstrip() + "\n") if reason else ("import_not_obviously_bad", None)


def _decide(rows: DataFrame, rule, pair: bool) -> DataFrame:
    """title, action (fix or skip), reason, content. Python sees only the rows that no column expression decides."""
    rows = rows.withColumn("early", _common(pair))

    def run(batches):
        for b in batches:
            found = [rule(c or "", i or "") for c, i in zip(b.text1, b.text2, strict=True)]
            yield pd.DataFrame({"title": b.title, "action": ["fix" if t is not None else "skip" for _, t in found], "reason": [r for r, _ in found], "content": [t for _, t in found]})

    schema = "title string, action string, reason string, content string"
    late = rows.where("early IS NULL").select("title", "text1", "text2").mapInPandas(run, schema)
    early = rows.where("early IS NOT NULL").select("title", F.lit("skip").alias("action"), F.col("early").alias("reason"), F.lit(None).cast("string").alias("content"))
    return early.unionByName(late)


def rescue_redactions(revisions: DataFrame, *, require_pair: bool = True) -> DataFrame:
    """Pages whose reverted import only marks masked text better."""
    return _decide(triplets(revisions), _rescue, require_pair)


def clear_bad_imports(revisions: DataFrame, *, require_pair: bool = True) -> DataFrame:
    """Pages whose reverted import is plainly worse, so that no review is needed."""
    return _decide(triplets(revisions), _undo, require_pair)
