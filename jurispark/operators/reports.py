"""Page sources as tables, counters and reports of jobs, and what no set of titles covers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jurispark.functions import text as T
from jurispark.functions import wiki as W

#: A page as the API gives it.
API_PAGE = "title string, pageid long, missing boolean, revisions array<struct<slots: struct<main: struct<content: string>>>>"


def page_records(answers: DataFrame, column: str = "value") -> DataFrame:
    """One row for each page of API answers (``query.pages``): title, exists, page_id, content.

    A page exists unless it is marked as missing; an existing one without a revision has no content, one whose
    revision holds none has an empty one.
    """
    pages = F.from_json(F.get_json_object(column, "$.query.pages"), f"array<struct<{_fields(API_PAGE)}>>")
    rows = answers.select(F.explode(pages).alias("p")).select("p.*")
    exists = F.col("missing").isNull()
    content = F.when(exists & (F.size("revisions") > 0), T.or_empty(F.get("revisions", 0)["slots"]["main"]["content"]))
    return rows.select(T.or_empty(F.col("title")).alias("title"), exists.alias("exists"), F.col("pageid").alias("page_id"), content.alias("content"))


def _fields(schema: str) -> str:
    name_type = (part.split(" ", 1) for part in schema.split(", "))
    return ", ".join(f"{n}: {t}" for n, t in name_type)


def category_members(pages: DataFrame, category: str, *, namespaces=("Talk", "User", "Template", "Category", "Portal", "Help", "分类", "模板", "用户")) -> DataFrame:
    """Titles of pages of the main namespace whose text names the category, in the order of the titles."""
    line = rf"(?im)^\s*\[\[\s*(?:Category|分类|分類)\s*:\s*\Q{category}\E\s*(?:\|[^\]\n]*)?\]\]\s*$"
    outside = F.col("title").rlike(f"(?i)^(?:{'|'.join(namespaces)})(?: talk)?:")
    return pages.where(T.or_empty(F.col("content")).rlike(line) & ~outside).select("title").orderBy("title")


def tagged_contributions(contributions: DataFrame, user: str, tag: str) -> DataFrame:
    """A user's contributions that carry a tag. contributions: user, tags (an array), ..."""
    return contributions.where((F.col("user") == user) & F.array_contains("tags", tag))


#: Statuses of an upload, and the counter that each adds to. Fixed values.
UPLOADED = {"uploaded": "uploaded", "reverted_overwrite": "uploaded", "failed": "failed", "skipped": "skipped", "conflict_resolved": "resolved", "overwritable": "overwritable"}


def upload_counters(results: DataFrame) -> DataFrame:
    """uploaded, failed, skipped, resolved, overwritable over all results; an overwrite that was reverted is an upload."""
    names = dict.fromkeys(UPLOADED.values())
    return results.agg(*[F.count_if(F.col("status").isin(*[s for s, n in UPLOADED.items() if n == name])).alias(name) for name in names])


def job_counters(results: DataFrame, reasons: Column) -> DataFrame:
    """processed, created, skipped and one counter for each reason of a redirect job's rows; skipped is the sum of four.
    ``reasons`` gives missing_page, missing_metadata, redirect_exists, invalid_input, failed or null for a row."""
    rows = results.select(reasons.alias("reason"))
    skips = ("missing_page", "missing_metadata", "redirect_exists", "invalid_input")
    count = lambda *names: F.count_if(F.col("reason").isin(*names))
    return rows.agg(F.count(F.lit(1)).alias("processed"), F.count_if(F.col("reason").isNull()).alias("created"), *[count(s).alias(s) for s in skips], count("failed").alias("failed"), count(*skips).alias("skipped_total"))


def run_report(results: DataFrame, *, action: str = "action", error: str = "error") -> tuple[DataFrame, DataFrame]:
    """What each title came to (title, action, status, error) and how often each action and status came about."""
    failed = F.col(error).isNotNull()
    rows = results.select("title", F.when(~failed, F.col(action)).alias("action"), F.when(failed, "failed").otherwise("ok").alias("status"), F.col(error).alias("error"))
    return rows, rows.groupBy("action", "status").agg(F.count(F.lit(1)).alias("n"))


def throughput(counters: DataFrame, seconds: float, *columns: str) -> DataFrame:
    """Rows a second, by the sum of counters; 0 where no time went by."""
    total = reduce(lambda a, b: a + b, [F.col(c) for c in columns])
    return counters.withColumn("per_second", total / F.lit(float(seconds)) if seconds > 0 else F.lit(0.0))


def unclassified(titles: DataFrame, *sets: DataFrame) -> DataFrame:
    """Titles that are in none of some sets of titles. A job that must know them all stops if there is any."""
    known = reduce(lambda a, b: a.unionByName(b), [s.select("title") for s in sets]).distinct()
    return titles.join(known, "title", "left_anti")


def require_classified(titles: DataFrame, *sets: DataFrame, show: int = 20) -> None:
    some = unclassified(titles, *sets).select("title").orderBy("title").limit(show).collect()
    if some:
        raise ValueError(f"unclassified pages: {[r.title for r in some]}")


def header_rows(pages: DataFrame) -> DataFrame:
    """title, key, value of each header parameter."""
    return pages.select("title", F.explode(W.header(F.col("content"))).alias("key", "value"))
