"""Histories by parent links: which revision follows which, whatever order ids and time stamps are in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jurispark.sources.shared import keep


def parent_chains(revisions: DataFrame, *, revision: str = "revid", parent: str = "parentid") -> DataFrame:
    """Adds root, depth (1 at the root), children and orphan to each revision.

    A revision whose parent is 0, null or not there is a root, and an orphan if it names a parent. Revisions with several
    children are branches; ``children`` counts them, so 0 tells the tips. Revisions in or behind a ring of parents have
    neither root nor depth.

    Chains are ranked by pointer jumping: every round, each revision takes over where its pointer points to and adds up the
    way, so a history of n edits takes log2(n) joins and no task walks along it. Those that reached their root leave the
    rounds. Revision ids are taken to be unique, and rows without one are dropped; other columns stay, but for those of
    these four names.
    """
    links = revisions.where(F.col(revision).isNotNull()).drop("root", "depth", "children", "orphan")
    ids = links.select(F.col(revision).alias("__id"), F.nullif(F.col(parent), F.lit(0)).alias("__parent"))
    known = ids.select(F.col("__id").alias("__parent"), F.lit(True).alias("__there"))
    state = keep(ids.join(known, "__parent", "left").select("__id", F.when(F.col("__there"), F.col("__parent")).alias("__at"), (F.col("__parent").isNotNull() & F.col("__there").isNull()).alias("__orphan")))
    children = state.where("__at IS NOT NULL").groupBy(F.col("__at").alias("__id")).agg(F.count(F.lit(1)).alias("children"))
    done = state.where("__at IS NULL").select("__id", F.col("__id").alias("__root"), F.lit(1).cast("long").alias("__depth"))
    left = state.where("__at IS NOT NULL").select("__id", "__at", F.lit(1).cast("long").alias("__way"))
    finished, rounds = [done], left.count().bit_length() + 1
    while rounds and not left.isEmpty():
        # what a pointer points to has a root by now, or points on
        ended = finished[0]
        for part in finished[1:]:
            ended = ended.unionByName(part)
        roots = ended.select(F.col("__id").alias("__at"), "__root", "__depth")
        ahead = left.select(F.col("__id").alias("__at"), F.col("__at").alias("__next"), F.col("__way").alias("__more"))
        met = keep(left.join(roots, "__at", "left").join(ahead, "__at", "left"))
        finished.append(met.where("__root IS NOT NULL").select("__id", "__root", (F.col("__depth") + F.col("__way")).alias("__depth")))
        left = met.where("__root IS NULL").select("__id", F.col("__next").alias("__at"), (F.col("__way") + F.col("__more")).alias("__way"))
        rounds -= 1
    ended = finished[0]
    for part in finished[1:]:
        ended = ended.unionByName(part)
    found = state.select("__id", "__orphan").join(ended, "__id", "left").join(children, "__id", "left")
    added = found.select(F.col("__id"), F.col("__root").alias("root"), F.col("__depth").alias("depth"), F.coalesce("children", F.lit(0)).cast("long").alias("children"), F.col("__orphan").alias("orphan"))
    return links.join(added, links[revision] == added["__id"]).drop("__id")


def movable(moves: DataFrame, pages: DataFrame, revisions: DataFrame) -> DataFrame:
    """moves (source, target) with ``movable``: the target is a redirect to the source and has one revision only.

    pages: title, redirect (null: a page of its own); revisions: title. Revisions are counted for the targets alone.
    """
    asked = moves.select(F.col("target").alias("title")).distinct()
    counts = revisions.join(asked, "title", "left_semi").groupBy("title").agg(F.count(F.lit(1)).alias("__n"))
    state = asked.join(pages.select("title", F.col("redirect").alias("__to")), "title").join(counts, "title", "left").withColumnRenamed("title", "target")
    good = F.col("__to").eqNullSafe(F.col("source")) & F.col("source").isNotNull() & F.col("__n").eqNullSafe(F.lit(1))
    return moves.join(state, "target", "left").withColumn("movable", F.coalesce(good, F.lit(False))).select(*moves.columns, "movable")
