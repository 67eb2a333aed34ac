"""Ordinals, ordered cuts, first-wins operators and keyed lookups, without a task that sees all rows.

Global running sums go in two steps: totals of each block, summed over the few blocks, then a window inside a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jurispark.sources.shared import keep, spread

#: Rows of an ordinal block.
BLOCK = 1 << 20


def with_ordinal(df: DataFrame, name: str = "ordinal", by: tuple[str, ...] = ()) -> DataFrame:
    """1-based position: place inside the partition plus the rows of the partitions before. Rows lie in the order of their
    partitions, so a sorted frame is numbered in its order; those of a scan lie in the order of ``by``, columns that
    tell a split from all others (a scan deals out splits by size, not by name).

    Rows are written once with their places, and both the counts and the positions come from what was written: a frame that
    is evaluated twice may be dealt out in another way the second time. The rows are neither shuffled nor sorted; what is
    broadcast is one row a split.
    """
    rows = keep(df.withColumn("__m", F.monotonically_increasing_id())).withColumn("__p", F.shiftright("__m", 33))
    splits = rows.groupBy(*by, "__p").agg(F.count(F.lit(1)).alias("__n"), F.min("__m").alias("__first"))
    before = Window.orderBy(*by, "__p").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select(*by, "__p", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__s"))
    return rows.join(F.broadcast(starts), [*by, "__p"]).withColumn(name, F.col("__s") + F.col("__m") - F.col("__first") + 1).select(*df.columns, name)


def running_total(df: DataFrame, value: Column, order: str, name: str = "running", block: int = BLOCK) -> DataFrame:
    """Sum of ``value`` over all rows before this one in the order of a whole-number column, this one excluded."""
    rows = df.withColumn("__v", value.cast("long")).withColumn("__b", F.floor(F.col(order) / block))
    totals = rows.groupBy("__b").agg(F.sum("__v").alias("__t"))
    starts = totals.select("__b", F.coalesce(F.sum("__t").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__s"))
    inside = Window.partitionBy("__b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(starts, "__b").withColumn(name, F.col("__s") + F.coalesce(F.sum("__v").over(inside), F.lit(0))).drop("__v", "__b", "__s")


def first_n_successes(df: DataFrame, success: Column, n: int, order: str) -> DataFrame:
    """Rows up to and with the n-th success; what comes behind is cut, failures before stay. 0 or less: all rows."""
    if n <= 0:
        return df
    return running_total(df, success.cast("int"), order, "__before").where(F.col("__before") < n).drop("__before")


def resume_after(df: DataFrame, last: int, order: str) -> DataFrame:
    return df.where(F.col(order) > last)


def slice_eligible(df: DataFrame, eligible: Column, skip: int, limit: int, order: str) -> DataFrame:
    """Eligible rows behind the first ``skip``, at most ``limit`` (0: all); offsets count eligible rows only."""
    rows = running_total(df.where(eligible), F.lit(1), order, "__at").where(F.col("__at") >= skip)
    return (rows.where(F.col("__at") < skip + limit) if limit > 0 else rows).drop("__at")


def first_by_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key; a key's rows meet as one row from each task."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("__r"))
    return best.select(*keys, *[F.col(f"__r.`{c}`").alias(c) for c in rest]).select(df.columns)


def latest(df: DataFrame, key: str, order: list[Column], n: int) -> DataFrame:
    """The first n rows of each key in an order, numbered from 1 as ``place``."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("place") <= n)


def anti_dedupe(df: DataFrame, existing: DataFrame, key: str, order: str) -> DataFrame:
    """Adds ``outcome``: exists, duplicate of an earlier row, or new. Nulls are new.

    Rows are written once, as they go three ways. Those without a key meet nothing and stay out of the joins, where all
    of them would be one task's.
    """
    rows = keep(df)
    keyed = rows.where(F.col(key).isNotNull())
    n = keyed.count()
    known = spread(existing.select(key), n, key).distinct().withColumn("__known", F.lit(True))
    first = keyed.groupBy(key).agg(F.min(order).alias("__first"))
    outcome = F.when(F.col("__known"), "exists").when(F.col(order) > F.col("__first"), "duplicate").otherwise("new")
    met = spread(keyed, n, key).join(known, key, "left").join(first, key, "left").select(*df.columns, outcome.alias("outcome"))
    return met.unionByName(rows.where(F.col(key).isNull()).withColumn("outcome", F.lit("new")))


def positional_join(left: DataFrame, right: DataFrame, order: str) -> DataFrame:
    """Pairs rows by position: both are numbered in their order, and surplus rows are dropped. Right columns get ``new_``."""
    a = running_total(left, F.lit(1), order, "position")
    b = running_total(right, F.lit(1), order, "position")
    b = b.select("position", *[F.col(c).alias(f"new_{c}") for c in right.columns])
    return a.join(b, "position")


def semi_join_last(df: DataFrame, wanted: DataFrame, key: str, order: str) -> DataFrame:
    """For each wanted key, its last row; keys without rows are missing."""
    rest = [c for c in df.columns if c != key]
    found = df.join(wanted.select(key).distinct(), key, "left_semi")
    return found.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("__r")).select(key, *[F.col(f"__r.`{c}`").alias(c) for c in rest])


def union_ragged(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def first_tag(titles: DataFrame, title: str, tag: str, order: str) -> DataFrame:
    """Each title with the tag under which it is seen first."""
    return titles.groupBy(title).agg(F.min_by(tag, F.struct(order, tag)).alias(tag))


def resolve_redirects(pages: DataFrame, hops: int = 10) -> DataFrame:
    """pages: title, target (null: no redirect). Adds ``resolved`` and ``hops``; a loop, a longer chain or a missing
    page gives null.

    Chains are halved: each round joins every pending title with what its target has come to, so ten hops take
    four joins.
    """
    # after k rounds a state stands for up to 2^k hops; finished states stop growing
    state = pages.select("title", F.coalesce("target", "title").alias("at"), F.when(F.col("target").isNull(), 0).otherwise(1).alias("hops"))
    rounds = max(1, hops.bit_length())
    for _ in range(rounds):
        ahead = state.select(F.col("title").alias("at"), F.col("at").alias("__at"), F.col("hops").alias("__h"))
        state = state.join(ahead, "at", "left").select("title", F.coalesce("__at", "at").alias("at"), (F.col("hops") + F.coalesce("__h", F.lit(0))).alias("hops"))
    final = pages.where("target IS NULL").select(F.col("title").alias("at"), F.lit(True).alias("__end"))
    done = state.join(final, "at", "left")
    good = F.col("__end") & (F.col("hops") <= hops)
    return pages.join(done.select("title", F.when(good, F.col("at")).alias("resolved"), F.when(good, F.col("hops")).alias("hops")), "title", "left")


def seeded_sample(df: DataFrame, key: str, satisfied: Column, n: int, seed: int) -> DataFrame:
    """n rows that satisfy a condition, in an order that the seed fixes."""
    return df.where(satisfied).orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)


def tail(df: DataFrame, order: str, n: int) -> DataFrame:
    return df.orderBy(F.desc(order)).limit(n)


def ordered_distinct(values: Column) -> Column:
    """Trimmed, filled values, each where it comes first."""
    trimmed = F.transform(values, lambda v: F.trim(v))
    return F.array_distinct(F.filter(trimmed, lambda v: v.isNotNull() & (v != "")))


def day_window(day: str, zone: str) -> tuple[Column, Column]:
    """The local day as a half-open window in UTC."""
    start = F.lit(day).cast("timestamp_ntz")
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), start), F.convert_timezone(F.lit(zone), F.lit("UTC"), start + F.expr("INTERVAL 1 DAY"))
