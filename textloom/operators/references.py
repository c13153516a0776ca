"""Orphan references: keys that are used but are missing, deleted or not there yet.

Both sides are change logs. A catalogue stay adds one to its key's existence count on the day it
starts and takes it off on the day it ends; a record adds one to its key's reference count on the
record's day. Summed per (key, day) -- which bounds the rows of any one key by the number of days,
however many records cite it -- and accumulated along the days, a day with references and no
positive existence count is an orphan day. The records are then found by a join on (key, day).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A day before all others, for stays without a start.
ALWAYS = "0000-01-01"


def clean_key(c: Column) -> Column:
    """Upper case, outer white space removed; blank becomes null."""
    k = F.upper(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))
    return F.when(k != "", k)


def iso_day(c: Column) -> Column:
    """The first ten characters where they are a date ``YYYY-MM-DD``, else null."""
    d = F.substring(F.trim(c), 1, 10)
    return F.when(d.rlike(r"^\d{4}-\d{2}-\d{2}$"), d)


def existence_deltas(stays: DataFrame, key: str = "source_id", start: str = "access_date", end: str = "removed_date") -> DataFrame:
    """(key, day, exist, stays): +1 where a stay starts, -1 where it ends.

    A stay that ends on or before its start never holds: it counts as a row of its key and as a
    start (``stays``), but adds nothing to the existence count. Null or unreadable starts mean
    "always", null or unreadable ends "never left".
    """
    s = stays.select(clean_key(F.col(key)).alias("key"), F.coalesce(iso_day(F.col(start)), F.lit(ALWAYS)).alias("a"), iso_day(F.col(end)).alias("z"))
    s = s.where(F.col("key").isNotNull())
    holds = F.coalesce(F.col("z") > F.col("a"), F.lit(True)).cast("long")
    steps = F.array(
        F.struct(F.col("a").alias("day"), holds.alias("exist"), F.lit(1).cast("long").alias("stays")),
        F.struct(F.col("z").alias("day"), (-holds).alias("exist"), F.lit(0).cast("long").alias("stays")),
    )
    return (
        s.select("key", F.inline(F.filter(steps, lambda x: x["day"].isNotNull())))
        .groupBy("key", "day")
        .agg(F.sum("exist").alias("exist"), F.sum("stays").alias("stays"))
    )


def merge_counts(state: DataFrame, deltas: DataFrame) -> DataFrame:
    """One step of upkeep: state and deltas are (key, refs, exist), signed; zero rows vanish."""
    return (
        state.unionByName(deltas)
        .groupBy("key")
        .agg(F.sum("refs").alias("refs"), F.sum("exist").alias("exist"))
        .where((F.col("refs") != 0) | (F.col("exist") != 0))
    )


def current_orphans(state: DataFrame) -> DataFrame:
    """Keys with positive references and no existence."""
    return state.where((F.col("refs") > 0) & (F.col("exist") <= 0)).select("key", "refs")


def orphan_references(refs: DataFrame, stays: DataFrame) -> DataFrame:
    """Rows of ``refs`` (table_name, record_id, source_key, day) whose key does not hold on its day, with ``kind``.

    kind: ``missing`` (the key has no stay), ``late`` (the day lies before its first start) or
    ``deleted`` (stays, none of which holds). A null day can only be ``missing``. Null and blank
    keys are no references. Repeated rows come out once; extra columns of either side are ignored.
    Empty ``stays`` makes every reference ``missing``; empty ``refs`` gives no rows.
    """
    refs = refs.select("table_name", "record_id", clean_key(F.col("source_key")).alias("source_key"), "day").where(F.col("source_key").isNotNull())
    exist = existence_deltas(stays).select("key", "day", "exist", "stays", F.lit(0).cast("long").alias("refs"))
    used = refs.groupBy(F.col("source_key").alias("key"), "day").agg(F.count(F.lit(1)).alias("refs"))
    used = used.select("key", "day", F.lit(0).cast("long").alias("exist"), F.lit(0).cast("long").alias("stays"), "refs")
    log = exist.unionByName(used).groupBy("key", "day").agg(*(F.sum(c).alias(c) for c in ("exist", "stays", "refs")))
    # null days sort first: their running counts hold no stay, so the whole key's total decides
    so_far = Window.partitionBy("key").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("key")
    log = log.select("key", "day", "refs", F.sum("exist").over(so_far).alias("exist"), F.sum("stays").over(so_far).alias("begun"), F.sum("stays").over(whole).alias("stays"))
    kind = (
        F.when(F.col("stays") == 0, "missing")
        .when(F.col("day").isNull(), F.lit(None).cast("string"))
        .when(F.col("begun") == 0, "late")
        .when(F.col("exist") <= 0, "deleted")
    )
    bad = log.where(F.col("refs") > 0).select(F.col("key").alias("source_key"), "day", kind.alias("kind")).where(F.col("kind").isNotNull())
    # The day's null must meet itself: a stand-in keeps this an ordinary hash join.
    bad = bad.select("source_key", F.coalesce("day", F.lit("")).alias("_d"), "kind")
    out = refs.withColumn("_d", F.coalesce("day", F.lit(""))).join(bad, ["source_key", "_d"])
    return out.select("table_name", "record_id", "source_key", "day", "kind").distinct()


def reference_log(interactions: DataFrame, chunks: DataFrame) -> DataFrame:
    """The references of both tables as (table_name, record_id, source_key, day)."""
    a = interactions.select(
        F.lit("interaction_examples").alias("table_name"),
        F.col("interaction_id").alias("record_id"),
        F.explode("citations").alias("source_key"),
        F.date_format("created_at", "yyyy-MM-dd").alias("day"),
    )
    b = chunks.select(F.lit("reference_chunks").alias("table_name"), F.col("chunk_id").alias("record_id"), F.col("source_id").alias("source_key"), iso_day(F.col("accessed_at")).alias("day"))
    return a.unionByName(b)


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphans counted per table, month and kind; records without a date under a null month."""
    return orphans.groupBy("table_name", F.substring("day", 1, 7).alias("month"), "kind").agg(F.count(F.lit(1)).alias("n_references"), F.countDistinct("source_key").alias("n_keys"))
