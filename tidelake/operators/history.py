"""Validity intervals of slowly changing attributes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidelake.operators.dedup import keep_latest
from tidelake.session import checkpointed
from tidelake.sources.versioned import VersionedTable

# Fixed values
OPEN_END = "9999-12-31"


def versions(changes: DataFrame, key: str, day: str, attributes: Sequence[str],
             newest_first: Sequence[Column]) -> DataFrame:
    """``(key, attributes, valid_from, valid_to, is_current)`` from dated attribute values.

    Several values on one day collapse to the last one first, so a window partition
    holds at most one row per calendar day of its key. Pass only the columns needed:
    whatever else is in ``changes`` takes part in the tie-break.
    """
    daily = keep_latest(changes, [key, day], newest_first).select(key, day, *attributes)
    window = Window.partitionBy(key).orderBy(F.col(day).asc_nulls_last())
    same = reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.lag(a).over(window)) for a in attributes])
    is_first = F.row_number().over(window) == 1
    changed = (daily.withColumn("_changed", is_first | ~same)
               .where("_changed").drop("_changed"))
    following = F.lead(day).over(window)
    return changed.select(
        key, *attributes, F.col(day).alias("valid_from"),
        F.coalesce(F.date_sub(following, 1), F.lit(OPEN_END).cast("date")).alias("valid_to"),
        following.isNull().alias("is_current"))



# --- stored histories ---------------------------------------------------------------

def changed_versions(stored: DataFrame, changes: DataFrame, key: str, day: str, attributes: Sequence[str],
                     newest: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """What a batch of late, corrected or new values does to a stored history: ``(versions to add, (key, valid_from) to remove)``.

    A stored version keeps its ``points``: the days on which its attributes were told, with the ``newest`` columns of each, so
    that a later batch can overrule one of them. Of several values of a key and day, in whatever batches they come, the one with
    the greatest ``newest`` columns stays, then the one with the greatest attributes; any order of batches thus gives one history.
    Only versions that a change falls into and their neighbours are cut anew: a change splits, shortens, joins or removes those.
    Changes without key or day are left out. A window holds a version or change per calendar day of its key at most.
    """
    told = F.struct(F.struct(*newest).alias("rank"), *attributes)
    daily = changes.where(F.col(key).isNotNull() & F.col(day).isNotNull()).groupBy(F.col(key).alias("_k"), F.col(day).alias("_day")).agg(
        F.max(told).alias("_told"))
    mine = stored.withColumnRenamed(key, "_k").join(daily.select("_k").distinct(), "_k", "left_semi")
    in_order = Window.partitionBy("_k").orderBy("_at", F.col("_told").isNotNull())
    placed = mine.select("_k", F.col("valid_from").alias("_at"), F.lit(None).cast(daily.schema["_told"].dataType).alias("_told")).unionByName(
        daily.withColumnRenamed("_day", "_at")).withColumn("_holder", F.last(F.when(F.col("_told").isNull(), F.col("_at")), True).over(in_order))
    placed = placed.where("_told IS NOT NULL")
    hit = placed.groupBy("_k", F.col("_holder").alias("_from")).agg(F.lit(True).alias("_hit"))
    by_day = Window.partitionBy("_k").orderBy("valid_from")
    early = hit.where("_from IS NULL").select(F.col("_k").alias("_early"))
    marked = mine.join(hit.where("_from IS NOT NULL").withColumnRenamed("_k", "_of"), (F.col("_k") == F.col("_of")) & (
        F.col("valid_from") == F.col("_from")), "left").join(early, F.col("_k") == F.col("_early"), "left").withColumn(
        "_hit", F.coalesce("_hit", F.lit(False)))
    near = (F.col("_hit") | F.coalesce(F.lag("_hit").over(by_day), F.lit(False)) | F.coalesce(F.lead("_hit").over(by_day), F.lit(False))
            | (F.col("_early").isNotNull() & (F.row_number().over(by_day) == 1)))
    marked = marked.withColumn("_near", near).withColumn("_island", F.sum((~F.col("_near")).cast("int")).over(by_day)).where("_near")

    # an island is a run of neighbouring versions that are cut anew; its last one ends where it ended
    parts = marked.select("_k", "_island", "valid_from", "valid_to", F.explode("points").alias("p"), *attributes).select(
        "_k", "_island", F.col("p.day").alias("_at"), F.struct(F.col("p.rank").alias("rank"), *attributes).alias("_told"))
    where = marked.select(F.col("_k").alias("_of"), F.col("valid_from").alias("_from"), "_island")
    first = marked.groupBy("_k").agg(F.min("_island").alias("_first")).withColumnRenamed("_k", "_own")
    joined = placed.join(where, (F.col("_k") == F.col("_of")) & (F.col("_holder") == F.col("_from")), "left").join(
        first, F.col("_k") == F.col("_own"), "left").select("_k", F.coalesce("_island", "_first", F.lit(0)).alias("_island"), "_at", "_told")
    points = parts.unionByName(joined).groupBy("_k", "_island", "_at").agg(F.max("_told").alias("_told"))
    in_island = Window.partitionBy("_k", "_island").orderBy("_at")
    same = reduce(lambda a, b: a & b, [F.col(f"_told.{a}").eqNullSafe(F.lag(f"_told.{a}").over(in_island)) for a in attributes])
    starts = points.withColumn("_starts", (F.row_number().over(in_island) == 1) | ~same)
    numbered = starts.withColumn("_number", F.sum(F.col("_starts").cast("int")).over(in_island))
    cut = numbered.groupBy("_k", "_island", "_number").agg(
        F.min("_at").alias("valid_from"), F.max("_told").alias("_one"),
        F.array_sort(F.collect_list(F.struct(F.col("_at").alias("day"), F.col("_told.rank").alias("rank")))).alias("points"))
    ends = marked.groupBy(F.col("_k").alias("_of"), F.col("_island").alias("_in")).agg(F.max("valid_to").alias("_end"))
    following = F.lead("valid_from").over(Window.partitionBy("_k", "_island").orderBy("valid_from"))
    open_end = F.lit(OPEN_END).cast("date")
    added = cut.withColumn("_next", following).join(ends, (F.col("_k") == F.col("_of")) & (F.col("_island") == F.col("_in")), "left").withColumn(
        "valid_to", F.coalesce(F.date_sub("_next", 1), "_end", open_end)).select(
        F.col("_k").alias(key), *[F.col(f"_one.{a}").alias(a) for a in attributes], "valid_from", "valid_to",
        (F.col("valid_to") == open_end).alias("is_current"), "points")
    return added, marked.select(F.col("_k").alias(key), "valid_from")


def apply_changes(table: VersionedTable, changes: DataFrame, key: str, day: str, attributes: Sequence[str], newest: Sequence[str]) -> int | None:
    """Bring a stored history up to date with a batch of changes in one commit; its version, None where nothing changed.

    The table should be clustered by key and ``valid_from``. See ``changed_versions``; ``current_history`` reads it.
    """
    if table.version() is None:
        fields = changes.select(F.col(key), *attributes, F.col(day).cast("date").alias("valid_from"), F.col(day).cast("date").alias("valid_to"),
                                F.lit(True).alias("is_current"), F.array(F.struct(F.col(day).cast("date").alias("day"),
                                                                                  F.struct(*newest).alias("rank"))).alias("points"))
        table.overwrite(fields.limit(0))
    added, gone = changed_versions(table.read(), changes.withColumn(day, F.col(day).cast("date")), key, day, attributes, newest)
    added, gone = checkpointed(added), checkpointed(gone)
    return table.replace_keys(added, gone.union(added.select(key, "valid_from")))


def current_history(table: VersionedTable) -> DataFrame:
    """``(key, attributes, valid_from, valid_to, is_current)`` of the stored history."""
    return table.read().drop("points")
