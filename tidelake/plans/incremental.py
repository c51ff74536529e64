"""Merges that follow what changed: files are compared one by one, and only the rows of touched units are computed anew.

A unit is what is merged together, such as a symbol. The state remembers which units each bronze file holds. Of new, changed and
removed files it tells the units they touch, and of those all files that feed them: these are read again, and rows of the target that
came out otherwise are replaced in one commit. A row that no file gives any more is thereby withdrawn.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelake.operators import dedup
from tidelake.plans import jobs
from tidelake.session import checkpointed
from tidelake.sources import raw
from tidelake.sources.versioned import URI, VersionedTable, path_of

#: Files named to a reader one by one; more are read through their root and joined.
NAMED_FILES = 10_000


@dataclass(frozen=True)
class Merge:
    """``rows(spark, path or paths)`` gives all versions, ``latest`` the one of each key; both hold the columns of ``unit`` and ``key``."""
    rows: Callable[[SparkSession, str | list[str]], DataFrame]
    latest: Callable[[DataFrame], DataFrame]
    unit: Sequence[str]
    key: Sequence[str]
    partition_by: Sequence[str]
    glob: str = "*.ndjson"


MARKET = Merge(jobs.market_rows, jobs.latest_market, ("symbol",), ("symbol", "date"), ("year",))
MACRO = Merge(jobs.macro_rows, dedup.latest_observations, ("indicator_id",), ("indicator_id", "country_iso3", "date"), ("year",))


def target_table(spark: SparkSession, root: str, merge: Merge, rows_per_file: int = 0) -> VersionedTable:
    return VersionedTable(spark, root, merge.partition_by, merge.key, rows_per_file)


def state_table(spark: SparkSession, root: str, rows_per_file: int = 0) -> VersionedTable:
    return VersionedTable(spark, root, [], ["path"], rows_per_file)


@dataclass(frozen=True)
class Outcome:
    """Numbers of files that were new, changed and gone, and the target's version, None where it stayed as it was."""
    added: int
    changed: int
    removed: int
    version: int | None

    @property
    def any(self) -> bool:
        return self.added + self.changed + self.removed > 0


def plain(path: Column) -> Column:
    """A local path without its scheme, which listings and readers spell differently."""
    return F.regexp_replace(path, "^file:/+", "/")


def difference(now: DataFrame, known: DataFrame) -> DataFrame:
    """``(path, length, modified_ms, status)`` of files that are new, changed (by length or time) or removed."""
    old = known.select(F.col("path").alias("old_path"), F.col("length").alias("old_length"), F.col("modified_ms").alias("old_ms"))
    status = F.when(F.col("old_path").isNull(), "added").when(F.col("path").isNull(), "removed").when(
        ~F.col("length").eqNullSafe(F.col("old_length")) | ~F.col("modified_ms").eqNullSafe(F.col("old_ms")), "changed")
    return now.join(old, F.col("path") == F.col("old_path"), "full").withColumn("status", status).where("status IS NOT NULL").select(
        F.coalesce("path", "old_path").alias("path"), "length", "modified_ms", "status")


def run(spark: SparkSession, merge: Merge, bronze: str, target: VersionedTable, state: VersionedTable) -> Outcome:
    """Bring the target to what a full merge of the bronze files gives.

    A run that fails between the target's commit and the state's does its work again the next time, with the same result.
    """
    unit = list(merge.unit)
    rows_of = lambda paths: merge.rows(spark, paths).withColumn("_uri", F.col(URI))
    now = checkpointed(raw.list_files(spark, bronze, merge.glob).withColumn("path", plain(F.col("path"))))
    first = state.version() is None
    known = now.limit(0).select("*", F.lit(False).alias("filled")) if first else state.read()
    differing = checkpointed(difference(now, known.select("path", "length", "modified_ms").distinct()))
    counts = {r["status"]: r["count"] for r in differing.groupBy("status").count().collect()}
    outcome = Outcome(counts.get("added", 0), counts.get("changed", 0), counts.get("removed", 0), None)
    if not outcome.any:
        return outcome

    def read(paths: DataFrame) -> DataFrame:
        """All rows of the files; few files are named to the reader, many are picked by their path."""
        named = [r["path"] for r in paths.limit(NAMED_FILES + 1).collect()]
        if len(named) <= NAMED_FILES:
            return rows_of(named) if named else rows_of(bronze).limit(0)
        wanted = paths.select(F.col("path").alias("_wanted"))
        return rows_of(bronze).join(wanted, plain(path_of("_uri")) == F.col("_wanted"), "left_semi")

    present = differing.where("status <> 'removed'")
    fresh = rows_of(bronze) if first else read(present.select("path"))
    pairs = checkpointed(fresh.select("_uri", *unit).distinct().withColumn("_path", plain(path_of("_uri"))).drop("_uri"))
    entries = present.join(pairs, F.col("path") == F.col("_path"), "left").select(
        "path", "length", "modified_ms", F.col("_path").isNotNull().alias("filled"), *unit)
    if first:
        version = target.overwrite(merge.latest(fresh.drop("_uri")))
        state.overwrite(entries)
        return Outcome(outcome.added, 0, 0, version)

    stale = known.join(differing.where("status <> 'added'").select(F.col("path").alias("_old")), F.col("path") == F.col("_old"), "left_semi")
    touched = checkpointed(stale.where("filled").select(*unit).union(pairs.select(*unit)).distinct())
    same = VersionedTable._all([F.col(f"`{c}`").eqNullSafe(F.col(f"_unit_{c}")) for c in unit])
    units = touched.select([F.col(c).alias(f"_unit_{c}") for c in unit])
    feeding = known.where("filled").join(units, same, "left_semi").select("path").distinct().join(
        differing.select(F.col("path").alias("_old")), F.col("path") == F.col("_old"), "left_anti")
    others = checkpointed(feeding)
    every = fresh.unionByName(read(others)) if not others.isEmpty() else fresh
    latest = checkpointed(merge.latest(every.drop("_uri").join(units, same, "left_semi")))
    stored = target.read()
    held = stored.join(units, same, "left_semi").select(latest.columns)
    keys = checkpointed(latest.exceptAll(held).union(held.exceptAll(latest)).select(*merge.key).distinct())
    version = None
    if not keys.isEmpty():
        wanted = keys.select([F.col(c).alias(f"_key_{c}") for c in merge.key])
        equal = VersionedTable._all([F.col(f"`{c}`").eqNullSafe(F.col(f"_key_{c}")) for c in merge.key])
        version = target.replace_keys(latest.join(wanted, equal, "left_semi"), keys)
    state.replace_keys(entries, differing.select("path"))
    return Outcome(outcome.added, outcome.changed, outcome.removed, version)
