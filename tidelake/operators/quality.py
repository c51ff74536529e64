"""Contracts as DataFrames: an empty result means the contract holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def duplicate_keys(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (table.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
            .where(F.col("row_count") > 1))


def orphan_keys(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Foreign keys without a dimension row, with how many facts use them.

    Facts are counted per key before the join, so a hot orphan is one row there.
    """
    used = facts.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return used.join(dimension.select(key), key, "left_anti")


def null_keys(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows miss each mandatory column."""
    counts = table.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in keys])
    return counts.unpivot([], list(keys), "column_name", "null_rows")


def reconcile(source: DataFrame, written: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(expected_rows, written_rows, matches)``: distinct source keys against a table."""
    expected = source.select(*keys).distinct().agg(F.count(F.lit(1)).alias("n"))
    actual = written.agg(F.count(F.lit(1)).alias("n"))
    return (expected.select(F.lit("expected_rows").alias("side"), "n")
            .unionByName(actual.select(F.lit("written_rows").alias("side"), "n"))
            .agg(F.sum(F.when(F.col("side") == "expected_rows", F.col("n"))).alias("expected_rows"),
                 F.sum(F.when(F.col("side") == "written_rows", F.col("n"))).alias("written_rows"))
            .withColumn("matches", F.col("expected_rows") == F.col("written_rows")))


def has_columns(table: DataFrame, *names: str) -> bool:
    """Schema check only; starts no job."""
    return set(names) <= set(table.columns)
