"""Dense surrogate keys without funnelling the table through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidelake.session import checkpointed

SLICE = "_slice"


def highest_key(table: DataFrame, key: str) -> DataFrame:
    """One row: the largest key in use, 0 for an empty table."""
    return table.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("base"))


def with_dense_key(rows: DataFrame, order: Sequence[str], key: str,
                   existing: DataFrame | None = None) -> DataFrame:
    """Number ``rows`` 1..n by ``order`` (unique), continuing after ``existing``'s keys; an unknown member below 0 has no say.

    The rows are range-partitioned into slices and checkpointed, since the sampled
    range bounds must not change between counting and numbering. Offsets come from one
    count per slice; the largest existing key enters as the slice before the first.
    The only unpartitioned window therefore sees one row per shuffle partition.
    """
    sliced = checkpointed(rows.repartitionByRange(*order).withColumn(SLICE, F.spark_partition_id()))
    sizes = sliced.groupBy(SLICE).agg(F.count(F.lit(1)).alias("_size"))
    if existing is not None:
        base = highest_key(existing, key).select(F.lit(-1).alias(SLICE), F.greatest("base", F.lit(0)).alias("_size"))
        sizes = sizes.unionByName(base)
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(SLICE, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy(SLICE).orderBy(*order)
    return (sliced.join(F.broadcast(offsets), SLICE)
            .withColumn(key, (F.col("_offset") + F.row_number().over(within)).cast("bigint"))
            .drop(SLICE, "_offset"))
