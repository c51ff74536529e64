"""Windows over raw rows, of which one key may hold any share: its rows are cut into blocks, and totals carried across.

A range exchange on keys and order deals a hot key's rows to many tasks. What crosses tasks are one row per task and key (counts and
totals) and, for frames, the few rows before each block.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidelake.session import checkpointed

BLOCK_ROWS = 1_000_000


def with_running(rows: DataFrame, keys: Sequence[str], order: Sequence[str], totals: dict[str, Column]) -> DataFrame:
    """Running totals per key, each over all rows up to the current one; a null adds nothing, and before any value the total is null.

    ``order`` must be total within a key, else rows that tie share no defined sequence. Null keys form a key of their own.
    Totals are sums, exact for integers and decimals.
    """
    named = rows.withColumns({f"__v_{name}": value for name, value in totals.items()})
    spread = named.repartitionByRange(*keys, *order).withColumn("__segment", F.spark_partition_id())
    stored = checkpointed(spread)  # the sampled bounds of the ranges must not change between totals and rows
    window = Window.partitionBy("__segment", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = stored.withColumns({f"__v_{name}": F.sum(f"__v_{name}").over(window) for name in totals})
    before = Window.partitionBy(*[f"__k_{k}" for k in keys]).orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    carried = stored.groupBy(F.col("__segment").alias("__s"), *[F.col(k).alias(f"__k_{k}") for k in keys]).agg(
        *[F.sum(f"__v_{name}").alias(f"__t_{name}") for name in totals]).withColumns(
        {f"__t_{name}": F.sum(f"__t_{name}").over(before) for name in totals})
    same = F.col("__segment") == F.col("__s")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    total = lambda name: F.coalesce(F.col(f"__t_{name}") + F.col(f"__v_{name}"), F.col(f"__v_{name}"), F.col(f"__t_{name}"))
    return local.join(carried, same, "left").select(*[F.col(f"`{c}`") for c in rows.columns], *[total(name).alias(name) for name in totals])


def over_blocks(rows: DataFrame, keys: Sequence[str], order: Sequence[str], preceding: int,
                columns: dict[str, Callable[[WindowSpec], Column]], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Window columns that look back at most ``preceding`` rows of their key, computed in blocks of ``block_rows`` rows.

    Each function gets a window ordered by the row's number within its key, and must not look further back or ahead: ``F.lag(x, n)`` with n up to
    ``preceding``, or aggregates over ``rowsBetween(-n, 0)``. A block also gets the last rows of the one before.
    """
    if preceding > block_rows:
        raise ValueError("a frame must fit into a block")
    numbered = with_running(rows, keys, order, {"__row": F.lit(1).cast("long")})
    block, place = F.floor((F.col("__row") - 1) / block_rows), (F.col("__row") - 1) % block_rows
    also = F.when(place >= block_rows - preceding, F.array(block, block + 1)).otherwise(F.array(block))
    copied = numbered.withColumn("__own", block).withColumn("__block", F.explode(also))
    window = Window.partitionBy(*keys, "__block").orderBy("__row")
    return copied.withColumns({name: function(window) for name, function in columns.items()}).where(
        F.col("__own") == F.col("__block")).drop("__row", "__own", "__block")
