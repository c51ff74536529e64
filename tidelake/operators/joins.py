"""Look-ups of facts in dimensions, anti-joins and insert-or-ignore."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from tidelake.operators.dedup import keep_latest


def lookup(facts: DataFrame, dimension: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Inner join with a dimension; a key may hold any part of the facts.

    No hint: Spark broadcasts the dimension when its size is under the broadcast threshold and shuffles otherwise.
    In a shuffled join the adaptive skew join, which ``get_session`` switches on, splits a hot key's partition by map
    output, so that equal rows spread too; the dimension holds one row per key, so copying its side is cheap.
    """
    return facts.join(dimension, on)


def unmatched(rows: DataFrame, existing: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``existing``, which is reduced to its keys before any exchange."""
    keys = [on] if isinstance(on, str) else list(on)
    return rows.join(existing.select(*keys).distinct(), keys, "left_anti")


def insert_or_ignore(existing: DataFrame, incoming: DataFrame, key: str,
                     first_by: Sequence[Column]) -> DataFrame:
    """``existing`` plus incoming rows with a new key; the first of a batch wins."""
    fresh = unmatched(keep_latest(incoming, [key], first_by), existing, key)
    return existing.unionByName(fresh, allowMissingColumns=True).select(*existing.columns)
