"""Keep the newest version of every record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

RANK = "_version_rank"


def _sortable(data_type: T.DataType) -> bool:
    return not isinstance(data_type, (T.MapType, T.VariantType))


def keep_latest(df: DataFrame, keys: Sequence[str | Column], newest_first: Sequence[Column],
                payload_tie_break: bool = True) -> DataFrame:
    """One row per key: the first one under ``newest_first``.

    The order is made total by appending every other column, so that equal versions
    cannot make the outcome depend on task order. Written as ``row_number() = 1``
    because Catalyst then keeps one row per key in every map task before the exchange
    (WindowGroupLimit): a key holding a third of the table sends one row per task.
    """
    named = {k for k in keys if isinstance(k, str)}
    order = list(newest_first)
    if payload_tie_break:
        order += [F.col(f"`{f.name}`").desc_nulls_last() for f in df.schema.fields
                  if f.name not in named and _sortable(f.dataType)]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(window)).where(F.col(RANK) == 1).drop(RANK)


def latest_bars(bars: DataFrame) -> DataFrame:
    """Newest bar per symbol and date, by epoch and, where present, by ingest time."""
    newest = [F.col(c).desc_nulls_last() for c in ("epoch", "_ingest_ts") if c in bars.columns]
    return keep_latest(bars, ["symbol", "date"], newest)


def latest_ingested(rows: DataFrame, keys: Sequence[str], ingest_column: str = "_ingest_ts") -> DataFrame:
    return keep_latest(rows, keys, [F.col(ingest_column).desc_nulls_last()])


def latest_observations(observations: DataFrame, distinguish_aggregates: bool = False) -> DataFrame:
    """Newest observation per indicator, country and date.

    Some regional aggregates carry no ISO code and would share one key;
    ``distinguish_aggregates`` keys them by their own country id instead.
    """
    if not distinguish_aggregates:
        return keep_latest(observations, ["indicator_id", "country_iso3", "date"],
                           [F.col("lastupdated").desc_nulls_last()])
    entity = F.coalesce(F.nullif(F.col("country_iso3"), F.lit("")), F.col("country_id"))
    return keep_latest(observations.withColumn("_entity", entity), ["indicator_id", "_entity", "date"],
                       [F.col("lastupdated").desc_nulls_last()]).drop("_entity")
