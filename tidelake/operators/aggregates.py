"""Summaries, coverage reports and portfolio sums."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidelake.functions import UNKNOWN_ID, money, profit


def row_count(name: str, table: DataFrame, where: Column | None = None) -> DataFrame:
    rows = table if where is None else table.where(where)
    return rows.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def bars(rows: DataFrame, keys: Sequence[str | Column], price: str, volume: Column,
         sequence: Column, **extra: Column) -> DataFrame:
    """Open, high, low, close and volume per key; open and close follow ``sequence``."""
    return rows.groupBy(*keys).agg(
        F.min_by(price, sequence).alias("open"), F.max(price).alias("high"),
        F.min(price).alias("low"), F.max_by(price, sequence).alias("close"),
        volume.alias("volume"), *[c.alias(name) for name, c in extra.items()])


def exact_sum(column: str | Column) -> Column:
    """Sum at six decimals: the same in any order of summation. Values of 22 or more integer digits end the job."""
    return F.sum((F.col(column) if isinstance(column, str) else column).cast("decimal(28,6)"))


def exact_mean(column: str) -> Column:
    """Exact sum, divided once."""
    return F.try_divide(exact_sum(column).cast("double"), F.count(column))


def market_summary(bars_with_symbol: DataFrame) -> DataFrame:
    """Bars, average close, price range and volume per symbol."""
    return bars_with_symbol.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("bars"), exact_mean("close").alias("avg_close"),
        F.max("high").alias("max_high"), F.min("low").alias("min_low"),
        F.sum("volume").alias("total_vol"))


def market_summary_from_star(facts: DataFrame, instruments: DataFrame) -> DataFrame:
    """The same summary on the star schema, reduced per instrument before the join.

    Only one partial row per instrument meets the dimension; partials of instruments
    that share a symbol are merged afterwards, so the result equals join-then-group.
    """
    partial = facts.groupBy("instrument_id").agg(
        F.count(F.lit(1)).alias("bars"), exact_sum("close").alias("sum_close"),
        F.count("close").alias("n_close"), F.max("high").alias("max_high"),
        F.min("low").alias("min_low"), F.sum("volume").alias("total_vol"))
    return (partial.join(instruments.select("instrument_id", "symbol"), "instrument_id")
            .groupBy("symbol")
            .agg(F.sum("bars").alias("bars"),
                 F.try_divide(F.sum("sum_close").cast("double"), F.sum("n_close")).alias("avg_close"),
                 F.max("max_high").alias("max_high"), F.min("min_low").alias("min_low"),
                 F.sum("total_vol").alias("total_vol")))


def source_coverage(instruments: DataFrame, market: DataFrame, macro: DataFrame, crypto: DataFrame,
                    rates: DataFrame, filings: DataFrame) -> DataFrame:
    """``(table_name, row_count, sources)`` for the instrument dimension and the facts.

    One aggregate per table; market bars take their source from the instrument, after
    being counted per instrument.
    """
    def one(name: str, table: DataFrame, rows: Column, sources: Column) -> DataFrame:
        return table.agg(rows.alias("row_count"), sources.cast("bigint").alias("sources")).select(
            F.lit(name).alias("table_name"), "row_count", "sources")

    every, none = F.count(F.lit(1)), F.max(F.lit(0))
    per_instrument = (market.groupBy("instrument_id").agg(every.alias("n"))
                      .join(instruments.select("instrument_id", "_source"), "instrument_id"))
    return union_all([
        one("dim_instrument", instruments.where(F.col("instrument_id") != UNKNOWN_ID), every, F.countDistinct("_source")),
        one("fact_market_ohlcv", per_instrument, F.coalesce(F.sum("n"), F.lit(0)), F.countDistinct("_source")),
        one("fact_macro_obs", macro, every, F.countDistinct("source_id")),
        one("fact_crypto_ohlcv", crypto, every, F.coalesce(none, F.lit(0))),
        one("fact_rates_daily", rates, every, F.countDistinct("source_id")),
        one("fact_filings", filings, every, F.coalesce(none, F.lit(0))),
    ])


def source_summary(sources: DataFrame, run_records: DataFrame, silver: DataFrame) -> DataFrame:
    """``(source, bronze_keys, silver_rows)`` for every source, 0 where nothing is known.

    ``run_records(source, last_run, keys)``: the newest record of a source counts.
    ``silver(source, ...)``: all silver rows tagged by source, counted in one pass.
    """
    newest = run_records.groupBy("source").agg(
        F.max_by("keys", F.struct("last_run", "keys")).alias("bronze_keys"))
    counts = silver.groupBy("source").agg(F.count(F.lit(1)).alias("silver_rows"))
    return (sources.select("source").join(newest, "source", "left").join(counts, "source", "left")
            .select("source", F.coalesce("bronze_keys", F.lit(0)).cast("bigint").alias("bronze_keys"),
                    F.coalesce("silver_rows", F.lit(0)).alias("silver_rows")))


def money_totals(amounts: DataFrame, amount: str = "amount", currency: str = "currency") -> DataFrame:
    """Sum per currency of amounts rounded to cents; currencies are never mixed."""
    valid = amounts.where(F.col(amount).isNotNull() & (F.length(F.trim(F.col(currency))) > 0))
    return (valid.groupBy(F.upper(currency).alias("currency"))
            .agg(F.sum(money(amount)).alias("total"), F.count(F.lit(1)).alias("entries")))


def positions(fills: DataFrame, last_prices: DataFrame) -> DataFrame:
    """Position per symbol with its profit at the last price.

    ``fills(symbol, quantity, price)`` are reduced per symbol before they meet ``last_prices(symbol, market_price)``.
    Quantities are positive, with a column ``side`` of BUY and SELL, or signed without it. The average price is that of
    the open side: of the buys in a long position, of the sells in a short one; a closed position has none and no profit.
    """
    sold = F.upper("side") == "SELL" if "side" in fills.columns else F.col("quantity") < 0
    size = F.abs("quantity")
    paid = (F.col("price").cast("decimal(28,6)") * size.cast("decimal(10,0)")).cast("decimal(38,6)")

    def total(value: Column, of: Column) -> Column:
        return F.coalesce(F.sum(F.when(of, value)), F.lit(0))

    sides = fills.groupBy("symbol").agg(
        total(size, ~sold).alias("bought"), total(size, sold).alias("sold"),
        total(paid, ~sold).cast("double").alias("paid"), total(paid, sold).cast("double").alias("received"))
    qty = F.col("bought") - F.col("sold")
    held = sides.select("symbol", qty.alias("qty"), F.when(qty > 0, F.col("paid") / F.col("bought")).when(
        qty < 0, F.col("received") / F.col("sold")).alias("avg_price"))
    return held.join(last_prices, "symbol").select(
        "symbol", "qty", "avg_price", "market_price",
        F.coalesce(profit("market_price", "avg_price", "qty"), F.lit(0.0)).alias("pnl"))


def portfolio_total(position_rows: DataFrame) -> DataFrame:
    return position_rows.agg(F.sum("pnl").alias("total_pnl"))


def schema_rows(tables: Mapping[str, DataFrame]) -> list[tuple[str, int, str, str]]:
    """``(table, position, column, type)`` for every column; reads schemas only."""
    return [(name, i, f.name, catalog_type(f.dataType.simpleString()))
            for name, table in tables.items() for i, f in enumerate(table.schema.fields, 1)]


def schema_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, position, column_name, type, filled_rows)``; one aggregate per table."""
    def one(name: str, table: DataFrame) -> DataFrame:
        counts = table.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in table.columns])
        columns = F.array(*[F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
            F.lit(catalog_type(f.dataType.simpleString())).alias("type"), F.col(f"`{f.name}`").alias("filled_rows"))
            for i, f in enumerate(table.schema.fields, 1)])
        return counts.select(F.lit(name).alias("table_name"), F.inline(columns))

    return union_all([one(name, table) for name, table in tables.items()])


def catalog_type(spark_type: str) -> str:
    """Type name in the exported catalog; anything without a scalar type is a string."""
    plain = spark_type.split("(")[0]
    if plain in {"string", "int", "bigint", "smallint", "tinyint", "double", "float", "boolean", "date", "binary"}:
        return plain
    if plain.startswith("timestamp"):
        return "timestamp"
    return "double" if plain == "decimal" else "string"
