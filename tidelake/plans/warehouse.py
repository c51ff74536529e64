"""Loads of the star schema: dimensions, facts and their foreign keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelake.functions import ASSET_CLASS_IDS, CURRENCY_IDS, UNKNOWN_ID, code_id, or_unknown, symbol_class
from tidelake.operators.dedup import keep_latest, latest_bars
from tidelake.operators.joins import insert_or_ignore, lookup, unmatched
from tidelake.operators.keys import with_dense_key
from tidelake.plans.reference import reference_rows, unknown_instrument
from tidelake.plans.views import Star

INSTRUMENT_COLUMNS = ["instrument_id", "symbol", "name", "asset_class_id", "exchange_id", "currency_id",
                      "sector_id", "lot_size", "isin", "valid_from", "valid_to", "is_current", "_source"]

OPEN_FROM, OPEN_TO = "date'1900-01-01'", "date'9999-12-31'"


# --- dimensions -------------------------------------------------------------

def seed_instruments(existing: DataFrame, bars: DataFrame, source: str = "yahoo", exchange_id: int = 1,
                     currency: str = "USD", asset_class: Column | None = None) -> DataFrame:
    """Append every symbol of ``bars`` that the dimension does not know yet.

    The asset class follows from the symbol's spelling unless it is given.
    """
    kind = symbol_class("symbol") if asset_class is None else asset_class
    fresh = unmatched(bars.select("symbol").where(F.col("symbol").isNotNull()).distinct(), existing, "symbol")
    numbered = with_dense_key(fresh, ["symbol"], "instrument_id", existing)
    rows = numbered.select(
        "instrument_id", "symbol", F.lit(None).cast("string").alias("name"),
        code_id(kind, ASSET_CLASS_IDS).alias("asset_class_id"),
        F.lit(exchange_id).alias("exchange_id"), code_id(F.lit(currency), CURRENCY_IDS).alias("currency_id"),
        F.lit(-1).alias("sector_id"), F.lit(1).alias("lot_size"), F.lit(None).cast("string").alias("isin"),
        F.expr(OPEN_FROM).alias("valid_from"), F.expr(OPEN_TO).alias("valid_to"),
        F.lit(True).alias("is_current"), F.lit(source).alias("_source"))
    return existing.select(*INSTRUMENT_COLUMNS).unionByName(rows)


def seed_equity_master(existing: DataFrame, master: DataFrame, exchange_id: int = 4,
                       currency: str = "INR", source: str = "nse-equity-master") -> DataFrame:
    """Append equities of a master file ``(symbol, company_name, isin, market_lot, listing_date)``."""
    first = keep_latest(master, ["symbol"], [F.col("listing_date").asc_nulls_last()])
    numbered = with_dense_key(unmatched(first, existing, "symbol"), ["symbol"], "instrument_id", existing)
    rows = numbered.select(
        "instrument_id", "symbol", F.col("company_name").alias("name"),
        F.lit(ASSET_CLASS_IDS["EQUITY"]).alias("asset_class_id"), F.lit(exchange_id).alias("exchange_id"),
        code_id(F.lit(currency), CURRENCY_IDS).alias("currency_id"), F.lit(-1).alias("sector_id"),
        F.col("market_lot").cast("int").alias("lot_size"), "isin",
        F.col("listing_date").cast("date").alias("valid_from"), F.expr(OPEN_TO).alias("valid_to"),
        F.lit(True).alias("is_current"), F.lit(source).alias("_source"))
    return existing.select(*INSTRUMENT_COLUMNS).unionByName(rows)


def seed_equities(existing: DataFrame, instruments: DataFrame) -> DataFrame:
    """One equity row per instrument of that class that has none yet."""
    equities = instruments.where(F.col("asset_class_id") == ASSET_CLASS_IDS["EQUITY"]).select("instrument_id")
    fresh = unmatched(equities, existing, "instrument_id")
    return existing.unionByName(fresh, allowMissingColumns=True)


def seed_countries(existing: DataFrame, observations: DataFrame) -> DataFrame:
    rows = (observations.where(F.col("country_iso3") != "")
            .select("country_iso3", "country_id", "country_name").distinct())
    return insert_or_ignore(existing, rows, "country_iso3",
                            [F.col("country_id").asc_nulls_last(), F.col("country_name").asc_nulls_last()])


def seed_indicators(existing: DataFrame, observations: DataFrame) -> DataFrame:
    rows = (observations.where(F.col("indicator_id").isNotNull())
            .select("indicator_id", "indicator_name", "source_id", "unit").distinct())
    return insert_or_ignore(existing, rows, "indicator_id",
                            [F.col(c).asc_nulls_last() for c in ("indicator_name", "source_id", "unit")])


def seed_reference(spark: SparkSession, dimension: str, incoming: DataFrame, key: str,
                   first_by: list[Column]) -> DataFrame:
    """Fixed reference rows plus incoming ones whose key is free."""
    return insert_or_ignore(reference_rows(spark, dimension), incoming, key, first_by)


def with_foreign_keys(instruments: DataFrame) -> DataFrame:
    """Fill id columns from the text columns ``asset_class`` and ``currency``.

    Columns that are missing start from their default; ids other than the default stay.
    """
    def present(name: str, default: int) -> Column:
        return F.coalesce(F.col(name), F.lit(default)) if name in instruments.columns else F.lit(default)

    asset_class, currency = present("asset_class_id", UNKNOWN_ID), present("currency_id", CURRENCY_IDS["USD"])
    unset = (currency == CURRENCY_IDS["USD"]) & F.col("currency").isNotNull()
    return instruments.withColumns({
        "asset_class_id": F.when(asset_class == UNKNOWN_ID, code_id("asset_class", ASSET_CLASS_IDS)).otherwise(asset_class),
        "currency_id": F.when(unset, code_id("currency", CURRENCY_IDS)).otherwise(currency),
        "sector_id": present("sector_id", UNKNOWN_ID),
    })


# --- facts ------------------------------------------------------------------

def market_fact(silver_bars: DataFrame, instruments: DataFrame) -> DataFrame:
    """Newest bar per symbol and date with its instrument id; unknown symbols drop out.

    De-duplication runs before the look-up, so a symbol enters the join with at most
    one row per calendar day.
    """
    date = F.col("date").cast("date")
    return lookup(latest_bars(silver_bars), instruments.select("instrument_id", "symbol"), "symbol").select(
        "instrument_id", date.alias("date"), "epoch", "open", "high", "low", "close", "adj_close", "volume",
        F.year(date).alias("year"))


def rejected_bars(silver_bars: DataFrame, instruments: DataFrame) -> DataFrame:
    """What ``market_fact`` drops: bars of symbols the dimension does not know."""
    return unmatched(latest_bars(silver_bars), instruments, "symbol")


def macro_fact(observations: DataFrame) -> DataFrame:
    """Newest observation per indicator, country (or the unknown member) and date."""
    rows = observations.withColumn("country_iso3", or_unknown("country_iso3"))
    newest = keep_latest(rows, ["indicator_id", "country_iso3", "date"], [F.col("lastupdated").desc_nulls_last()])
    return newest.select("indicator_id", "country_iso3", "date", "value", "period_type", "source_id")


def crypto_fact(klines: DataFrame, instruments: DataFrame) -> DataFrame:
    """Newest kline per symbol and date with its instrument id."""
    newest = keep_latest(klines, ["symbol", "date"], [F.col("epoch").desc_nulls_last()])
    return lookup(newest, instruments.select("instrument_id", "symbol"), "symbol").select(
        "instrument_id", "date", "open", "high", "low", "close", "volume", "trades", F.year("date").alias("year"))


def rates_fact(rates: DataFrame, source_id: str) -> DataFrame:
    rows = rates.where(F.col("date").isNotNull() & F.col("value").isNotNull())
    return rows.select("indicator_id", "date", "value", F.lit(source_id).alias("source_id"))


def filings_fact(filings: DataFrame, instruments: DataFrame) -> DataFrame:
    """Filings with their instrument id; one filer may own a large share of them."""
    rows = lookup(filings, instruments.select("instrument_id", "symbol"), "symbol")
    return rows.select("instrument_id", "accession_number", "filing_date", "form_type", "entity_name", "url")


# --- whole load ---------------------------------------------------------------

@dataclass(frozen=True)
class Silver:
    """Silver tables a warehouse is loaded from; the optional ones give empty facts when missing."""

    bars: DataFrame
    observations: DataFrame
    equity_master: DataFrame | None = None
    klines: DataFrame | None = None
    rates: DataFrame | None = None
    filings: DataFrame | None = None


EMPTY_FACTS = {
    "fact_crypto_ohlcv": "instrument_id bigint, date date, open double, high double, low double, close double, "
                         "volume double, trades bigint, year int",
    "fact_rates_daily": "indicator_id string, date date, value double, source_id string",
    "fact_filings": "instrument_id bigint, accession_number string, filing_date date, form_type string, "
                    "entity_name string, url string",
}


def load_star(spark: SparkSession, silver: Silver, rates_source: str = "fred") -> Star:
    """Reference rows, then dimensions seeded in order, then facts with their keys.

    Numbered dimensions are checkpointed by their seeds; everything else stays lazy.
    """
    instruments = seed_instruments(unknown_instrument(spark), silver.bars)
    if silver.klines is not None:
        instruments = seed_instruments(instruments, silver.klines, source="binance", exchange_id=-1,
                                       asset_class=F.lit("CRYPTO"))
    if silver.equity_master is not None:
        instruments = seed_equity_master(instruments, silver.equity_master)
    no_equities = spark.createDataFrame(
        [], "instrument_id bigint, outstanding_shares bigint, market_cap double, listing_date date")
    no_indicators = spark.createDataFrame(
        [], "indicator_id string, indicator_name string, source_id string, unit string, frequency string")
    tables = {name: (lambda n=name: reference_rows(spark, n))
              for name in ("dim_currency", "dim_asset_class", "dim_industry", "dim_sector", "dim_exchange")}
    tables |= {
        "dim_country": lambda: seed_countries(reference_rows(spark, "dim_country"), silver.observations),
        "dim_indicator": lambda: seed_indicators(no_indicators, silver.observations),
        "dim_instrument": lambda: instruments,
        "dim_equity": lambda: seed_equities(no_equities, instruments),
        "fact_market_ohlcv": lambda: market_fact(silver.bars, instruments),
        "fact_macro_obs": lambda: macro_fact(silver.observations),
    }
    optional = {
        "fact_crypto_ohlcv": (silver.klines, lambda rows: crypto_fact(rows, instruments)),
        "fact_rates_daily": (silver.rates, lambda rows: rates_fact(rows, rates_source)),
        "fact_filings": (silver.filings, lambda rows: filings_fact(rows, instruments)),
    }
    for name, (rows, build) in optional.items():
        tables[name] = ((lambda n=name: spark.createDataFrame([], EMPTY_FACTS[n])) if rows is None
                        else (lambda r=rows, b=build: b(r)))
    return Star(tables)
