"""The named datasets: analytics, domain, reference and master views over a star schema."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelake.functions import ASSET_CLASS_IDS
from tidelake.operators import aggregates, series
from tidelake.operators.joins import lookup

# Fixed values
WORLD_BANK = "worldbank"


@dataclass(frozen=True)
class Star:
    """Tables of the star schema by name; each is built on first use only."""

    tables: dict[str, Callable[[], DataFrame]]

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]()


class Views:
    """Every view is a property holding a lazy DataFrame; views build on each other."""

    def __init__(self, star: Star) -> None:
        self.star = star

    # --- analytics ----------------------------------------------------------

    @cached_property
    def _bars_with_symbol(self) -> DataFrame:
        instruments = self.star["dim_instrument"].select("instrument_id", "symbol", "asset_class_id")
        bars = self.star["fact_market_ohlcv"].select("instrument_id", "date", "close", "volume")
        return lookup(bars, instruments, "instrument_id")

    @cached_property
    def _returns(self) -> DataFrame:
        return series.with_daily_return(self._bars_with_symbol)

    @property
    def returns_daily(self) -> DataFrame:
        return self._returns.select("symbol", "asset_class_id", "date", "close", "volume", "ret_1d")

    @property
    def returns_cumulative(self) -> DataFrame:
        return series.with_cumulative_return(self._returns).select("symbol", "date", "close", "ret_1d", "cum_return")

    @property
    def volatility_30d(self) -> DataFrame:
        return series.with_volatility(self._returns).select("symbol", "date", "ret_1d", "vol_30d_annualized")

    @property
    def macro_yoy(self) -> DataFrame:
        rows = self.star["fact_macro_obs"].select("indicator_id", "country_iso3", "date", "value", "source_id")
        return series.with_yoy(rows)

    @property
    def worldbank_yoy(self) -> DataFrame:
        return self.macro_yoy.where(F.col("source_id") == WORLD_BANK)

    @property
    def instrument_detail(self) -> DataFrame:
        star = self.star
        rows = star["dim_instrument"].drop("_source")
        for name, key in (("dim_asset_class", "asset_class_id"), ("dim_currency", "currency_id"),
                          ("dim_sector", "sector_id"), ("dim_industry", "industry_id")):
            rows = lookup(rows, star[name], key)
        exchanges = star["dim_exchange"].drop("currency_id", "timezone")
        return lookup(rows, exchanges, "exchange_id").select(
            "instrument_id", "symbol", "name", "isin", "asset_class_code", "asset_class_name", "currency_code",
            "currency_name", "sector_name", "industry_name", "exchange_code", "exchange_name", "country_iso3",
            "lot_size", "valid_from", "valid_to", "is_current")

    @property
    def source_coverage(self) -> DataFrame:
        star = self.star
        return aggregates.source_coverage(
            star["dim_instrument"], star["fact_market_ohlcv"], star["fact_macro_obs"],
            star["fact_crypto_ohlcv"], star["fact_rates_daily"], star["fact_filings"])

    @property
    def all_sources_summary(self) -> DataFrame:
        return self.source_coverage

    @property
    def yahoo_summary(self) -> DataFrame:
        return aggregates.market_summary_from_star(self.star["fact_market_ohlcv"], self.star["dim_instrument"])

    # --- market and macro domain ---------------------------------------------

    def _with_symbol(self, fact: str, *columns: str) -> DataFrame:
        instruments = self.star["dim_instrument"].select("instrument_id", "symbol")
        return lookup(self.star[fact], instruments, "instrument_id").select("symbol", *columns)

    @property
    def market_ohlcv(self) -> DataFrame:
        return self._with_symbol("fact_market_ohlcv", "date", "open", "high", "low", "close", "adj_close",
                                 "volume", "year")

    @property
    def market_crypto(self) -> DataFrame:
        return self._with_symbol("fact_crypto_ohlcv", "date", "open", "high", "low", "close", "volume",
                                 "trades", "year")

    @property
    def market_filings(self) -> DataFrame:
        instruments = self.star["dim_instrument"].select("instrument_id", "symbol")
        return lookup(self.star["fact_filings"], instruments, "instrument_id").select(
            "symbol", "accession_number", "filing_date", "form_type", "entity_name", "url")

    @property
    def macro_observation(self) -> DataFrame:
        indicators = self.star["dim_indicator"].select("indicator_id", "indicator_name")
        countries = self.star["dim_country"].select("country_iso3", "country_name")
        rows = lookup(lookup(self.star["fact_macro_obs"], indicators, "indicator_id"), countries, "country_iso3")
        return rows.select("indicator_id", "indicator_name", "country_iso3", "country_name", "date", "value",
                           "period_type", "source_id")

    @property
    def macro_rates(self) -> DataFrame:
        return self.star["fact_rates_daily"].select("indicator_id", "date", "value", "source_id")

    # --- silver names ---------------------------------------------------------

    @property
    def silver_yahoo_ohlcv(self) -> DataFrame:
        return self.star["silver_bars"].select(
            "symbol", F.col("date").cast("date").alias("trade_date"), "epoch", "open", "high", "low", "close",
            "adj_close", "volume")

    @property
    def silver_equity_master(self) -> DataFrame:
        return self.star["equity_master"]

    @property
    def silver_worldbank_observations(self) -> DataFrame:
        return self.star["fact_macro_obs"]

    # --- reference and master --------------------------------------------------

    def _coded(self, dimension: str, prefix: str, *more: str) -> DataFrame:
        columns = self.star[dimension]
        code = [F.col(f"{prefix}_code").alias("code")] if f"{prefix}_code" in columns.columns else []
        return columns.select(F.col(f"{prefix}_id").alias("id"), *code, F.col(f"{prefix}_name").alias("name"), *more)

    @property
    def ref_currency(self) -> DataFrame:
        return self._coded("dim_currency", "currency")

    @property
    def ref_asset_class(self) -> DataFrame:
        return self._coded("dim_asset_class", "asset_class")

    @property
    def ref_industry(self) -> DataFrame:
        return self._coded("dim_industry", "industry")

    @property
    def ref_sector(self) -> DataFrame:
        return self._coded("dim_sector", "sector", "industry_id")

    @property
    def ref_country(self) -> DataFrame:
        return self.star["dim_country"].select(F.col("country_iso3").alias("code"),
                                               F.col("country_name").alias("name"), "region")

    @property
    def ref_indicator(self) -> DataFrame:
        return self._coded("dim_indicator", "indicator", "source_id", "unit", "frequency")

    @property
    def ref_exchange(self) -> DataFrame:
        return self._coded("dim_exchange", "exchange", "country_iso3", "currency_id")

    @property
    def master_instrument(self) -> DataFrame:
        return self.star["dim_instrument"].select(
            F.col("instrument_id").alias("id"), "symbol", "name", "asset_class_id", "exchange_id", "currency_id",
            "sector_id", "lot_size", "isin", "is_current")

    @property
    def master_equity(self) -> DataFrame:
        return self.star["dim_equity"].select(F.col("instrument_id").alias("id"), "outstanding_shares",
                                              "market_cap", "listing_date")

    @property
    def master_instrument_detail(self) -> DataFrame:
        return self.instrument_detail

    def equities_of(self, country: str) -> DataFrame:
        """Equities listed in a country. Unsorted: readers order by symbol where they need it."""
        listed = self.star["dim_exchange"].where(F.col("country_iso3") == country).select("exchange_id", "exchange_code")
        equities = self.star["dim_instrument"].where(F.col("asset_class_id") == ASSET_CLASS_IDS["EQUITY"])
        rows = lookup(lookup(equities, listed, "exchange_id"),
                      self.star["dim_currency"].select("currency_id", "currency_code"), "currency_id")
        return rows.select("symbol", "name", "isin", "currency_code", "exchange_code")

    @property
    def master_equity_india(self) -> DataFrame:
        return self.equities_of("IND")

    # --- earlier spellings still in use ----------------------------------------

    @property
    def equity_ohlcv(self) -> DataFrame:
        classes = self.star["dim_asset_class"].select("asset_class_id", F.col("asset_class_code").alias("asset_class"))
        instruments = lookup(self.star["dim_instrument"].select("instrument_id", "symbol", "asset_class_id"),
                             classes, "asset_class_id").drop("asset_class_id")
        facts = self.star["fact_market_ohlcv"]
        return lookup(facts, instruments, "instrument_id").select("symbol", "asset_class", *facts.columns)

    @property
    def yahoo_summary_short(self) -> DataFrame:
        return self.yahoo_summary.select("symbol", "bars", "avg_close")

    @property
    def macro_previous(self) -> DataFrame:
        rows = self.star["fact_macro_obs"].select("indicator_id", "country_iso3", "date", "value")
        return series.with_previous_value(rows, name="prev")

    @property
    def instrument_3nf(self) -> DataFrame:
        return self.instrument_detail.select("instrument_id", "symbol", "name", "asset_class_code",
                                             "currency_code", "sector_name", "industry_name", "exchange_code")

    @property
    def ohlcv_3nf(self) -> DataFrame:
        instruments = self.star["dim_instrument"].select("instrument_id", "symbol", "asset_class_id",
                                                         "currency_id", "sector_id")
        for name, key, kept in (("dim_asset_class", "asset_class_id", "asset_class_code"),
                                ("dim_currency", "currency_id", "currency_code"),
                                ("dim_sector", "sector_id", "sector_name")):
            instruments = lookup(instruments, self.star[name].select(key, kept), key).drop(key)
        bars = self.star["fact_market_ohlcv"].select("instrument_id", "date", "close", "volume")
        return lookup(bars, instruments, "instrument_id").select(
            "symbol", "asset_class_code", "currency_code", "sector_name", "date", "close", "volume")


# Public name of each view -> property of Views. The names double as temp view names.
VIEW_NAMES = {
    "gold_vw_returns_daily": "returns_daily",
    "gold_vw_returns_cumulative": "returns_cumulative",
    "gold_vw_volatility_30d": "volatility_30d",
    "gold_vw_macro_yoy": "macro_yoy",
    "gold_vw_instrument_detail": "instrument_detail",
    "gold_vw_source_coverage": "source_coverage",
    "gold_yahoo_summary": "yahoo_summary",
    "gold_worldbank_yoy": "worldbank_yoy",
    "gold_all_sources_summary": "all_sources_summary",
    "silver_yahoo_ohlcv": "silver_yahoo_ohlcv",
    "silver_worldbank_observations": "silver_worldbank_observations",
    "silver_equity_master": "silver_equity_master",
    "market_ohlcv": "market_ohlcv",
    "market_crypto": "market_crypto",
    "market_filings": "market_filings",
    "macro_observation": "macro_observation",
    "macro_rates": "macro_rates",
    "ref_currency": "ref_currency",
    "ref_asset_class": "ref_asset_class",
    "ref_industry": "ref_industry",
    "ref_sector": "ref_sector",
    "ref_country": "ref_country",
    "ref_indicator": "ref_indicator",
    "ref_exchange": "ref_exchange",
    "master_instrument": "master_instrument",
    "master_equity": "master_equity",
    "master_instrument_detail": "master_instrument_detail",
    "master_equity_india": "master_equity_india",
    "gold_vw_equity_ohlcv": "equity_ohlcv",
    "gold_vw_yahoo_summary": "yahoo_summary_short",
    "gold_vw_ohlcv_3nf": "ohlcv_3nf",
    "gold_vw_instrument_3nf": "instrument_3nf",
    "gold_vw_macro_previous": "macro_previous",
}


def register_views(spark: SparkSession, star: Star) -> Views:
    """Register the star's tables and all views as temp views for ad-hoc SQL.

    The two views on silver files need the tables ``silver_bars`` and ``equity_master``.
    """
    for name in star.tables:
        star[name].createOrReplaceTempView(name)
    views = Views(star)
    for name, attribute in VIEW_NAMES.items():
        getattr(views, attribute).createOrReplaceTempView(name)
    return views
