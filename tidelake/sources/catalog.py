"""Table registry: source ids, table schemas, locations and bucket addresses."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from tidelake.sources import files

# Fixed values
SOURCES = ["yahoo", "binance", "coinbase", "defillama", "worldbank", "treasury", "sec", "fred", "cboe", "investing",
           "tencent", "sina", "eastmoney", "baostock", "imf", "oecd", "calcfi", "fdic", "eia", "bls", "bea", "gmd"]

#: Sources whose payloads are charts, or quote lines, as those of the first source of that layout.
CHART_SOURCES = ["cboe", "investing"]
QUOTE_SOURCES = ["sina", "eastmoney", "baostock"]

BAR = ("symbol string, date date, epoch bigint, open double, high double, low double, close double, "
       "adj_close double, volume bigint")
BRONZE_BAR = ("symbol string, date string, epoch bigint, open double, high double, low double, close double, "
              "adjClose double, adj_close double, volume bigint, _ingest_ts string, _batch_id string")
POINT = ("indicator struct<id: string, value: string>, country struct<id: string, value: string>, "
         "countryiso3code string, date string, value double, unit string, obs_status string, `decimal` string, "
         "_lastupdated string, _sourceid string")
OBSERVATION = ("indicator_id string, indicator_name string, country_id string, country_name string, "
               "country_iso3 string, date string, year string, period_type string, value double, unit string, "
               "obs_status string, `decimal` string, source_id string, lastupdated string")
CRYPTO_BAR = ("symbol string, date date, epoch bigint, open double, high double, low double, close double, volume double, "
              "quote_volume double, trades bigint")
RATE = "indicator_id string, date date, value double"
FILING = "symbol string, accession_number string, filing_date date, form_type string, entity_name string, url string"
SPOT_QUOTE = "base string, currency string, amount decimal(38,18)"
QUOTE = "symbol string, fields array<string>"
INVENTORY = "source_key string, raw_len bigint, bronze_path string"
TICK = "symbol string, ts bigint, price double, volume bigint, exchange string"
TICK_TEXT = "symbol string, ts string, price string, volume string, exchange string"
ORDER = "id int, symbol string, side string, qty int, price double, ts bigint"
POSITION = "symbol string, qty int, avg_price double, market_price double, pnl double"
WINDOWED_BAR = "symbol string, window_start string, open double, high double, low double, close double, volume bigint"

EQUITY_MASTER = "symbol string, company_name string, isin string, market_lot string, listing_date date"
SUMMARY = "symbol string, bars bigint, avg_close double, max_high double, min_low double, total_vol bigint"
YOY = "indicator_id string, country_iso3 string, date string, value double, prev double, yoy double"
SOURCE_SUMMARY = "source string, bronze_keys bigint, silver_rows bigint"


@dataclass(frozen=True)
class Entry:
    """One registered table: where it lies, how it is stored and which columns it has."""

    format: str
    schema: str
    path: str

    def read(self, spark: SparkSession, root: str) -> DataFrame:
        location = f"{root}/{self.path}"
        if self.format == "csv":
            return files.read_csv(spark, location, self.schema)
        if self.format == "ndjson":
            return files.read_json_lines(spark, location, self.schema, name_glob="*.ndjson")
        if self.format == "json":
            return files.read_json_documents(spark, location, self.schema)
        return files.read_parquet(spark, location, self.schema)


TABLES: Mapping[str, Entry] = {
    "bronze.market_ticks": Entry("csv", TICK, "bronze/market_ticks"),
    "bronze.orders": Entry("json", ORDER, "bronze/orders"),
    "bronze.bars": Entry("ndjson", BRONZE_BAR, "bronze/yahoo"),
    "bronze.points": Entry("ndjson", POINT, "bronze/worldbank"),
    "silver.ohlcv": Entry("csv", WINDOWED_BAR, "silver/ohlcv"),
    "silver.market_ohlcv": Entry("parquet", BAR + ", year int", "silver/market/ohlcv"),
    "silver.macro_observations": Entry("parquet", OBSERVATION, "silver/macro/observations"),
    "silver.crypto_ohlcv": Entry("parquet", CRYPTO_BAR + ", year int", "silver/crypto/ohlcv"),
    "silver.rates": Entry("parquet", RATE, "silver/rates"),
    "silver.filings": Entry("parquet", FILING, "silver/filings"),
    "silver.spot_quotes": Entry("parquet", SPOT_QUOTE, "silver/spot_quotes"),
    "silver.quotes": Entry("parquet", QUOTE, "silver/quotes"),
    **{f"silver.{s}_ohlcv": Entry("parquet", BAR + ", year int", f"silver/market/{s}") for s in CHART_SOURCES},
    **{f"silver.{s}_quotes": Entry("parquet", QUOTE, f"silver/market/{s}_quotes") for s in QUOTE_SOURCES},
    "silver.equity_master": Entry("parquet", EQUITY_MASTER, "silver/master/equity"),
    "gold.positions": Entry("csv", POSITION, "gold/positions"),
    "gold.yahoo_summary": Entry("parquet", SUMMARY, "gold/yahoo_summary"),
    "gold.worldbank_yoy": Entry("parquet", YOY, "gold/worldbank_yoy"),
    "gold.all_sources_summary": Entry("parquet", SOURCE_SUMMARY, "gold/all_sources_summary"),
    **{f"silver.{s}": Entry("parquet", INVENTORY, f"silver/{s}")
       for s in SOURCES if s not in ("yahoo", "worldbank")},
}


#: Error classes of a path that is not there; any other error is one.
ABSENT = {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"}


def existing(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` gives, or None where its files are not there."""
    try:
        return read()
    except FileNotFoundError:
        return None
    except PySparkException as error:
        if error.getCondition() in ABSENT:
            return None
        raise


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return TABLES[name].read(spark, root)


def register_tables(spark: SparkSession, root: str, *names: str) -> None:
    """Temp views named ``layer_table`` for ad-hoc SQL."""
    for name in names:
        read_table(spark, root, name).createOrReplaceTempView(name.replace(".", "_"))


def register_existing(spark: SparkSession, root: str) -> list[str]:
    """Register every table of the registry that has files; returns their names."""
    found = []
    for name in TABLES:
        frame = existing(lambda n=name: read_table(spark, root, n))
        if frame is not None:
            frame.createOrReplaceTempView(name.replace(".", "_"))
            found.append(name)
    return found


def local_path(uri: str, root: str, buckets: Mapping[str, str]) -> str:
    """Path below ``root`` for an ``s3://bucket/key`` address.

    ``buckets`` names the layer directory of each bucket; others keep their own name.
    """
    bucket, _, key = uri.removeprefix("s3://").partition("/")
    return f"{root}/{buckets.get(bucket, bucket)}/{key}"
