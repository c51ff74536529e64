"""Reference rows every warehouse starts with, including the unknown members."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Fixed values
CURRENCIES = [(-1, "UNK", "Unknown"), (1, "USD", "US Dollar"), (2, "INR", "Indian Rupee")]
ASSET_CLASSES = [(-1, "UNKNOWN", "Unknown"), (1, "EQUITY", "Equity"), (2, "INDEX", "Index"), (3, "CRYPTO", "Crypto")]
INDUSTRIES = [(-1, "UNKNOWN"), (1, "Technology"), (2, "Financials")]
SECTORS = [(-1, "UNKNOWN", -1), (1, "TECHNOLOGY", 1), (2, "UNKNOWN_SECTOR", -1)]
EXCHANGES = [
    (-1, "UNKNOWN", "Unknown", None, -1, None),
    (1, "NASDAQ", "NASDAQ", "USA", 1, "America/New_York"),
    (2, "NYSE", "NYSE", "USA", 1, "America/New_York"),
    (3, "BSE", "Bombay SE", "IND", 2, "Asia/Kolkata"),
    (4, "NSE", "National Stock Exchange", "IND", 2, "Asia/Kolkata"),
]
COUNTRIES = [("UNK", "UNK", "Unknown", None), ("USA", "US", "United States", "North America"),
             ("IND", "IN", "India", "South Asia")]
UNKNOWN_INSTRUMENT = (-1, "UNKNOWN", "Unknown", -1, -1, 1, -1, 1, None)

SCHEMAS = {
    "dim_currency": "currency_id int, currency_code string, currency_name string",
    "dim_asset_class": "asset_class_id int, asset_class_code string, asset_class_name string",
    "dim_industry": "industry_id int, industry_name string",
    "dim_sector": "sector_id int, sector_name string, industry_id int",
    "dim_exchange": "exchange_id int, exchange_code string, exchange_name string, country_iso3 string, "
                    "currency_id int, timezone string",
    "dim_country": "country_iso3 string, country_id string, country_name string, region string",
}

ROWS = {
    "dim_currency": CURRENCIES,
    "dim_asset_class": ASSET_CLASSES,
    "dim_industry": INDUSTRIES,
    "dim_sector": SECTORS,
    "dim_exchange": EXCHANGES,
    "dim_country": COUNTRIES,
}


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Literal rows as a VALUES list: their size is known to the optimizer."""
    def literal(value: object) -> str:
        if value is None:
            return "NULL"
        return "'" + value.replace("'", "\\'") + "'" if isinstance(value, str) else str(value)

    fields = [f.strip().split(" ") for f in schema.split(",")]
    values = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)
    casts = ", ".join(f"CAST(col{i} AS {kind}) AS {name}" for i, (name, kind) in enumerate(fields, 1))
    return spark.sql(f"SELECT {casts} FROM VALUES {values}")


def reference_rows(spark: SparkSession, dimension: str) -> DataFrame:
    return inline_rows(spark, ROWS[dimension], SCHEMAS[dimension])


def unknown_instrument(spark: SparkSession) -> DataFrame:
    return inline_rows(
        spark, [UNKNOWN_INSTRUMENT],
        "instrument_id bigint, symbol string, name string, asset_class_id int, exchange_id int, "
        "currency_id int, sector_id int, lot_size int, isin string").selectExpr(
        "*", "date'1900-01-01' AS valid_from", "date'9999-12-31' AS valid_to", "true AS is_current",
        "'system' AS _source")
