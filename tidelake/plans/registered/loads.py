"""Warehouse loads on the test tables: seeds with surrogate keys, fact rebuilds, foreign keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelake.functions import timestamp_to_micros
from tidelake.operators import aggregates
from tidelake.plans import warehouse
from tidelake.plans.reference import reference_rows
from tidelake.plans.registered.operators import REVISIONS, SILVER_BARS, revisions, silver_bars
from tidelake.plans.registered.registry import registered
from tidelake.plans.registered.views import sql
from tidelake.plans.standins import StandIns

# The seeds start from a dimension that knows some exchanges; customer names act as index symbols.
KNOWN = "(SELECT * FROM dim_instrument WHERE exchange_id < 12)"
LATEST_BARS = f"""
    SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY epoch DESC, close DESC,
        volume DESC, part DESC) AS rn FROM ({SILVER_BARS})) WHERE rn = 1"""


def known_instruments(tables: StandIns):
    return tables.dim_instrument.where("exchange_id < 12")


SEEDED = f"""
    SELECT instrument_id, symbol, name, asset_class_id, exchange_id, currency_id, sector_id, lot_size, isin, valid_from,
        valid_to, is_current, _source FROM {KNOWN}
    UNION ALL SELECT (SELECT coalesce(max(instrument_id), 0) FROM {KNOWN}) + row_number() OVER (ORDER BY symbol), symbol,
        NULL, CASE WHEN symbol LIKE '^%' THEN 2 ELSE 1 END, 1, 1, -1, 1, NULL, DATE '1900-01-01', DATE '9999-12-31', true,
        'yahoo'
    FROM (SELECT DISTINCT symbol FROM (SELECT s_name AS symbol FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
        UNION ALL SELECT '^' || c_name FROM orders JOIN customer ON o_custkey = c_custkey))
    WHERE symbol NOT IN (SELECT symbol FROM {KNOWN})"""


def traded_symbols(tables: StandIns):
    suppliers = tables.read("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("symbol"))
    customers = tables.read("customer").select(F.col("c_custkey").alias("o_custkey"),
                                               F.concat(F.lit("^"), F.col("c_name")).alias("symbol"))
    traded = suppliers.join(tables.read("lineitem").select("l_suppkey").distinct(), "l_suppkey").select("symbol")
    ordered = customers.join(tables.read("orders").select("o_custkey").distinct(), "o_custkey").select("symbol")
    return traded.unionByName(ordered)


@registered("seed_instruments", sql(SEEDED))
def seed_instruments(spark, sf_dir):
    tables = StandIns(spark, sf_dir)
    return warehouse.seed_instruments(known_instruments(tables), traded_symbols(tables))


@registered("seed_equities", sql("""
    SELECT instrument_id, outstanding_shares, market_cap, listing_date FROM dim_equity
    UNION ALL SELECT instrument_id, NULL, NULL, NULL FROM seeded WHERE asset_class_id = 1
        AND instrument_id NOT IN (SELECT instrument_id FROM dim_equity)""", seeded=SEEDED))
def seed_equities(spark, sf_dir):
    tables = StandIns(spark, sf_dir)
    return warehouse.seed_equities(tables.dim_equity, seed_instruments(spark, sf_dir))


@registered("seed_equity_master", sql(f"""
    SELECT instrument_id, symbol, name, asset_class_id, exchange_id, currency_id, sector_id, lot_size, isin, valid_from,
        valid_to, is_current, _source FROM {KNOWN}
    UNION ALL SELECT (SELECT coalesce(max(instrument_id), 0) FROM {KNOWN}) + row_number() OVER (ORDER BY symbol), symbol,
        company_name, 1, 4, 2, -1, market_lot, isin, listing_date, DATE '9999-12-31', true, 'nse-equity-master'
    FROM (SELECT * REPLACE (CAST(market_lot AS INT) AS market_lot) FROM equity_master)
    WHERE symbol NOT IN (SELECT symbol FROM {KNOWN})"""))
def seed_equity_master(spark, sf_dir):
    tables = StandIns(spark, sf_dir)
    return warehouse.seed_equity_master(known_instruments(tables), tables.equity_master)


@registered("seed_countries", f"""
    SELECT * FROM (VALUES ('UNK','UNK','Unknown',NULL), ('USA','US','United States','North America'),
        ('IND','IN','India','South Asia')) AS t(country_iso3, country_id, country_name, region)
    UNION ALL SELECT country_iso3, arg_min(country_id, row(country_id, country_name)),
        arg_min(country_name, row(country_id, country_name)), NULL
    FROM ({REVISIONS}) WHERE country_iso3 <> '' GROUP BY country_iso3""")
def seed_countries(spark, sf_dir):
    return warehouse.seed_countries(reference_rows(spark, "dim_country"), revisions(spark, sf_dir))


@registered("seed_indicators", sql("""
    SELECT * FROM known UNION ALL SELECT o_orderpriority, min('name of ' || o_orderpriority), min(o_orderstatus), 'unit'
    FROM orders WHERE o_orderpriority NOT IN (SELECT indicator_id FROM known) GROUP BY o_orderpriority""",
    known="SELECT indicator_id, indicator_name, source_id, unit FROM dim_indicator WHERE source_id = 'fred'"))
def seed_indicators(spark, sf_dir):
    known = StandIns(spark, sf_dir).dim_indicator.where("source_id = 'fred'").drop("frequency")
    incoming = revisions(spark, sf_dir).select(
        "indicator_id", F.concat(F.lit("name of "), "indicator_id").alias("indicator_name"), "source_id",
        F.lit("unit").alias("unit"))
    return warehouse.seed_indicators(known, incoming)


@registered("market_fact_load", sql(f"""
    SELECT instrument_id, date, epoch, close AS open, close AS high, close AS low, close, close AS adj_close, volume,
        CAST(year(date) AS INT) AS year FROM ({LATEST_BARS}) JOIN {KNOWN} USING (symbol)"""))
def market_fact_load(spark, sf_dir):
    tables = StandIns(spark, sf_dir)
    return warehouse.market_fact(full_bars(spark, sf_dir), known_instruments(tables))


def full_bars(spark, sf_dir):
    close = F.col("close")
    return silver_bars(spark, sf_dir).select(
        "symbol", "date", "epoch", close.alias("open"), close.alias("high"), close.alias("low"), "close",
        close.alias("adj_close"), "volume", "part")


@registered("rejected_bars", sql(f"""
    SELECT symbol, date, epoch, close, volume FROM ({LATEST_BARS}) WHERE symbol NOT IN (SELECT symbol FROM {KNOWN})"""))
def rejected_bars(spark, sf_dir):
    tables = StandIns(spark, sf_dir)
    return warehouse.rejected_bars(full_bars(spark, sf_dir), known_instruments(tables)).select(
        "symbol", "date", "epoch", "close", "volume")


@registered("macro_fact_load", f"""
    SELECT indicator_id, country_iso3, date, value, period_type, source_id FROM (
        SELECT * REPLACE (coalesce(nullif(country_iso3, ''), 'UNK') AS country_iso3), row_number() OVER (
            PARTITION BY indicator_id, coalesce(nullif(country_iso3, ''), 'UNK'), date ORDER BY lastupdated DESC) AS rn
        FROM ({REVISIONS})) WHERE rn = 1""")
def macro_fact_load(spark, sf_dir):
    return warehouse.macro_fact(revisions(spark, sf_dir))


@registered("crypto_fact_load", """
    SELECT s_suppkey AS instrument_id, CAST(ts AS DATE) AS date, value AS open, value AS high, value AS low, value AS close,
        CAST(1 AS BIGINT) AS volume, event_id AS trades, CAST(year(ts) AS INT) AS year
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    JOIN supplier ON s_suppkey = user_id WHERE rn = 1""")
def crypto_fact_load(spark, sf_dir):
    tables = StandIns(spark, sf_dir)
    instruments = tables.read("supplier").select(F.col("s_suppkey").alias("instrument_id"),
                                                 F.col("s_suppkey").cast("string").alias("symbol"))
    return warehouse.crypto_fact(klines_of_events(tables), instruments)


def klines_of_events(tables: StandIns):
    value = F.col("value")
    return tables.read("events").select(
        F.col("user_id").cast("string").alias("symbol"), F.to_date("ts").alias("date"),
        (timestamp_to_micros("ts") * 1000).alias("epoch"), value.alias("open"), value.alias("high"),
        value.alias("low"), value.alias("close"), F.lit(1).cast("bigint").alias("volume"), F.col("event_id").alias("trades"))


@registered("foreign_key_columns", """
    SELECT c_custkey, asset_class, currency, CASE asset_class WHEN 'EQUITY' THEN 1 WHEN 'INDEX' THEN 2 WHEN 'CRYPTO' THEN 3
        ELSE -1 END AS asset_class_id, CASE WHEN currency IS NULL THEN 1 WHEN currency = 'USD' THEN 1 WHEN currency = 'INR'
        THEN 2 ELSE -1 END AS currency_id, -1 AS sector_id
    FROM (SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'EQUITY' WHEN 'MACHINERY' THEN 'INDEX' WHEN 'FURNITURE'
        THEN 'CRYPTO' ELSE c_mktsegment END AS asset_class, CASE c_mktsegment WHEN 'BUILDING' THEN 'USD' WHEN 'MACHINERY'
        THEN 'INR' WHEN 'FURNITURE' THEN 'EUR' END AS currency FROM customer)""")
def foreign_key_columns(spark, sf_dir):
    rows = StandIns(spark, sf_dir).read("customer").selectExpr(
        "c_custkey", "CASE c_mktsegment WHEN 'BUILDING' THEN 'EQUITY' WHEN 'MACHINERY' THEN 'INDEX' "
        "WHEN 'FURNITURE' THEN 'CRYPTO' ELSE c_mktsegment END AS asset_class",
        "CASE c_mktsegment WHEN 'BUILDING' THEN 'USD' WHEN 'MACHINERY' THEN 'INR' WHEN 'FURNITURE' THEN 'EUR' END AS currency")
    return warehouse.with_foreign_keys(rows)


STAR_COUNTS = f"""
    SELECT 'dim_currency' AS table_name, 3 AS row_count UNION ALL SELECT 'dim_asset_class', 4
    UNION ALL SELECT 'dim_industry', 3 UNION ALL SELECT 'dim_sector', 3 UNION ALL SELECT 'dim_exchange', 5
    UNION ALL SELECT 'dim_country', 3 + count(DISTINCT country_iso3) FROM ({REVISIONS}) WHERE country_iso3 <> ''
    UNION ALL SELECT 'dim_indicator', count(DISTINCT indicator_id) FROM ({REVISIONS})
    UNION ALL SELECT 'dim_instrument', count(*) + 1 FROM symbols
    UNION ALL SELECT 'dim_equity', count(*) FROM symbols WHERE symbol NOT LIKE 'U%'
    UNION ALL SELECT 'fact_market_ohlcv', count(*) FROM ({LATEST_BARS})
    UNION ALL SELECT 'fact_macro_obs', count(*) FROM (SELECT DISTINCT indicator_id, country_iso3, date FROM ({REVISIONS}))
    UNION ALL SELECT 'fact_crypto_ohlcv', count(*) FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) FROM events)
    UNION ALL SELECT 'fact_rates_daily', count(*) FROM fact_rates_daily
    UNION ALL SELECT 'fact_filings', count(*) FROM orders JOIN symbols ON symbol = 'Supplier#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')"""


@registered("loaded_star", sql(STAR_COUNTS, symbols="""
    SELECT s_name AS symbol FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)
    UNION SELECT DISTINCT 'U' || user_id FROM events UNION SELECT symbol FROM equity_master"""))
def loaded_star(spark, sf_dir):
    """The whole warehouse load, counted table by table."""
    tables = StandIns(spark, sf_dir)
    observations = revisions(spark, sf_dir).withColumns({
        "indicator_name": F.lower("indicator_id"), "unit": F.lit("USD"), "source_id": F.lit("2")})
    klines = klines_of_events(tables).withColumn("symbol", F.concat(F.lit("U"), "symbol"))
    star = warehouse.load_star(spark, warehouse.Silver(
        full_bars(spark, sf_dir), observations, tables.equity_master, klines,
        tables.fact_rates_daily.drop("source_id"), tables.filings))
    return aggregates.union_all([aggregates.row_count(name, star[name]) for name in star.tables])
