"""The named datasets over the stand-in star schema."""

from __future__ import annotations

import re

from tidelake.plans import adhoc
from tidelake.plans.registered.registry import registered, rounded
from tidelake.plans.standins import StandIns
from tidelake.plans.views import register_views

# The stand-in star schema in DuckDB's dialect.
CTE = {
    "dim_currency": """
        SELECT * FROM (VALUES (-1,'UNK','Unknown'), (1,'USD','US Dollar'), (2,'INR','Indian Rupee'))
            AS t(currency_id, currency_code, currency_name)
        UNION ALL SELECT 100 + r_regionkey, substring(r_name, 1, 3), r_name FROM region""",
    "dim_asset_class": """
        SELECT * FROM (VALUES (-1,'UNKNOWN','Unknown'), (1,'EQUITY','Equity'), (2,'INDEX','Index'),
            (3,'CRYPTO','Crypto')) AS t(asset_class_id, asset_class_code, asset_class_name)
        UNION ALL SELECT DISTINCT 100 + p_size, 'SIZE_' || p_size, 'Size ' || p_size FROM part""",
    "dim_industry": """
        SELECT * FROM (VALUES (-1,'UNKNOWN'), (1,'Technology'), (2,'Financials')) AS t(industry_id, industry_name)
        UNION ALL SELECT DISTINCT 100 + CAST(regexp_extract(p_brand, '[0-9]+') AS INT), p_brand FROM part""",
    "dim_sector": """
        SELECT * FROM (VALUES (-1,'UNKNOWN',-1), (1,'TECHNOLOGY',1), (2,'UNKNOWN_SECTOR',-1))
            AS t(sector_id, sector_name, industry_id)
        UNION ALL SELECT 1000 + n_nationkey, 'SECTOR_' || n_nationkey,
            CASE WHEN n_nationkey % 3 = 0 THEN -1 ELSE n_nationkey % 3 END FROM nation""",
    "dim_exchange": """
        SELECT * FROM (VALUES (-1,'UNKNOWN','Unknown',NULL,-1,NULL), (1,'NASDAQ','NASDAQ','USA',1,'America/New_York'),
            (2,'NYSE','NYSE','USA',1,'America/New_York'), (3,'BSE','Bombay SE','IND',2,'Asia/Kolkata'),
            (4,'NSE','National Stock Exchange','IND',2,'Asia/Kolkata'))
            AS t(exchange_id, exchange_code, exchange_name, country_iso3, currency_id, timezone)
        UNION ALL SELECT n_nationkey, 'X' || n_nationkey, n_name || ' Exchange', n_name, 100 + n_regionkey, 'UTC'
            FROM nation WHERE n_nationkey NOT IN (-1, 1, 2, 3, 4)""",
    "dim_country": """
        SELECT * FROM (VALUES ('UNK','UNK','Unknown',NULL), ('USA','US','United States','North America'),
            ('IND','IN','India','South Asia')) AS t(country_iso3, country_id, country_name, region)
        UNION ALL SELECT n_name, CAST(n_nationkey AS VARCHAR), n_name, r_name
            FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "dim_indicator": """
        SELECT DISTINCT o_orderpriority AS indicator_id, lower(o_orderpriority) AS indicator_name,
            CASE WHEN o_orderpriority < '3' THEN 'worldbank' ELSE 'fred' END AS source_id,
            'USD' AS unit, 'Y' AS frequency FROM orders""",
    "dim_instrument": """
        SELECT CAST(-1 AS BIGINT) AS instrument_id, 'UNKNOWN' AS symbol, 'Unknown' AS name, -1 AS asset_class_id,
            -1 AS exchange_id, 1 AS currency_id, -1 AS sector_id, 1 AS lot_size, CAST(NULL AS VARCHAR) AS isin,
            DATE '1900-01-01' AS valid_from, DATE '9999-12-31' AS valid_to, true AS is_current, 'system' AS _source
        UNION ALL SELECT s_suppkey, s_name, lower(s_name),
            CAST(CASE s_suppkey % 4 WHEN 0 THEN -1 ELSE s_suppkey % 4 END AS INT), s_nationkey,
            CAST(100 + s_suppkey % 5 AS INT), 1000 + s_nationkey, CAST(s_suppkey % 10 + 1 AS INT),
            'XS' || lpad(CAST(s_suppkey AS VARCHAR), 10, '0'), DATE '1900-01-01', DATE '9999-12-31', true,
            'src' || (s_suppkey % 4) FROM supplier""",
    "dim_equity": """
        SELECT s_suppkey AS instrument_id, s_suppkey * 1000 AS outstanding_shares, s_acctbal AS market_cap,
            DATE '2000-01-01' AS listing_date FROM supplier WHERE s_suppkey % 4 = 1 AND s_acctbal >= 5000
        UNION ALL SELECT s_suppkey, NULL, NULL, NULL FROM supplier WHERE s_suppkey % 4 = 1 AND s_acctbal < 5000""",
    "fact_market_ohlcv": """
        SELECT l_suppkey AS instrument_id, CAST(l_shipdate AS DATE) AS date,
            CAST(max(epoch(l_shipdate)) AS BIGINT) AS epoch,
            arg_min(l_extendedprice, row(l_orderkey, l_linenumber, l_extendedprice)) AS open,
            max(l_extendedprice) AS high, min(l_extendedprice) AS low,
            arg_max(l_extendedprice, row(l_orderkey, l_linenumber, l_extendedprice)) AS close,
            arg_max(l_extendedprice, row(l_orderkey, l_linenumber, l_extendedprice)) AS adj_close,
            CAST(sum(l_quantity) AS BIGINT) AS volume, CAST(year(CAST(l_shipdate AS DATE)) AS INT) AS year
        FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)""",
    "tick_bars": """
        SELECT user_id AS instrument_id, CAST(ts AS DATE) AS date, arg_min(value, row(ts, event_id)) AS open,
            max(value) AS high, min(value) AS low, arg_max(value, row(ts, event_id)) AS close,
            CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS volume, count(*) AS trades
        FROM events GROUP BY user_id, CAST(ts AS DATE)""",
    "fact_crypto_ohlcv": """
        SELECT *, CAST(year(date) AS INT) AS year FROM tick_bars
        WHERE instrument_id IN (SELECT instrument_id FROM dim_instrument)""",
    "fact_macro_obs": """
        SELECT o_orderpriority AS indicator_id, n_name AS country_iso3,
            CAST(year(o_orderdate) AS VARCHAR) AS date,
            CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value, 'Y' AS period_type,
            CASE WHEN o_orderpriority < '3' THEN 'worldbank' ELSE 'fred' END AS source_id
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        GROUP BY 1, 2, 3""",
    "fact_rates_daily": """
        SELECT o_orderpriority AS indicator_id, CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS value,
            'fred' AS source_id FROM orders GROUP BY 1, 2""",
    "fact_filings": """
        SELECT instrument_id, lpad(CAST(o_orderkey AS VARCHAR), 18, '0') AS accession_number,
            CAST(o_orderdate AS DATE) AS filing_date, o_orderstatus AS form_type,
            'Customer ' || o_custkey AS entity_name, 'https://example.com/filings/' || o_orderkey AS url
        FROM orders JOIN dim_instrument ON symbol = 'Supplier#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')""",
    "equity_master": """
        SELECT 'Supplier#' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS symbol, p_name AS company_name,
            'INE' || p_partkey AS isin, CAST(p_size AS VARCHAR) AS market_lot, DATE '2000-01-01' + p_size AS listing_date
        FROM part""",
    "bars": "SELECT i.symbol, i.asset_class_id, f.* FROM fact_market_ohlcv f JOIN dim_instrument i USING (instrument_id)",
    "returns": """
        SELECT *, close / nullif(lag(close) OVER (PARTITION BY instrument_id ORDER BY date), 0) - 1 AS ret_1d
        FROM bars""",
}


def sql(body: str, **local: str) -> str:
    """``body`` after the common table expressions it refers to, directly or through others."""
    known = {**CTE, **local}
    needed: list[str] = []

    def need(text: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b{name}\b", text):
                need(known[name])
                needed.append(name)

    need(body)
    return "WITH " + ", ".join(f"{name} AS ({known[name]})" for name in needed) + "\n" + body


@registered("returns_daily", sql("SELECT symbol, asset_class_id, date, close, volume, ret_1d FROM returns"))
def returns_daily(spark, sf_dir):
    return StandIns(spark, sf_dir).views.returns_daily


@registered("returns_cumulative", sql("""
    SELECT symbol, date, close, ret_1d, round(exp(sum(CASE WHEN 1 + ret_1d > 0 THEN ln(1 + ret_1d) END)
        OVER (PARTITION BY instrument_id ORDER BY date)), 6) AS cum_return
    FROM returns WHERE ret_1d IS NOT NULL"""))
def returns_cumulative(spark, sf_dir):
    return rounded(StandIns(spark, sf_dir).views.returns_cumulative, cum_return=6)


@registered("volatility_30d", sql("""
    SELECT symbol, date, ret_1d, round(stddev_samp(ret_1d) OVER (PARTITION BY instrument_id ORDER BY date
        ROWS BETWEEN 30 PRECEDING AND CURRENT ROW) * sqrt(252), 6) AS vol_30d_annualized
    FROM returns WHERE ret_1d IS NOT NULL"""))
def volatility_30d(spark, sf_dir):
    return rounded(StandIns(spark, sf_dir).views.volatility_30d, vol_30d_annualized=6)


YOY = """
    SELECT indicator_id, country_iso3, date, value, source_id, lag(value) OVER w AS prev_value,
        value / nullif(lag(value) OVER w, 0) - 1 AS yoy_pct
    FROM fact_macro_obs WINDOW w AS (PARTITION BY indicator_id, country_iso3 ORDER BY date)"""


@registered("macro_yoy", sql(YOY))
def macro_yoy(spark, sf_dir):
    return StandIns(spark, sf_dir).views.macro_yoy


@registered("worldbank_yoy", sql(f"SELECT * FROM ({YOY}) WHERE source_id = 'worldbank'"))
def worldbank_yoy(spark, sf_dir):
    return StandIns(spark, sf_dir).views.worldbank_yoy


def _of(column: str, dimension: str, key: str, value: str = "instrument") -> str:
    """Look-up of one attribute by sub-select."""
    return f"(SELECT any_value({column}) FROM {dimension} WHERE {dimension}.{key} = {value}.{key}) AS {column}"


DETAIL = f"""
    SELECT instrument_id, symbol, name, isin, lot_size, valid_from, valid_to, is_current,
        {_of("asset_class_code", "dim_asset_class", "asset_class_id")}, {_of("asset_class_name", "dim_asset_class", "asset_class_id")},
        {_of("currency_code", "dim_currency", "currency_id")}, {_of("currency_name", "dim_currency", "currency_id")},
        {_of("exchange_code", "dim_exchange", "exchange_id")}, {_of("exchange_name", "dim_exchange", "exchange_id")},
        {_of("country_iso3", "dim_exchange", "exchange_id")}, {_of("sector_name", "dim_sector", "sector_id")},
        (SELECT any_value(industry_name) FROM dim_industry WHERE industry_id = (
            SELECT any_value(industry_id) FROM dim_sector WHERE dim_sector.sector_id = instrument.sector_id)) AS industry_name
    FROM dim_instrument AS instrument WHERE asset_class_id IN (SELECT asset_class_id FROM dim_asset_class)
        AND currency_id IN (SELECT currency_id FROM dim_currency) AND exchange_id IN (SELECT exchange_id FROM dim_exchange)
        AND sector_id IN (SELECT sector_id FROM dim_sector WHERE industry_id IN (SELECT industry_id FROM dim_industry))"""


@registered("instrument_detail", sql(DETAIL))
def instrument_detail(spark, sf_dir):
    return StandIns(spark, sf_dir).views.instrument_detail


@registered("master_instrument_detail", sql(DETAIL))
def master_instrument_detail(spark, sf_dir):
    return StandIns(spark, sf_dir).views.master_instrument_detail


# counted on the tables that the facts stand for: traded supplier days, ticked customer days, orders
COVERAGE = """
    SELECT * FROM (VALUES
        ('dim_instrument', (SELECT count(*) FROM supplier WHERE s_suppkey <> -1),
            (SELECT count(DISTINCT s_suppkey % 4) FROM supplier WHERE s_suppkey <> -1)),
        ('fact_market_ohlcv', (SELECT count(DISTINCT (l_suppkey, CAST(l_shipdate AS DATE))) FROM lineitem
            WHERE l_suppkey IN (SELECT s_suppkey FROM supplier)),
            (SELECT count(DISTINCT l_suppkey % 4) FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier))),
        ('fact_crypto_ohlcv', (SELECT count(DISTINCT (user_id, CAST(ts AS DATE))) FROM events
            WHERE user_id IN (SELECT s_suppkey FROM supplier)), 0),
        ('fact_macro_obs', (SELECT count(DISTINCT (o_orderpriority, c_nationkey, year(o_orderdate))) FROM orders
            JOIN customer ON o_custkey = c_custkey), (SELECT count(DISTINCT o_orderpriority < '3') FROM orders)),
        ('fact_rates_daily', (SELECT count(DISTINCT (o_orderpriority, CAST(o_orderdate AS DATE))) FROM orders), 1),
        ('fact_filings', (SELECT count(*) FROM orders WHERE o_custkey IN (
            SELECT CAST(substr(s_name, 10) AS BIGINT) FROM supplier)), 0)
    ) AS t(table_name, row_count, sources)"""


@registered("source_coverage", sql(COVERAGE))
def source_coverage(spark, sf_dir):
    return StandIns(spark, sf_dir).views.source_coverage


@registered("all_sources_summary", sql(COVERAGE))
def all_sources_summary(spark, sf_dir):
    return StandIns(spark, sf_dir).views.all_sources_summary


SUMMARY = """
    SELECT symbol, count(*) AS bars, CAST(sum(CAST(close AS DECIMAL(28,6))) AS DOUBLE) / count(close) AS avg_close, max(high) AS max_high,
        min(low) AS min_low, CAST(sum(volume) AS BIGINT) AS total_vol FROM bars GROUP BY symbol"""


@registered("market_summary", sql(SUMMARY))
def market_summary(spark, sf_dir):
    return StandIns(spark, sf_dir).views.yahoo_summary


@registered("market_summary_short", sql(
    "SELECT symbol, count(*) AS bars, CAST(sum(CAST(close AS DECIMAL(28,6))) AS DOUBLE) / count(close) AS avg_close FROM bars GROUP BY symbol"))
def market_summary_short(spark, sf_dir):
    return StandIns(spark, sf_dir).views.yahoo_summary_short


@registered("market_ohlcv", sql(
    "SELECT symbol, date, open, high, low, close, adj_close, volume, year FROM bars"))
def market_ohlcv(spark, sf_dir):
    return StandIns(spark, sf_dir).views.market_ohlcv


@registered("market_crypto", sql("""
    SELECT symbol, date, open, high, low, close, volume, trades, year
    FROM fact_crypto_ohlcv JOIN dim_instrument USING (instrument_id)"""))
def market_crypto(spark, sf_dir):
    return StandIns(spark, sf_dir).views.market_crypto


@registered("market_filings", sql("""
    SELECT symbol, accession_number, filing_date, form_type, entity_name, url
    FROM fact_filings JOIN dim_instrument USING (instrument_id)"""))
def market_filings(spark, sf_dir):
    return StandIns(spark, sf_dir).views.market_filings


@registered("macro_observation", sql("""
    SELECT indicator_id, indicator_name, country_iso3, country_name, date, value, period_type, m.source_id
    FROM fact_macro_obs m JOIN dim_indicator USING (indicator_id) JOIN dim_country USING (country_iso3)"""))
def macro_observation(spark, sf_dir):
    return StandIns(spark, sf_dir).views.macro_observation


@registered("macro_rates", sql("SELECT indicator_id, date, value, source_id FROM fact_rates_daily"))
def macro_rates(spark, sf_dir):
    return StandIns(spark, sf_dir).views.macro_rates


@registered("macro_previous", sql("""
    SELECT indicator_id, country_iso3, date, value,
        lag(value) OVER (PARTITION BY indicator_id, country_iso3 ORDER BY date) AS prev FROM fact_macro_obs"""))
def macro_previous(spark, sf_dir):
    return StandIns(spark, sf_dir).views.macro_previous


@registered("silver_observations", sql("SELECT * FROM fact_macro_obs"))
def silver_observations(spark, sf_dir):
    return StandIns(spark, sf_dir).views.silver_worldbank_observations


@registered("ref_currency", sql(
    "SELECT currency_id AS id, currency_code AS code, currency_name AS name FROM dim_currency"))
def ref_currency(spark, sf_dir):
    return StandIns(spark, sf_dir).views.ref_currency


@registered("ref_asset_class", sql(
    "SELECT asset_class_id AS id, asset_class_code AS code, asset_class_name AS name FROM dim_asset_class"))
def ref_asset_class(spark, sf_dir):
    return StandIns(spark, sf_dir).views.ref_asset_class


@registered("ref_industry", sql("SELECT industry_id AS id, industry_name AS name FROM dim_industry"))
def ref_industry(spark, sf_dir):
    return StandIns(spark, sf_dir).views.ref_industry


@registered("ref_sector", sql("SELECT sector_id AS id, sector_name AS name, industry_id FROM dim_sector"))
def ref_sector(spark, sf_dir):
    return StandIns(spark, sf_dir).views.ref_sector


@registered("ref_country", sql("SELECT country_iso3 AS code, country_name AS name, region FROM dim_country"))
def ref_country(spark, sf_dir):
    return StandIns(spark, sf_dir).views.ref_country


@registered("ref_indicator", sql(
    "SELECT indicator_id AS id, indicator_name AS name, source_id, unit, frequency FROM dim_indicator"))
def ref_indicator(spark, sf_dir):
    return StandIns(spark, sf_dir).views.ref_indicator


@registered("ref_exchange", sql("""
    SELECT exchange_id AS id, exchange_code AS code, exchange_name AS name, country_iso3, currency_id
    FROM dim_exchange"""))
def ref_exchange(spark, sf_dir):
    return StandIns(spark, sf_dir).views.ref_exchange


@registered("master_instrument", sql("""
    SELECT instrument_id AS id, symbol, name, asset_class_id, exchange_id, currency_id, sector_id, lot_size,
        isin, is_current FROM dim_instrument"""))
def master_instrument(spark, sf_dir):
    return StandIns(spark, sf_dir).views.master_instrument


@registered("master_equity", sql(
    "SELECT instrument_id AS id, outstanding_shares, market_cap, listing_date FROM dim_equity"))
def master_equity(spark, sf_dir):
    return StandIns(spark, sf_dir).views.master_equity


@registered("master_equity_of_country", sql("""
    SELECT i.symbol, i.name, i.isin, c.currency_code, e.exchange_code
    FROM dim_instrument i JOIN dim_currency c ON c.currency_id = i.currency_id
    JOIN dim_exchange e ON e.exchange_id = i.exchange_id
    WHERE i.asset_class_id = 1 AND e.country_iso3 = 'IND'"""))
def master_equity_of_country(spark, sf_dir):
    return StandIns(spark, sf_dir).views.master_equity_india


@registered("instrument_3nf", sql(f"""
    SELECT instrument_id, symbol, name, asset_class_code, currency_code, sector_name, industry_name, exchange_code
    FROM ({DETAIL})"""))
def instrument_3nf(spark, sf_dir):
    return StandIns(spark, sf_dir).views.instrument_3nf


@registered("ohlcv_3nf", sql("""
    SELECT symbol, asset_class_code, currency_code, sector_name, date, close, volume
    FROM fact_market_ohlcv f JOIN dim_instrument i USING (instrument_id)
    JOIN dim_asset_class a ON a.asset_class_id = i.asset_class_id
    JOIN dim_currency c ON c.currency_id = i.currency_id JOIN dim_sector s ON s.sector_id = i.sector_id"""))
def ohlcv_3nf(spark, sf_dir):
    return StandIns(spark, sf_dir).views.ohlcv_3nf


@registered("equity_ohlcv", sql("""
    SELECT symbol, asset_class_code AS asset_class, f.*
    FROM fact_market_ohlcv f JOIN dim_instrument i USING (instrument_id) JOIN dim_asset_class USING (asset_class_id)"""))
def equity_ohlcv(spark, sf_dir):
    return StandIns(spark, sf_dir).views.equity_ohlcv


@registered("silver_yahoo_ohlcv", sql("""
    SELECT symbol, date AS trade_date, epoch, open, high, low, close, adj_close, volume FROM bars"""))
def silver_yahoo_ohlcv(spark, sf_dir):
    return StandIns(spark, sf_dir).views.silver_yahoo_ohlcv


@registered("silver_equity_master", sql("SELECT * FROM equity_master"))
def silver_equity_master(spark, sf_dir):
    return StandIns(spark, sf_dir).views.silver_equity_master


ADHOC = """
    SELECT coalesce(m.symbol, f.symbol) AS symbol, m.days, m.top, f.filings FROM
        (SELECT symbol, count(*) AS days, max(high) AS top FROM {bars} WHERE year >= 1996 GROUP BY symbol
         HAVING count(*) > 1) m
    FULL OUTER JOIN (SELECT symbol, count(DISTINCT form_type) AS filings FROM {filings} GROUP BY symbol) f
        ON m.symbol = f.symbol"""


@registered("adhoc_sql", sql(ADHOC.format(
    bars="bars", filings="(SELECT * FROM fact_filings JOIN dim_instrument USING (instrument_id))")))
def adhoc_sql(spark, sf_dir):
    """Free SQL over the registered views."""
    register_views(spark, StandIns(spark, sf_dir).star)
    return adhoc.query(spark, ADHOC.format(bars="market_ohlcv", filings="market_filings"))
