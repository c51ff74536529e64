"""The star schema built from the general-purpose test tables.

``lineitem`` plays trades, ``events`` ticks, ``supplier`` instruments, ``nation``
exchanges and countries, ``orders`` observations and filings.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelake.functions import sequence_key, timestamp_to_epoch, timestamp_to_micros
from tidelake.operators import aggregates
from tidelake.plans import warehouse
from tidelake.plans.reference import unknown_instrument
from tidelake.plans.views import Star, Views

TABLE_COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
                "l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}
TABLE_NAMES = list(TABLE_COLUMNS)
INDICATORS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trade_sequence() -> Column:
    """Trade order: order, line, price. Prices of 10^10 and more would run into the line number, so they end the job."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    cents = F.when(cents < 1_000_000_000_000, cents).otherwise(F.raise_error(F.lit("price too large to order trades")).cast("bigint"))
    return sequence_key("l_orderkey", F.col("l_linenumber").cast("bigint") * 1_000_000_000_000 + cents)


class StandIns:
    """Lazy frames over one directory of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def read(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    # --- dimensions ----------------------------------------------------------

    @property
    def dim_currency(self) -> DataFrame:
        incoming = self.read("region").selectExpr(
            "100 + r_regionkey AS currency_id", "substring(r_name, 1, 3) AS currency_code",
            "r_name AS currency_name")
        return warehouse.seed_reference(self.spark, "dim_currency", incoming, "currency_id", [])

    @property
    def dim_asset_class(self) -> DataFrame:
        incoming = self.read("part").selectExpr(
            "100 + p_size AS asset_class_id", "concat('SIZE_', p_size) AS asset_class_code",
            "concat('Size ', p_size) AS asset_class_name").distinct()
        return warehouse.seed_reference(self.spark, "dim_asset_class", incoming, "asset_class_id", [])

    @property
    def dim_industry(self) -> DataFrame:
        incoming = self.read("part").select("p_brand").distinct().selectExpr(
            "100 + CAST(regexp_extract(p_brand, '[0-9]+', 0) AS int) AS industry_id", "p_brand AS industry_name")
        return warehouse.seed_reference(self.spark, "dim_industry", incoming, "industry_id", [])

    @property
    def dim_sector(self) -> DataFrame:
        incoming = self.read("nation").selectExpr(
            "1000 + n_nationkey AS sector_id", "concat('SECTOR_', n_nationkey) AS sector_name",
            "CASE WHEN n_nationkey % 3 = 0 THEN -1 ELSE n_nationkey % 3 END AS industry_id")
        return warehouse.seed_reference(self.spark, "dim_sector", incoming, "sector_id", [])

    @property
    def dim_exchange(self) -> DataFrame:
        incoming = self.read("nation").selectExpr(
            "n_nationkey AS exchange_id", "concat('X', n_nationkey) AS exchange_code",
            "concat(n_name, ' Exchange') AS exchange_name", "n_name AS country_iso3",
            "100 + n_regionkey AS currency_id", "'UTC' AS timezone")
        return warehouse.seed_reference(self.spark, "dim_exchange", incoming, "exchange_id", [])

    @property
    def dim_country(self) -> DataFrame:
        incoming = self.read("nation").join(
            self.read("region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey").selectExpr(
            "n_name AS country_iso3", "CAST(n_nationkey AS string) AS country_id", "n_name AS country_name",
            "r_name AS region")
        return warehouse.seed_reference(self.spark, "dim_country", incoming, "country_iso3", [])

    @property
    def dim_indicator(self) -> DataFrame:
        return self.read("orders").select("o_orderpriority").distinct().select(
            F.col("o_orderpriority").alias("indicator_id"), F.lower("o_orderpriority").alias("indicator_name"),
            self._source_of("o_orderpriority").alias("source_id"), F.lit("USD").alias("unit"),
            F.lit("Y").alias("frequency"))

    @property
    def dim_instrument(self) -> DataFrame:
        rows = self.read("supplier").selectExpr(
            "s_suppkey AS instrument_id", "s_name AS symbol", "lower(s_name) AS name",
            "CASE s_suppkey % 4 WHEN 0 THEN -1 ELSE CAST(s_suppkey % 4 AS int) END AS asset_class_id",
            "s_nationkey AS exchange_id", "CAST(100 + s_suppkey % 5 AS int) AS currency_id",
            "1000 + s_nationkey AS sector_id", "CAST(s_suppkey % 10 + 1 AS int) AS lot_size",
            "concat('XS', lpad(CAST(s_suppkey AS string), 10, '0')) AS isin",
            "date'1900-01-01' AS valid_from", "date'9999-12-31' AS valid_to", "true AS is_current",
            "concat('src', s_suppkey % 4) AS _source")
        return unknown_instrument(self.spark).unionByName(rows)

    @property
    def dim_equity(self) -> DataFrame:
        known = self.read("supplier").where("s_suppkey % 4 = 1 AND s_acctbal >= 5000").selectExpr(
            "s_suppkey AS instrument_id", "s_suppkey * 1000 AS outstanding_shares", "s_acctbal AS market_cap",
            "date'2000-01-01' AS listing_date")
        return warehouse.seed_equities(known, self.dim_instrument)

    # --- facts ---------------------------------------------------------------

    @property
    def trades(self) -> DataFrame:
        return self.read("lineitem").select(
            F.col("l_suppkey").alias("instrument_id"), F.to_date("l_shipdate").alias("date"),
            timestamp_to_epoch("l_shipdate").alias("epoch"), F.col("l_extendedprice").alias("price"),
            F.col("l_quantity").alias("quantity"), trade_sequence().alias("sequence"))

    @property
    def fact_market_ohlcv(self) -> DataFrame:
        bars = aggregates.bars(self.trades, ["instrument_id", "date"], "price",
                               F.sum("quantity").cast("bigint"), F.col("sequence"), epoch=F.max("epoch"))
        return bars.select("instrument_id", "date", "epoch", "open", "high", "low", "close",
                           F.col("close").alias("adj_close"), "volume", F.year("date").alias("year"))

    @property
    def ticks(self) -> DataFrame:
        return self.read("events").select(
            F.col("user_id").alias("instrument_id"), "ts", F.to_date("ts").alias("date"),
            F.col("value").alias("price"), F.col("event_type").alias("exchange"),
            F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
            sequence_key(timestamp_to_micros("ts"), "event_id").alias("sequence"))

    @property
    def tick_bars(self) -> DataFrame:
        return aggregates.bars(self.ticks, ["instrument_id", "date"], "price", F.sum("volume"),
                               F.col("sequence"), trades=F.count(F.lit(1)))

    @property
    def fact_crypto_ohlcv(self) -> DataFrame:
        return self.tick_bars.join(self.dim_instrument.select("instrument_id"), "instrument_id", "left_semi").select(
            "instrument_id", "date", "open", "high", "low", "close", "volume", "trades",
            F.year("date").alias("year"))

    @staticmethod
    def _source_of(indicator: str) -> Column:
        return F.when(F.col(indicator) < "3", "worldbank").otherwise("fred")

    @property
    def fact_macro_obs(self) -> DataFrame:
        """Yearly order value per priority and country; orders are reduced per customer first."""
        per_customer = self.read("orders").groupBy(
            F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("indicator_id"),
            F.year("o_orderdate").alias("year")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("value"))
        customers = self.read("customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
        nations = self.read("nation").select("n_nationkey", F.col("n_name").alias("country_iso3"))
        return (per_customer.join(customers, "c_custkey").join(nations, "n_nationkey")
                .groupBy("indicator_id", "country_iso3", F.col("year").cast("string").alias("date"))
                .agg(F.sum("value").cast("double").alias("value"))
                .select("indicator_id", "country_iso3", "date", "value", F.lit("Y").alias("period_type"),
                        self._source_of("indicator_id").alias("source_id")))

    @property
    def yield_curve(self) -> DataFrame:
        """Wide daily table, one column per indicator."""
        cents = F.col("o_totalprice").cast("decimal(18,2)")
        return (self.read("orders").groupBy(F.to_date("o_orderdate").alias("Date"))
                .pivot("o_orderpriority", INDICATORS).agg(F.max(cents).cast("double")))

    @property
    def fact_rates_daily(self) -> DataFrame:
        long = self.yield_curve.unpivot(["Date"], INDICATORS, "indicator_id", "value")
        return warehouse.rates_fact(long.withColumnRenamed("Date", "date"), "fred")

    @property
    def filings(self) -> DataFrame:
        return self.read("orders").selectExpr(
            "concat('Supplier#', lpad(CAST(o_custkey AS string), 9, '0')) AS symbol",
            "lpad(CAST(o_orderkey AS string), 18, '0') AS accession_number",
            "CAST(o_orderdate AS date) AS filing_date", "o_orderstatus AS form_type",
            "concat('Customer ', o_custkey) AS entity_name",
            "concat('https://example.com/filings/', o_orderkey) AS url")

    @property
    def fact_filings(self) -> DataFrame:
        return warehouse.filings_fact(self.filings, self.dim_instrument)

    # --- silver --------------------------------------------------------------

    @property
    def silver_bars(self) -> DataFrame:
        symbols = self.dim_instrument.select("instrument_id", "symbol")
        return self.fact_market_ohlcv.join(symbols, "instrument_id").select(
            "symbol", F.col("date").cast("string").alias("date"), "epoch", "open", "high", "low", "close",
            "adj_close", "volume")

    @property
    def equity_master(self) -> DataFrame:
        return self.read("part").selectExpr(
            "concat('Supplier#', lpad(CAST(p_partkey AS string), 9, '0')) AS symbol", "p_name AS company_name",
            "concat('INE', p_partkey) AS isin", "CAST(p_size AS string) AS market_lot",
            "date_add(date'2000-01-01', p_size) AS listing_date")

    # --- whole star ----------------------------------------------------------

    STAR = ("dim_currency", "dim_asset_class", "dim_industry", "dim_sector", "dim_exchange", "dim_country",
            "dim_indicator", "dim_instrument", "dim_equity", "fact_market_ohlcv", "fact_crypto_ohlcv",
            "fact_macro_obs", "fact_rates_daily", "fact_filings", "silver_bars", "equity_master")

    @cached_property
    def star(self) -> Star:
        return Star({name: (lambda n=name: getattr(self, n)) for name in self.STAR})

    @property
    def views(self) -> Views:
        return Views(self.star)
