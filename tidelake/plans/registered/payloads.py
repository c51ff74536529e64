"""Payload normalisers on documents that Spark renders from the test tables, one per row.

The DuckDB counterparts compute the expected rows from the tables, without any JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidelake.functions import timestamp_to_epoch
from tidelake.operators import dedup
from tidelake.plans.registered.registry import registered
from tidelake.plans.standins import StandIns, table
from tidelake.session import scratch_path
from tidelake.sources import files, payloads, writers

HOURS_16 = 57_600
DAY = 86_400


def json(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def spread(rows):
    """Rows dealt to all cores before documents are rendered from them, which costs far more than to move the few columns:
    a table in one small file would make a single task."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


# --- charts ---------------------------------------------------------------------

def chart_payloads(spark, sf_dir):
    """Three bars per line item: complete, without open and volume, and without prices."""
    start, price = timestamp_to_epoch("l_shipdate") + 7_200, F.col("l_extendedprice")
    none = null("double")
    quote = F.struct(
        F.array(price, none, none).alias("open"), F.array(price + 1, price + 2, price).alias("high"),
        F.array(price - 1, none, none).alias("low"), F.array(price, price + 1, none).alias("close"),
        F.array(F.col("l_quantity").cast("bigint"), null("bigint"), F.lit(5).cast("bigint")).alias("volume"))
    indicators = F.struct(F.array(quote).alias("quote"),
                          F.array(F.struct(F.array(price / 2, none, price).alias("adjclose"))).alias("adjclose"))
    result = F.struct(F.struct(F.lit("ignored").alias("symbol")).alias("meta"),
                      F.array(start, start + HOURS_16 - 7_200 + DAY, start + 2 * DAY).alias("timestamp"),
                      indicators.alias("indicators"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate",
                                                    "l_extendedprice", "l_quantity")
    return spread(lines).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("symbol"), "l_returnflag",
        json(F.struct(F.array(result).alias("result")).alias("chart")).alias("raw"))


CHART_KEY = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


@registered("chart_bars", f"""
    SELECT {CHART_KEY} AS symbol, CAST(timezone('America/New_York', to_timestamp(epoch(l_shipdate) + 7200)) AS DATE) AS date,
        CAST(epoch(l_shipdate) AS BIGINT) + 7200 AS epoch, l_extendedprice AS open, l_extendedprice + 1 AS high,
        l_extendedprice - 1 AS low, l_extendedprice AS close, l_extendedprice / 2 AS adj_close,
        CAST(l_quantity AS BIGINT) AS volume FROM lineitem
    UNION ALL SELECT {CHART_KEY}, CAST(l_shipdate AS DATE) + 1, CAST(epoch(l_shipdate) AS BIGINT) + 144000, NULL,
        l_extendedprice + 2, NULL, l_extendedprice + 1, l_extendedprice + 1, 0 FROM lineitem""")
def chart_bars(spark, sf_dir):
    return payloads.chart_bars(chart_payloads(spark, sf_dir).select("symbol", "raw"))


@registered("chart_rejects", f"SELECT {CHART_KEY} AS symbol FROM lineitem WHERE l_returnflag = 'N'")
def chart_rejects(spark, sf_dir):
    """Documents of returned lines lost their result."""
    rows = chart_payloads(spark, sf_dir)
    broken = rows.withColumn("raw", F.when(F.col("l_returnflag") == "N", '{"chart":{"result":[]}}').otherwise(F.col("raw")))
    return payloads.chart_rejects(broken.select("symbol", "raw")).select("symbol")


# --- macro pages ------------------------------------------------------------------

def page_payloads(spark, sf_dir):
    """One page per order, batched by customer; the page of a pending order has no records."""
    orders = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate", "o_totalprice"))
    text = F.col("o_orderkey").cast("string")
    meta = json(F.col("o_orderkey").alias("page"), F.lit(1).alias("pages"), F.lit(2).alias("per_page"),
                F.lit(2).alias("total"), F.col("o_orderstatus").alias("sourceid"), text.alias("lastupdated"))

    def point(iso: Column, date: Column, value: Column) -> Column:
        return F.struct(
            F.struct(F.col("o_orderpriority").alias("id"), F.lower("o_orderpriority").alias("value")).alias("indicator"),
            F.struct((F.col("o_custkey") % 7).cast("string").alias("id"), F.lit('Land "A"').alias("value")).alias("country"),
            iso.alias("countryiso3code"), date.alias("date"), value.alias("value"), F.lit("").alias("unit"),
            F.lit("").alias("obs_status"), F.lit(0).alias("decimal"))

    year = F.year("o_orderdate").cast("string")
    points = F.to_json(F.array(
        point(F.lit("USA"), year, F.col("o_totalprice")),
        point(F.lit(""), F.concat(year, F.lit("M07")), null("double"))), {"ignoreNullFields": "false"})
    body = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("["), meta, F.lit("]"))).otherwise(
        F.concat(F.lit("["), meta, F.lit(","), points, F.lit("]")))
    return orders.select(F.col("o_custkey").alias("batch"), body.alias("raw"))


PAGE_OBSERVATIONS = """
    SELECT o_orderpriority AS indicator_id, lower(o_orderpriority) AS indicator_name,
        CAST(o_custkey % 7 AS VARCHAR) AS country_id, 'Land "A"' AS country_name, iso AS country_iso3, date,
        CAST(year(o_orderdate) AS VARCHAR) AS year, 'Y' AS period_type, value, '' AS unit, '' AS obs_status,
        '0' AS decimal, sourceid AS source_id, lastupdated
    FROM (SELECT *, 'USA' AS iso, CAST(year(o_orderdate) AS VARCHAR) AS date, o_totalprice AS value FROM orders
        UNION ALL SELECT *, '', year(o_orderdate) || 'M07', NULL FROM orders)
    JOIN (SELECT o_custkey, CAST(min(o_orderkey) AS VARCHAR) AS lastupdated, arg_min(o_orderstatus, o_orderkey) AS sourceid
        FROM orders GROUP BY o_custkey) USING (o_custkey)
    WHERE o_orderstatus <> 'P'"""


@registered("page_observations", PAGE_OBSERVATIONS)
def page_observations(spark, sf_dir):
    return payloads.observations(payloads.observation_points(page_payloads(spark, sf_dir)))


@registered("page_metadata", """
    SELECT o_custkey AS batch, 1 AS pages, CAST(2 AS BIGINT) AS total, CAST(min(o_orderkey) AS VARCHAR) AS lastupdated
    FROM orders GROUP BY o_custkey""")
def page_metadata(spark, sf_dir):
    return payloads.page_metadata(page_payloads(spark, sf_dir))


@registered("macro_silver", f"""
    SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY indicator_id, country_iso3, date ORDER BY
        lastupdated DESC, source_id DESC, country_id DESC, value DESC NULLS LAST) AS rn FROM ({PAGE_OBSERVATIONS})) WHERE rn = 1""")
def macro_silver(spark, sf_dir):
    """Stored pages, which are rendered once and read for their stamps and their records, to the de-duplicated silver table."""
    path = scratch_path(spark, "pages")
    writers.write_parquet(page_payloads(spark, sf_dir), path)
    rows = payloads.observations(payloads.observation_points(files.read_parquet(spark, path)))
    return dedup.keep_latest(rows, ["indicator_id", "country_iso3", "date"], [
        F.col(c).desc_nulls_last() for c in ("lastupdated", "source_id", "country_id", "value")])


def indicator_payloads(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    topics = F.when(F.col("p_size") > 25, F.array(
        F.struct(F.lit("1").alias("id"), F.col("p_type").alias("value")),
        F.struct(F.lit("2").alias("id"), F.concat("p_brand", F.lit(" ")).alias("value"))))
    item = F.struct(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), F.lit("").alias("unit"),
        F.struct(F.col("p_size").cast("string").alias("id"), F.col("p_brand").alias("value")).alias("source"),
        F.lit("note").alias("sourceNote"), F.col("p_type").alias("sourceOrganization"), topics.alias("topics"))
    meta = json(F.lit(1).alias("page"), F.lit(1).alias("pages"))
    return part.select(F.concat(F.lit("["), meta, F.lit(","), F.to_json(F.array(item)), F.lit("]")).alias("raw"))


@registered("indicator_list", """
    SELECT CAST(p_partkey AS VARCHAR) AS indicator_id, p_name AS indicator_name, '' AS unit, CAST(p_size AS VARCHAR) AS source_id,
        p_brand AS source_name, 'note' AS source_note, p_type AS source_organization FROM part""")
def indicator_list(spark, sf_dir):
    return payloads.indicator_list(indicator_payloads(spark, sf_dir)).drop("topics")


@registered("indicator_topics", """
    SELECT CAST(p_partkey AS VARCHAR) AS indicator_id, '1' AS topic_id, p_type AS topic_name FROM part WHERE p_size > 25
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), '2', p_brand FROM part WHERE p_size > 25
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), NULL, NULL FROM part WHERE p_size <= 25""")
def indicator_topics(spark, sf_dir):
    return payloads.indicator_topics(payloads.indicator_list(indicator_payloads(spark, sf_dir)))


# --- klines, rates, filings, quotes -------------------------------------------------

@registered("kline_bars", """
    SELECT CAST(user_id AS VARCHAR) AS symbol, CAST(ts AS DATE) AS date, epoch_us(ts) // 1000 AS epoch, value AS open, value + 2 AS high,
        value - 1 AS low, value + 1 AS close, CAST(event_id AS DOUBLE) AS volume, value * 2 AS quote_volume,
        event_id AS trades FROM events""")
def kline_bars(spark, sf_dir):
    def text(value: Column | str) -> Column:
        return (F.col(value) if isinstance(value, str) else value).cast("string")

    opened = F.timestamp_diff("MILLISECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col("ts"))
    price = F.col("value")
    line = [text(opened), text(price), text(price + 2), text(price - 1), text(price + 1), text("event_id"),
            text(opened + 86_399_999), text(price * 2), text("event_id"), F.lit("0")]
    rows = table(spark, sf_dir, "events").select(text("user_id").alias("symbol"),
                                                 F.to_json(F.array(F.array(*line))).alias("raw"))
    return payloads.kline_bars(rows)


@registered("yield_curve_rates", """
    SELECT o_orderpriority AS indicator_id, CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS value
    FROM orders GROUP BY 1, 2""")
def yield_curve_rates(spark, sf_dir):
    wide = StandIns(spark, sf_dir).yield_curve.withColumn("Date", F.date_format("Date", "MM/dd/yyyy"))
    return payloads.yield_curve_rates(wide)


@registered("series_observations", """
    SELECT o_orderpriority AS indicator_id, CAST(o_orderdate AS DATE) AS date, o_totalprice AS value FROM orders
    UNION ALL SELECT o_orderpriority, CAST(o_orderdate AS DATE) + 1, NULL FROM orders""")
def series_observations(spark, sf_dir):
    day = F.to_date("o_orderdate")
    records = F.array(
        F.struct(day.cast("string").alias("date"), F.col("o_totalprice").cast("string").alias("value")),
        F.struct(F.date_add(day, 1).cast("string").alias("date"), F.lit(".").alias("value")))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("series"),
                                                 json(F.lit(2).alias("count"), records.alias("observations")).alias("raw"))
    return payloads.series_observations(rows)


@registered("filing_documents", """
    SELECT 'C' || o_custkey AS symbol, o_orderkey || '-24-1' AS accession_number, CAST(o_orderdate AS DATE) AS filing_date,
        '10-K' AS form_type, o_orderpriority AS entity_name,
        'https://www.sec.gov/Archives/edgar/data/' || (o_custkey + 1) || '/' || o_orderkey || '241/a.htm' AS url FROM orders
    UNION ALL SELECT 'C' || o_custkey, o_orderkey || '-24-2', NULL, o_orderstatus, o_orderpriority,
        'https://www.sec.gov/Archives/edgar/data/' || (o_custkey + 1) || '/' || o_orderkey || '242/b.htm' FROM orders""")
def filing_documents(spark, sf_dir):
    key = F.col("o_orderkey").cast("string")
    recent = F.struct(
        F.array(F.concat(key, F.lit("-24-1")), F.concat(key, F.lit("-24-2"))).alias("accessionNumber"),
        F.array(F.to_date("o_orderdate").cast("string"), F.lit("unknown")).alias("filingDate"),
        F.array(F.lit("10-K"), F.col("o_orderstatus")).alias("form"),
        F.array(F.lit("a.htm"), F.lit("b.htm")).alias("primaryDocument"))
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), "o_custkey").alias("symbol"),
        json(F.lpad((F.col("o_custkey") + 1).cast("string"), 10, "0").alias("cik"), F.col("o_orderpriority").alias("name"),
             F.struct(recent.alias("recent")).alias("filings")).alias("raw"))
    return payloads.filings(rows)


@registered("spot_quotes", """
    SELECT c_name AS base, c_mktsegment AS currency, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DECIMAL(38,18)) AS amount
    FROM customer""")
def spot_quotes(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(json(F.struct(
        F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("amount"), F.col("c_name").alias("base"),
        F.col("c_mktsegment").alias("currency")).alias("data")).alias("raw"))
    return payloads.spot_quotes(rows)


@registered("quote_lines", """
    SELECT 'sh' || p_partkey AS symbol, 3 AS n_fields, p_name AS name, CAST(p_retailprice AS DECIMAL(18,2)) AS price FROM part
    UNION ALL SELECT 'sz' || p_partkey, 3, p_brand, CAST(p_size AS DECIMAL(18,2)) FROM part""")
def quote_lines(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.format_string(
        'v_sh%d="1~%s~%s";\nvar hq_str_sz%d="2,%s,%d";', "p_partkey", "p_name",
        F.col("p_retailprice").cast("decimal(18,2)").cast("string"), "p_partkey", "p_brand", "p_size").alias("raw"))
    return payloads.quote_lines(rows).select(
        "symbol", F.size("fields").alias("n_fields"), F.col("fields")[1].alias("name"),
        F.col("fields")[2].try_cast("decimal(18,2)").alias("price"))


@registered("distinct_payloads", "SELECT text AS raw, min(doc_id) AS doc_id FROM documents GROUP BY text")
def distinct_payloads(spark, sf_dir):
    return payloads.distinct_payloads(table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("raw")))
