"""Jobs from raw payload files to typed silver, over documents that Spark renders from the test tables.

Every document is written as a file of its own, indented over many lines, under the name that raw stores use; one of twenty is
torn, another holds nothing. Documents are keyed by ids whose number grows with the tables, so each stays small. The
DuckDB counterparts compute silver and rejects from the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidelake.functions import timestamp_to_epoch
from tidelake.operators import aggregates
from tidelake.plans import jobs
from tidelake.plans.registered.registry import registered
from tidelake.plans.standins import StandIns, table
from tidelake.session import checkpointed, scratch_path
from tidelake.sources import catalog, files, writers


def pretty(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false", "pretty": "true"})


def text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def run(spark, source, documents, key, name):
    """Write one file per document ``(key, number, raw)``; run the source's job; its silver table."""
    bronze, root = scratch_path(spark, f"bronze-{name}"), scratch_path(spark, f"lake-{name}")
    # documents whose number has the remainder 19 of 20 are cut short, those with 18 are empty
    broken = documents.withColumn("raw", F.when(F.col("number") % 20 == 19, F.substring("raw", 1, 30)).when(
        F.col("number") % 20 == 18, F.lit("{}" if source != "binance" else "[]")).otherwise(F.col("raw")))
    writers.write_raw(broken, bronze, key, "raw", "number")
    rejected = jobs.load_feed(spark, source, bronze, root)
    return catalog.read_table(spark, root, jobs.FEEDS[source].table), rejected


def charts(spark, sf_dir):
    """One chart per supplier, with a bar for each of its trading days: the day's highest price."""
    days = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", F.to_date("l_shipdate").alias("day")).agg(
        F.max("l_extendedprice").alias("price"))
    bars = days.groupBy("l_suppkey").agg(F.array_sort(F.collect_list(F.struct(
        (F.unix_date("day").cast("bigint") * 86_400 + 57_600).alias("at"), "price"))).alias("bars"))
    price = F.col("bars.price")
    quote = F.struct(price.alias("open"), price.alias("high"), price.alias("low"), price.alias("close"),
                     F.transform("bars", lambda b: F.when(b["price"] > 50_000, 1e20).otherwise(7.0)).alias("volume"))
    result = F.struct(F.struct(text("l_suppkey").alias("symbol")).alias("meta"), F.col("bars.at").alias("timestamp"),
                      F.struct(F.array(quote).alias("quote")).alias("indicators"))
    return bars.select(F.concat(F.lit("S"), "l_suppkey").alias("symbol"), F.col("l_suppkey").alias("number"),
                       pretty(F.struct(F.array(result).alias("result")).alias("chart")).alias("raw"))


@registered("feed_charts", """
    SELECT 'S' || l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS date, max(l_extendedprice) AS close,
        CAST(CASE WHEN max(l_extendedprice) > 50000 THEN 0 ELSE 7 END AS BIGINT) AS volume
    FROM lineitem WHERE l_suppkey % 20 < 18 GROUP BY ALL""")
def feed_charts(spark, sf_dir):
    """A volume beyond 64 bits becomes 0; it does not end the job."""
    rows, _ = run(spark, "yahoo", charts(spark, sf_dir), "symbol", "charts")
    return rows.select("symbol", "date", "close", "volume")


@registered("feed_klines", """
    SELECT 'C' || user_id AS symbol, CAST(ts AS DATE) AS date, arg_max(value, row(epoch_us(ts) // 1000, value)) AS close
    FROM (SELECT * FROM events WHERE user_id % 20 < 18) GROUP BY ALL""")
def feed_klines(spark, sf_dir):
    """A page of arrays per symbol and month, one file each; the newest line of a day stays."""
    at = F.timestamp_diff("MILLISECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col("ts"))
    line = [text(at), *[text("value")] * 4, F.lit("1"), F.lit("0"), F.lit("0"), F.lit("3")]
    pages = table(spark, sf_dir, "events").groupBy("user_id", F.date_format("ts", "yyyyMM").cast("bigint").alias("page")).agg(
        F.to_json(F.collect_list(F.array(*line)), {"pretty": "true"}).alias("raw"))
    documents = pages.select(F.concat(F.lit("C"), "user_id").alias("symbol"), (F.col("page") * 20 + F.col("user_id") % 20).alias("number"), "raw")
    rows, _ = run(spark, "binance", documents, "symbol", "klines")
    return rows.select("symbol", "date", "close")


@registered("feed_series", """
    SELECT 'P' || (o_orderkey // 100) AS indicator_id, CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS value
    FROM orders WHERE o_orderkey // 100 % 20 < 18 GROUP BY ALL""")
def feed_series(spark, sf_dir):
    day = F.to_date("o_orderdate")
    daily = table(spark, sf_dir, "orders").groupBy(F.floor(F.col("o_orderkey") / 100).alias("k"), day.alias("day")).agg(
        F.max("o_totalprice").alias("value"))
    documents = daily.groupBy("k").agg(F.collect_list(F.struct(text("day").alias("date"), text("value").alias("value"))).alias("observations"))
    rows, _ = run(spark, "fred", documents.select(F.concat(F.lit("P"), "k").alias("series"), F.col("k").alias("number"),
                                                  pretty("observations").alias("raw")), "series", "series")
    return rows


@registered("feed_filings", """
    SELECT 'F' || o_custkey AS symbol, CAST(o_orderkey AS VARCHAR) AS accession_number, CAST(o_orderdate AS DATE) AS filing_date,
        o_orderstatus AS form_type, 'https://www.sec.gov/Archives/edgar/data/' || (o_custkey + 1) || '/' || o_orderkey || '/a.htm' AS url
    FROM orders WHERE o_custkey % 20 < 18""")
def feed_filings(spark, sf_dir):
    filed = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.collect_list(F.struct(
        text("o_orderkey").alias("number"), text(F.to_date("o_orderdate")).alias("day"), "o_orderstatus")).alias("f"))
    recent = F.struct(F.col("f.number").alias("accessionNumber"), F.col("f.day").alias("filingDate"), F.col("f.o_orderstatus").alias("form"),
                      F.transform("f", lambda _: F.lit("a.htm")).alias("primaryDocument"))
    documents = filed.select(F.concat(F.lit("F"), "k").alias("symbol"), F.col("k").alias("number"), pretty(
        F.lpad(text(F.col("k") + 1), 10, "0").alias("cik"), F.lit("n").alias("name"), F.struct(recent.alias("recent")).alias("filings")).alias("raw"))
    rows, _ = run(spark, "sec", documents, "symbol", "filings")
    return rows.drop("entity_name")


@registered("feed_spot", """
    SELECT c_name AS base, c_mktsegment AS currency, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DECIMAL(38,18)) AS amount
    FROM customer WHERE c_custkey % 20 < 18""")
def feed_spot(spark, sf_dir):
    """A document for every customer."""
    documents = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("symbol"), F.col("c_custkey").alias("number"), pretty(F.struct(
            text(F.col("c_acctbal").cast("decimal(18,2)")).alias("amount"), F.col("c_name").alias("base"),
            F.col("c_mktsegment").alias("currency")).alias("data")).alias("raw"))
    rows, _ = run(spark, "coinbase", documents, "symbol", "spot")
    return rows


def quote_documents(spark, sf_dir):
    """Quote lines of a hundred parts to a file, as several sources send them."""
    lines = table(spark, sf_dir, "part").groupBy(F.floor(F.col("p_partkey") / 100).alias("k")).agg(F.array_join(F.collect_list(
        F.format_string('v_sh%d="1~%s~2";', "p_partkey", "p_name")), "\n").alias("raw"))
    return lines.select(F.concat(F.lit("Q"), "k").alias("symbol"), F.col("k").alias("number"),
                        F.when(F.col("k") % 20 == 19, "").otherwise(F.col("raw")).alias("raw"))


@registered("feed_quotes", """
    SELECT 'sh' || p_partkey AS symbol, p_name AS name FROM part WHERE p_partkey // 100 % 20 < 18""")
def feed_quotes(spark, sf_dir):
    rows, _ = run(spark, "tencent", quote_documents(spark, sf_dir), "symbol", "quotes")
    return rows.select("symbol", F.get("fields", F.lit(1)).alias("name"))


@registered("feed_other_charts", """
    SELECT source, 'S' || l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS date, max(l_extendedprice) AS close
    FROM lineitem, (VALUES ('cboe'), ('investing')) s(source) WHERE l_suppkey % 20 < 18 GROUP BY ALL""")
def feed_other_charts(spark, sf_dir):
    """Two more sources of charts, each with a table of its own."""
    documents = checkpointed(charts(spark, sf_dir))
    return aggregates.union_all([run(spark, source, documents, "symbol", source)[0].select(
        F.lit(source).alias("source"), "symbol", "date", "close") for source in catalog.CHART_SOURCES])


@registered("feed_other_quotes", """
    SELECT source, 'sh' || p_partkey AS symbol, p_name AS name FROM part, (VALUES ('sina'), ('eastmoney'), ('baostock')) s(source)
    WHERE p_partkey // 100 % 20 < 18""")
def feed_other_quotes(spark, sf_dir):
    """Three more sources of quote lines; the first of them spells its lines in its own way."""
    documents = checkpointed(quote_documents(spark, sf_dir))
    own = documents.withColumn("raw", F.regexp_replace("raw", 'v_sh(\\d+)="1~(.*)~2";', 'var hq_str_sh$1="1,$2,2";'))
    return aggregates.union_all([run(spark, source, own if source == "sina" else documents, "symbol", source)[0].select(
        F.lit(source).alias("source"), "symbol", F.get("fields", F.lit(1)).alias("name")) for source in catalog.QUOTE_SOURCES])


@registered("feed_rejects", """
    SELECT 'yahoo' AS source, 'S' || l_suppkey AS key, CASE l_suppkey % 20 WHEN 19 THEN 'unreadable' ELSE 'no records' END AS reason,
        true AS complete FROM (SELECT DISTINCT l_suppkey FROM lineitem) WHERE l_suppkey % 20 >= 18""")
def feed_rejects(spark, sf_dir):
    """Torn and empty charts by key; accepted and rejected ones together are all."""
    documents = charts(spark, sf_dir)
    rows, rejected = run(spark, "yahoo", documents, "symbol", "rejects")
    total = documents.count()
    complete = rows.select("symbol").distinct().count() + rejected.count() == total
    return rejected.withColumn("complete", F.lit(complete))


CURVE = """
    SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS indicator_id, max(o_totalprice) AS value FROM orders
    GROUP BY ALL"""


@registered("feed_yield_curve", CURVE)
def feed_yield_curve(spark, sf_dir):
    """Wide CSV files per month, whose headers have other columns in another order each, with unreadable lines, to the wide
    silver table and on to rates. Files lie as raw stores write them, one below each key."""
    from tidelake.sources import payloads
    bronze, root = scratch_path(spark, "bronze-curve"), scratch_path(spark, "lake-curve")
    wide = StandIns(spark, sf_dir).yield_curve
    names = wide.columns[1:]
    day, month = F.date_format("Date", "MM/dd/yyyy"), F.date_format("Date", "yyyyMM")
    values = {c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in names}
    layouts = [["Date", *names], [*names[::-1], "Date"], ["Date", *names[2:], names[0], names[1], "20 Yr"]]
    rows = wide.select(month.alias("month"), (F.month("Date") % 3).alias("layout"), F.array(*[F.concat_ws(",", *[
        day if c == "Date" else F.concat(F.lit('"'), values[c], F.lit('"')) if c in values else F.lit("") for c in layout])
        for layout in layouts]).alias("lines"))
    heads = F.array(*[F.lit(",".join(f'"{c}"' for c in layout)) for layout in layouts])
    bad = F.lit("n/a" + "," * len(names))
    texts = checkpointed(rows).groupBy("month", "layout").agg(F.collect_list(F.get("lines", F.col("layout"))).alias("lines"))
    writers.write_raw(texts.select("month", F.concat(F.get(heads, F.col("layout")), F.lit("\r\n"), F.array_join("lines", "\r\n"), F.when(
        F.col("layout") == 0, F.concat(F.lit("\r\n\r\n"), bad)).otherwise("")).alias("value")), bronze, "month")
    if jobs.load_yield_curve(spark, bronze, root).count() != texts.where("layout = 0").count():
        raise ValueError("a line of every third file has no date")
    silver = spark.read.parquet(f"{root}/silver/yield_curve")
    if set(silver.columns) != {"Date", *names, "20 Yr"}:
        raise ValueError(f"columns {silver.columns}")
    return payloads.yield_curve_rates(silver)


@registered("bronze_rejects", """
    SELECT reason, count(*) AS lines FROM (SELECT CASE o_orderkey % 10 WHEN 0 THEN 'torn line' WHEN 1 THEN 'no date' END AS reason
    FROM orders) WHERE reason IS NOT NULL GROUP BY reason""")
def bronze_rejects(spark, sf_dir):
    """Bronze lines with blank, torn and dateless ones between: the merge takes the good, the others are told by reason."""
    bronze = scratch_path(spark, "bronze-lines")
    orders, rest = table(spark, sf_dir, "orders"), F.col("o_orderkey") % 10
    line = F.to_json(F.struct(
        F.concat(F.lit("O"), "o_orderkey").alias("symbol"), F.when(rest == 1, "n/a").otherwise(text(F.to_date("o_orderdate"))).alias("date"),
        timestamp_to_epoch("o_orderdate").alias("epoch"), F.col("o_totalprice").alias("close"), F.lit(1).alias("unknown_field")))
    lines = orders.select((F.col("o_orderkey") % 5).alias("symbol"), F.when(rest == 0, F.substring(line, 1, 25)).when(
        rest == 2, F.concat(line, F.lit("\n"))).otherwise(line).alias("value"))
    path = f"{bronze}/text"
    writers.write_lines(lines, path, "symbol", ".ndjson")
    bars = jobs.silver_bars(spark, path)
    counted = jobs.bronze_rejects(spark, path, catalog.BRONZE_BAR, "yahoo").groupBy("reason").agg(F.count("*").alias("lines"))
    # lines of one order and day are versions of a bar
    good = orders.where(~rest.isin(0, 1) & F.col("o_orderdate").isNotNull()).select("o_orderkey", F.to_date("o_orderdate")).distinct()
    if bars.count() != good.count():
        raise ValueError("accepted lines differ")
    return counted
