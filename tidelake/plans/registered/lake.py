"""Composed jobs from end to end: merges, conversions, gold outputs, catalog, registered tables, warehouse content."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelake.functions import timestamp_to_epoch
from tidelake.operators import aggregates
from tidelake.plans import adhoc, incremental, jobs, warehouse
from tidelake.plans.registered import feeds
from tidelake.plans.registered.loads import LATEST_BARS, REVISIONS, full_bars, klines_of_events, revisions
from tidelake.plans.registered.payloads import page_payloads, PAGE_OBSERVATIONS
from tidelake.plans.registered.registry import registered
from tidelake.plans.registered.views import sql
from tidelake.plans.standins import StandIns, table
from tidelake.session import scratch_path
from tidelake.sources import catalog, files, payloads, writers


def text(value):
    return (F.col(value) if isinstance(value, str) else value).cast("string")


# --- merges -----------------------------------------------------------------------

def bar_lines(trades):
    line = F.to_json(F.struct(
        F.concat(F.lit("S"), "l_suppkey").alias("symbol"), text(F.to_date("l_shipdate")).alias("date"),
        (timestamp_to_epoch("l_shipdate") * 1_000_000 + F.col("l_orderkey")).alias("epoch"), F.col("l_extendedprice").alias("close"),
        F.when(F.col("l_linenumber") > 3, F.col("l_extendedprice")).alias("adjClose"),
        F.when(F.col("l_linenumber") <= 3, F.col("l_extendedprice")).alias("adj_close"), F.col("l_quantity").cast("bigint").alias("volume")))
    return trades.select("*", F.concat(F.lit("S"), "l_suppkey").alias("symbol"), line.alias("value"))


def bronze_bars(spark, sf_dir, label):
    """Bronze lines of all trades, a directory per supplier; several trades of a day are versions of its bar."""
    path = scratch_path(spark, label)
    writers.write_lines(bar_lines(table(spark, sf_dir, "lineitem")).select("symbol", "value"), path, "symbol", ".ndjson")
    return path


BARS = """
    SELECT 'S' || l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS date, arg_max(l_extendedprice, k) AS close,
        arg_max(l_extendedprice, k) AS adj_close, CAST(year(CAST(l_shipdate AS DATE)) AS INT) AS year
    FROM (SELECT *, row(epoch(l_shipdate) * 1000000 + l_orderkey, l_extendedprice) AS k FROM lineitem)
    GROUP BY l_suppkey, CAST(l_shipdate AS DATE)"""


@registered("merged_market", BARS)
def merged_market(spark, sf_dir):
    """The market merge over bronze files; the second run finds nothing new."""
    bronze, root = bronze_bars(spark, sf_dir, "bronze-market"), scratch_path(spark, "lake-market")
    target, state = f"{root}/{catalog.TABLES['silver.market_ohlcv'].path}", f"{root}/silver/merge_state"
    if [jobs.merge_market(spark, bronze, target, state) for _ in range(2)] != [True, False]:
        raise ValueError("the merge must run once")
    return catalog.read_table(spark, root, "silver.market_ohlcv").select("symbol", "date", "close", "adj_close", "year")


@registered("merged_market_changes", BARS.replace("FROM lineitem)", "FROM lineitem WHERE l_suppkey % 10 <> 1 OR l_linenumber < 3)"))
def merged_market_changes(spark, sf_dir):
    """A merge by changed files: a tenth of the suppliers gets bars that were missing, another tenth loses some; no other unit is read again."""
    path, root = scratch_path(spark, "bronze-changes"), scratch_path(spark, "lake-changes")
    lines = bar_lines(table(spark, sf_dir, "lineitem"))

    def write(rows):
        writers.write_lines(rows.select("symbol", "value"), path, "symbol", ".ndjson")

    write(lines.where("l_suppkey % 10 <> 0 OR l_linenumber < 3"))
    target, state = incremental.target_table(spark, f"{root}/silver", incremental.MARKET), incremental.state_table(spark, f"{root}/state")
    incremental.run(spark, incremental.MARKET, path, target, state)
    write(lines.where("l_suppkey % 10 = 0 OR l_suppkey % 10 = 1 AND l_linenumber < 3"))
    outcome = incremental.run(spark, incremental.MARKET, path, target, state)
    if outcome.version is None or incremental.run(spark, incremental.MARKET, path, target, state).any:
        raise ValueError("the second merge finds changes, the third none")
    return target.read().select("symbol", "date", "close", "adj_close", "year")


@registered("bars_csv", BARS.replace("arg_max(l_extendedprice, k) AS adj_close, CAST(year(CAST(l_shipdate AS DATE)) AS INT) AS year",
                                     "CAST(1 AS BIGINT) AS files"))
def bars_csv(spark, sf_dir):
    """Bronze bars to the CSV form of silver and back."""
    path = scratch_path(spark, "bars-csv")
    jobs.bars_to_csv(spark, bronze_bars(spark, sf_dir, "bronze-csv"), path)
    return files.read_csv(spark, path, catalog.BAR).select("symbol", "date", "close", F.lit(1).cast("bigint").alias("files"))


def point_lines(points):
    return points.select(F.concat(F.lit("batch_"), F.col("batch") % 20).alias("indicator"), F.to_json(F.struct(
        *[c for c in points.columns if c != "batch"]), {"ignoreNullFields": "false"}).alias("value"))


def bronze_points(spark, sf_dir, label):
    path = scratch_path(spark, label)
    writers.write_lines(point_lines(payloads.observation_points(page_payloads(spark, sf_dir))), path, "indicator", ".ndjson")
    return path


NEWEST_OBSERVATIONS = f"""
    SELECT indicator_id, country_iso3, date, max(lastupdated) AS lastupdated, count(*) > 0 AS kept FROM ({PAGE_OBSERVATIONS}) GROUP BY ALL"""


@registered("merged_macro", NEWEST_OBSERVATIONS)
def merged_macro(spark, sf_dir):
    bronze, root = bronze_points(spark, sf_dir, "bronze-macro"), scratch_path(spark, "lake-macro")
    target, state = f"{root}/{catalog.TABLES['silver.macro_observations'].path}", f"{root}/silver/merge_state"
    if [jobs.merge_macro(spark, bronze, target, state) for _ in range(2)] != [True, False]:
        raise ValueError("the merge must run once")
    return catalog.read_table(spark, root, "silver.macro_observations").select(
        "indicator_id", "country_iso3", "date", "lastupdated", F.lit(True).alias("kept"))


@registered("merged_macro_changes", NEWEST_OBSERVATIONS)
def merged_macro_changes(spark, sf_dir):
    """Points of half the batches first, the others as new files: the newest observation of each key, as from all at once."""
    root = scratch_path(spark, "lake-macro-changes")
    points = payloads.observation_points(page_payloads(spark, sf_dir))
    path = f"{root}/bronze"
    target, state = incremental.target_table(spark, f"{root}/silver", incremental.MACRO), incremental.state_table(spark, f"{root}/state")
    for half in (1, 0):
        writers.write_lines(point_lines(points.where(F.col("batch") % 2 == half)), path, "indicator", ".ndjson")
        if not incremental.run(spark, incremental.MACRO, path, target, state).added:
            raise ValueError("each half has new files")
    return target.read().select("indicator_id", "country_iso3", "date", "lastupdated", F.lit(True).alias("kept"))


@registered("published_macro", NEWEST_OBSERVATIONS)
def published_macro(spark, sf_dir):
    """Bronze points to a published silver version, twice; readers see the newer one."""
    bronze, root = bronze_points(spark, sf_dir, "bronze-publish"), scratch_path(spark, "published-macro")
    jobs.publish_observations(spark, bronze, root)
    jobs.publish_observations(spark, bronze, root)
    return writers.read_published(spark, root).select("indicator_id", "country_iso3", "date", "lastupdated", F.lit(True).alias("kept"))


# --- conversions ---------------------------------------------------------------------

@registered("converted_csv", """
    SELECT source AS source_key, n_chars AS raw_len, text AS bronze_path FROM documents UNION ALL SELECT 'x', -1, 'later'""")
def converted_csv(spark, sf_dir):
    """CSV tables, one per language, to Parquet; after a change only the changed one runs again."""
    root, state = scratch_path(spark, "convert"), scratch_path(spark, "convert-state")
    documents = table(spark, sf_dir, "documents").withColumn("lang", F.coalesce("lang", F.lit("none")))
    names = sorted(r["lang"] for r in documents.select("lang").distinct().collect())
    tables = {lang: (f"{root}/csv/{lang}", catalog.INVENTORY, f"{root}/parquet/{lang}") for lang in names}
    for lang, (source, _, _) in tables.items():
        writers.write_csv(documents.where(F.col("lang") == lang).select("source", "n_chars", "text").toDF(
            "source_key", "raw_len", "bronze_path"), source)
    first = jobs.convert_csv(spark, tables, state)
    writers.write_csv(spark.createDataFrame([("x", -1, "later")], catalog.INVENTORY), tables[names[0]][0], "append")
    second = jobs.convert_csv(spark, tables, state)
    if (first, second) != (dict.fromkeys(names, True), dict.fromkeys(names, False) | {names[0]: True}):
        raise ValueError(f"ran {first}, then {second}")
    return aggregates.union_all([files.read_parquet(spark, target, catalog.INVENTORY) for _, _, target in tables.values()])


@registered("inventory_csv", """
    SELECT source AS source_key, CAST(count(DISTINCT text) AS BIGINT) AS files, CAST(sum(strlen(text)) AS BIGINT) AS raw_len
    FROM (SELECT DISTINCT source, text FROM documents) GROUP BY source""")
def inventory_csv(spark, sf_dir):
    bronze, path = scratch_path(spark, "bronze-inventory"), scratch_path(spark, "inventory-csv")
    writers.write_raw(table(spark, sf_dir, "documents").select("source", "text"), bronze, "source", "text")
    jobs.inventory_to_csv(spark, bronze, path)
    rows = files.read_csv(spark, path, catalog.INVENTORY)
    return rows.groupBy("source_key").agg(F.count("*").alias("files"), F.sum("raw_len").alias("raw_len"))


@registered("json_documents", "SELECT o_orderkey AS id, o_orderstatus AS side, o_totalprice AS price FROM orders")
def json_documents(spark, sf_dir):
    """Files that each hold one indented array of up to a hundred records, read through the registry."""
    root = scratch_path(spark, "json-documents")
    arrays = table(spark, sf_dir, "orders").groupBy(F.floor(F.col("o_orderkey") / 100).alias("k")).agg(F.to_json(F.collect_list(F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("side"), F.col("o_totalprice").alias("price"))),
        {"pretty": "true"}).alias("raw"))
    (arrays.select("raw").write.option("lineSep", "\n\n").option("maxRecordsPerFile", 1)
     .text(f"{root}/{catalog.TABLES['bronze.orders'].path}"))
    return catalog.read_table(spark, root, "bronze.orders").select(F.col("id").cast("bigint").alias("id"), "side", "price")


# --- gold, catalog, registry ------------------------------------------------------------

@registered("gold_outputs", sql(f"""
    SELECT 'yahoo_summary' AS output, 'S' || l_suppkey AS key, CAST(count(DISTINCT CAST(l_shipdate AS DATE)) AS VARCHAR) AS content
        FROM lineitem GROUP BY l_suppkey
    UNION ALL SELECT 'treasury_yield_curve', CAST(date AS VARCHAR), CAST(count(*) AS VARCHAR) FROM ({feeds.CURVE}) GROUP BY date
    UNION ALL SELECT 'fred_real_rates', 'P' || (o_orderkey // 100) || ' ' || CAST(o_orderdate AS DATE), 'true' FROM orders
        WHERE o_orderkey // 100 % 20 < 18 GROUP BY ALL
    UNION ALL SELECT 'sec_filings', CAST(o_orderkey AS VARCHAR), CAST(CAST(o_orderdate AS DATE) AS VARCHAR) FROM orders
        WHERE o_custkey % 20 < 18
    UNION ALL SELECT 'worldbank_yoy', country_iso3 || ' ' || date, 'true' FROM fact_macro_obs WHERE indicator_id = '2-HIGH'"""))
def gold_outputs(spark, sf_dir):
    """Raw files of four sources to silver and on to the gold exports, read back from their CSV."""
    root = scratch_path(spark, "gold")
    bronze = bronze_bars(spark, sf_dir, "bronze-gold")
    jobs.merge_market(spark, bronze, f"{root}/{catalog.TABLES['silver.market_ohlcv'].path}", f"{root}/silver/merge_state")
    rates, filings = feeds.feed_series(spark, sf_dir), feeds.feed_filings(spark, sf_dir)
    curve = StandIns(spark, sf_dir).yield_curve
    report = jobs.build_gold(spark, jobs.standard_outputs({
        "yahoo_summary": [lambda: spark.read.parquet(f"{root}/absent"), lambda: catalog.read_table(spark, root, "silver.market_ohlcv")
                          .withColumns({"high": F.col("close"), "low": F.col("close")})],
        "worldbank_yoy": [lambda: StandIns(spark, sf_dir).fact_macro_obs], "treasury_yield_curve": [lambda: curve],
        "fred_real_rates": [lambda: rates], "sec_filings": [lambda: filings]}, "2-HIGH"), f"{root}/gold")
    status = {r["output"]: r["status"] for r in report.collect()}
    if status != {**dict.fromkeys(status, "written"), "eia_oil_prices": "skipped"}:
        raise ValueError(str(report.collect()))

    def export(name, key, content):
        rows = spark.read.options(**files.CSV_DIALECT).option("header", True).csv(f"{root}/gold/{name}")
        return rows.select(F.lit(name).alias("output"), key.alias("key"), content(rows).cast("string").alias("content"))

    filled = lambda rows: sum((F.col(f"`{c}`").isNotNull().cast("int") for c in rows.columns[1:]), F.lit(0))
    return aggregates.union_all([
        export("yahoo_summary", F.col("symbol"), lambda _: F.col("bars")),
        export("treasury_yield_curve", F.col("Date"), filled),
        export("fred_real_rates", F.concat_ws(" ", "indicator_id", "date"), lambda _: F.col("value").isNotNull()),
        export("sec_filings", F.col("accession_number"), lambda _: F.col("filing_date")),
        export("worldbank_yoy", F.concat_ws(" ", "country_iso3", "date"), lambda _: F.col("value").isNotNull())])


@registered("exported_catalog", """
    SELECT 'dim' AS database, table_name AS name, column_name AS column, CASE WHEN data_type = 'BIGINT' THEN 'bigint'
        WHEN data_type = 'INTEGER' THEN 'int' WHEN data_type = 'DOUBLE' THEN 'double' WHEN data_type LIKE 'TIMESTAMP%' THEN 'timestamp'
        ELSE 'string' END AS type, (SELECT count(*) FROM supplier) AS suppliers
    FROM duckdb_columns() WHERE NOT internal AND table_name IN ('supplier', 'orders', 'events')""")
def exported_catalog(spark, sf_dir):
    path, names = scratch_path(spark, "catalog"), ("supplier", "orders", "events")
    tables = {n: table(spark, sf_dir, n) for n in names}
    jobs.export_catalog(spark, {"dim": tables}, "s3://lake", path)
    listed = spark.read.json(f"{path}/tables").select("database", "name", F.explode("columns").alias("c"))
    suppliers = tables["supplier"].agg(F.count("*").alias("suppliers"))
    return listed.select("database", "name", F.col("c.name").alias("column"), "c.type").crossJoin(suppliers)


@registered("registered_tables", """
    SELECT user_id AS symbol, count(*) AS ticks, (SELECT count(*) FROM documents) AS payloads FROM events GROUP BY user_id""")
def registered_tables(spark, sf_dir):
    """Tables at their registered places, found and queried by SQL; missing ones are no error."""
    root = scratch_path(spark, "registry")
    ticks = table(spark, sf_dir, "events").select(text("user_id").alias("symbol"), F.lit(1).cast("bigint").alias("ts"),
                                                  F.col("value").alias("price"), F.lit(1).cast("bigint").alias("volume"), F.col("event_type").alias("exchange"))
    writers.write_csv(ticks, f"{root}/{catalog.TABLES['bronze.market_ticks'].path}")
    writers.write_parquet(table(spark, sf_dir, "documents").select(F.col("source").alias("source_key"), F.col("n_chars").alias("raw_len"),
                                                                   F.lit("x").alias("bronze_path")), f"{root}/{catalog.TABLES['silver.gmd'].path}")
    if sorted(catalog.register_existing(spark, root)) != ["bronze.market_ticks", "silver.gmd"]:
        raise ValueError("two tables are there")
    return adhoc.query(spark, """SELECT CAST(symbol AS bigint) AS symbol, count(*) AS ticks, (SELECT count(*) FROM silver_gmd) AS payloads
        FROM bronze_market_ticks GROUP BY symbol""")


# --- warehouse content ------------------------------------------------------------------

@registered("loaded_star_content", sql("""
    SELECT 'fact_market_ohlcv' AS fact, symbol AS key, CAST(date AS VARCHAR) AS at, CAST(close AS DOUBLE) AS number FROM ({latest})
    UNION ALL SELECT 'fact_macro_obs', indicator_id || ' ' || country, date, value FROM (
        SELECT indicator_id, coalesce(nullif(country_iso3, ''), 'UNK') AS country, date, arg_max(value, lastupdated) AS value
        FROM ({revisions}) GROUP BY ALL)
    UNION ALL SELECT 'fact_crypto_ohlcv', 'U' || user_id, CAST(CAST(ts AS DATE) AS VARCHAR), arg_max(value, row(ts, event_id))
        FROM events GROUP BY user_id, CAST(ts AS DATE)
    UNION ALL SELECT 'fact_rates_daily', indicator_id, CAST(date AS VARCHAR), value FROM fact_rates_daily
    UNION ALL SELECT 'fact_filings', 'Supplier#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0'), CAST(CAST(o_orderdate AS DATE) AS VARCHAR),
        CAST(o_orderkey AS DOUBLE) FROM orders WHERE 'Supplier#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') IN (
            SELECT s_name FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem) UNION SELECT symbol FROM equity_master)
    UNION ALL SELECT 'dim_instrument', symbol, kind, 1 FROM (
        SELECT s_name AS symbol, 'yahoo' AS kind FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)
        UNION SELECT DISTINCT 'U' || user_id, 'binance' FROM events
        UNION SELECT symbol, 'nse-equity-master' FROM equity_master WHERE symbol NOT IN (
            SELECT s_name FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)))""".format(latest=LATEST_BARS, revisions=REVISIONS)))
def loaded_star_content(spark, sf_dir):
    """Instruments and all five facts of the whole load, by their natural keys."""
    tables = StandIns(spark, sf_dir)
    observations = revisions(spark, sf_dir).withColumns({
        "indicator_name": F.lower("indicator_id"), "unit": F.lit("USD"), "source_id": F.lit("2")})
    star = warehouse.load_star(spark, warehouse.Silver(
        full_bars(spark, sf_dir), observations, tables.equity_master, klines_of_events(tables).withColumn("symbol", F.concat(F.lit("U"), "symbol")),
        tables.fact_rates_daily.drop("source_id"), tables.filings))
    instruments = star["dim_instrument"].where("instrument_id <> -1").select("instrument_id", "symbol", "_source")

    def keyed(name, key, at, number):
        fact = star[name]
        rows = fact.join(instruments, "instrument_id") if "instrument_id" in fact.columns else fact
        return rows.select(F.lit(name).alias("fact"), key.alias("key"), at.cast("string").alias("at"), number.cast("double").alias("number"))

    return aggregates.union_all([
        keyed("fact_market_ohlcv", F.col("symbol"), F.col("date"), F.col("close")),
        keyed("fact_macro_obs", F.concat_ws(" ", "indicator_id", "country_iso3"), F.col("date"), F.col("value")),
        keyed("fact_crypto_ohlcv", F.col("symbol"), F.col("date"), F.col("close")),
        keyed("fact_rates_daily", F.col("indicator_id"), F.col("date"), F.col("value")),
        keyed("fact_filings", F.col("symbol"), F.col("filing_date"), F.col("accession_number")),
        instruments.select(F.lit("dim_instrument").alias("fact"), F.col("symbol").alias("key"), F.col("_source").alias("at"),
                           F.lit(1.0).alias("number"))])
