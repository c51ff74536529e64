"""Filters, de-duplication, aggregates, keys, history and contracts on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelake import functions as fn
from tidelake.operators import aggregates, dedup, history, joins, keys, quality, reconcile, series
from tidelake.plans.registered.registry import registered, rounded
from tidelake.plans.registered.views import sql
from tidelake.session import scratch_path
from tidelake.sources.versioned import VersionedTable
from tidelake.plans.standins import TABLE_COLUMNS, TABLE_NAMES, StandIns
from tidelake.sources.writers import with_fixed_prices

NEWEST_LINE = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
LATEST_LINES = """
    SELECT * EXCLUDE rn FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity,
        CAST(l_shipdate AS DATE) AS l_shipdate, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
        l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) AS rn
    FROM lineitem) WHERE rn = 1"""


# --- keep the newest version ---------------------------------------------------

@registered("keep_latest_lines", LATEST_LINES)
def keep_latest_lines(spark, sf_dir):
    lines = StandIns(spark, sf_dir).read("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        F.to_date("l_shipdate").alias("l_shipdate"))
    return dedup.keep_latest(lines, ["l_orderkey", "l_linenumber"], [F.col(c).desc_nulls_last() for c in NEWEST_LINE])


SILVER_BARS = """
    SELECT s_name AS symbol, CAST(l_shipdate AS DATE) AS date, l_orderkey * 10 + l_linenumber AS epoch,
        l_extendedprice AS close, CAST(l_quantity AS BIGINT) AS volume, l_partkey AS part
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey"""


def silver_bars(spark, sf_dir):
    """Every line as a bar version of its supplier and day, newest by order and line."""
    tables = StandIns(spark, sf_dir)
    symbols = tables.read("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("symbol"))
    rows = tables.read("lineitem").select(
        "l_suppkey", F.to_date("l_shipdate").alias("date"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("epoch"), F.col("l_extendedprice").alias("close"),
        F.col("l_quantity").cast("bigint").alias("volume"), F.col("l_partkey").alias("part"))
    return joins.lookup(rows, symbols, "l_suppkey").drop("l_suppkey")


@registered("keep_latest_bars", f"""
    SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY epoch DESC, close DESC,
        volume DESC, part DESC) AS rn FROM ({SILVER_BARS})) WHERE rn = 1""")
def keep_latest_bars(spark, sf_dir):
    return dedup.latest_bars(silver_bars(spark, sf_dir))


@registered("keep_latest_ingested", """
    SELECT * EXCLUDE rn FROM (SELECT user_id, event_type, CAST(ts AS VARCHAR) AS _ingest_ts, event_id, value, row_number()
        OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def keep_latest_ingested(spark, sf_dir):
    rows = StandIns(spark, sf_dir).read("events").select(
        "user_id", "event_type", F.col("ts").cast("string").alias("_ingest_ts"), "event_id", "value")
    return dedup.latest_ingested(rows, ["user_id", "event_type"])


def revisions(spark, sf_dir):
    """Orders as revisions of observations; some lack the ISO code, as aggregates do."""
    return StandIns(spark, sf_dir).read("orders").select(
        F.col("o_orderpriority").alias("indicator_id"),
        F.when(F.col("o_custkey") % 3 == 0, "").otherwise(F.concat(F.lit("C"), F.col("o_custkey") % 40)).alias("country_iso3"),
        F.concat(F.lit("K"), F.col("o_custkey") % 7).alias("country_id"),
        F.concat(F.lit("Country "), F.col("o_custkey") % 7).alias("country_name"),
        F.year("o_orderdate").cast("string").alias("date"), F.col("o_totalprice").alias("value"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit("Z")).alias("lastupdated"),
        F.lit("Y").alias("period_type"), F.col("o_orderstatus").alias("source_id"))


REVISIONS = """
    SELECT o_orderpriority AS indicator_id, CASE WHEN o_custkey % 3 = 0 THEN '' ELSE 'C' || (o_custkey % 40) END
        AS country_iso3, 'K' || (o_custkey % 7) AS country_id, 'Country ' || (o_custkey % 7) AS country_name,
        CAST(year(o_orderdate) AS VARCHAR) AS date, o_totalprice AS value,
        CAST(o_orderkey AS VARCHAR) || 'Z' AS lastupdated, 'Y' AS period_type, o_orderstatus AS source_id FROM orders"""


def latest_revision(keys: str, columns: str = "*") -> str:
    return f"""SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {keys}
        ORDER BY lastupdated DESC) AS rn FROM ({REVISIONS})) WHERE rn = 1"""


@registered("keep_latest_observations", latest_revision("indicator_id, country_iso3, date", "* EXCLUDE rn"))
def keep_latest_observations(spark, sf_dir):
    return dedup.latest_observations(revisions(spark, sf_dir))


@registered("keep_latest_with_aggregates", latest_revision(
    "indicator_id, coalesce(nullif(country_iso3, ''), country_id), date", "* EXCLUDE rn"))
def keep_latest_with_aggregates(spark, sf_dir):
    return dedup.latest_observations(revisions(spark, sf_dir), distinguish_aggregates=True)


@registered("keep_last_document", """
    SELECT doc_id, source, lang, text, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source, lang
        ORDER BY doc_id DESC) AS rn FROM documents) WHERE rn = 1""")
def keep_last_document(spark, sf_dir):
    documents = StandIns(spark, sf_dir).read("documents")
    return dedup.keep_latest(documents, ["source", "lang"], [F.col("doc_id").desc()], payload_tie_break=False)


@registered("json_keep_latest", """
    SELECT user_id, event_type, k, event_id FROM (SELECT user_id, event_type, event_id,
        CAST(json_extract_string(props, '$.k') AS INT) AS k, row_number() OVER (PARTITION BY user_id, event_type,
        CAST(json_extract_string(props, '$.k') AS INT) ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""")
def json_keep_latest(spark, sf_dir):
    rows = StandIns(spark, sf_dir).read("events").select(
        "user_id", "event_type", F.from_json("props", "k int")["k"].alias("k"), "event_id")
    return dedup.keep_latest(rows, ["user_id", "event_type", "k"], [F.col("event_id").desc()])


# --- projections and scalar functions ------------------------------------------

@registered("ratio_columns", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount,
        l_extendedprice / nullif(l_discount, 0) AS ratio,
        (l_extendedprice - l_quantity) / nullif(l_discount, 0) AS difference,
        round((l_extendedprice - l_discount) * l_quantity, 2) AS pnl
    FROM lineitem WHERE l_suppkey > 0 AND l_returnflag = 'A' AND l_discount IS NOT NULL AND l_linestatus <> ''""")
def ratio_columns(spark, sf_dir):
    lines = StandIns(spark, sf_dir).read("lineitem").where(
        "l_suppkey > 0 AND l_returnflag = 'A' AND l_discount IS NOT NULL AND l_linestatus <> ''")
    base = F.nullif(F.col("l_discount"), F.lit(0.0))
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount",
        (F.col("l_extendedprice") / base).alias("ratio"),
        ((F.col("l_extendedprice") - F.col("l_quantity")) / base).alias("difference"),
        fn.profit("l_extendedprice", "l_discount", "l_quantity").alias("pnl"))


@registered("growth_columns", """
    SELECT o_orderkey, o_totalprice / nullif(o_custkey, 0) - 1 AS growth,
        (o_totalprice - o_custkey) / nullif(o_custkey, 0) AS difference,
        round(CASE WHEN 1 + (o_custkey - 200) / 100.0 > 0 THEN ln(1 + (o_custkey - 200) / 100.0) END, 9) AS log_growth
    FROM orders""")
def growth_columns(spark, sf_dir):
    orders = StandIns(spark, sf_dir).read("orders").withColumn("base", F.col("o_custkey").cast("double"))
    rate = (F.col("base") - 200) / 100.0
    return orders.select(
        "o_orderkey", fn.change("o_totalprice", "base").alias("growth"),
        fn.relative_difference("o_totalprice", "base").alias("difference"),
        F.round(fn.log_growth(rate), 9).alias("log_growth"))


@registered("symbol_classes", """
    WITH s AS (SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN '^' || s_name ELSE s_name END AS symbol FROM supplier),
    c AS (SELECT *, CASE WHEN symbol LIKE '^%' THEN 'INDEX' ELSE 'EQUITY' END AS asset_class FROM s)
    SELECT s_suppkey, symbol, asset_class,
        CASE asset_class WHEN 'EQUITY' THEN 1 WHEN 'INDEX' THEN 2 WHEN 'CRYPTO' THEN 3 ELSE -1 END AS asset_class_id,
        regexp_replace(symbol, '[^a-zA-Z0-9._=-]', '_', 'g') AS directory
    FROM c""")
def symbol_classes(spark, sf_dir):
    symbol = F.when(F.col("s_suppkey") % 5 == 0, F.concat(F.lit("^"), F.col("s_name"))).otherwise(F.col("s_name"))
    rows = StandIns(spark, sf_dir).read("supplier").select("s_suppkey", symbol.alias("symbol"))
    return (rows.withColumn("asset_class", fn.symbol_class("symbol"))
            .withColumn("asset_class_id", fn.code_id("asset_class", fn.ASSET_CLASS_IDS))
            .withColumn("directory", fn.safe_key("symbol")))


PERIODS = """
    SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN CAST(year(o_orderdate) AS VARCHAR)
        WHEN 1 THEN year(o_orderdate) || 'M0' || (o_orderkey % 9 + 1) WHEN 2 THEN year(o_orderdate) || 'Q' || (o_orderkey % 4 + 1)
        WHEN 3 THEN year(o_orderdate) || 'M' ELSE '' END AS date FROM orders"""


@registered("period_types", f"""
    SELECT o_orderkey, date, CASE WHEN date LIKE '%M' THEN 'M' WHEN date LIKE '%Q' THEN 'Q' ELSE 'Y' END AS period_type,
        CASE WHEN regexp_matches(date, '^\\d{{4}}M\\d{{1,2}}$') THEN 'M' WHEN regexp_matches(date, '^\\d{{4}}Q\\d$')
            THEN 'Q' ELSE 'Y' END AS corrected,
        regexp_extract(date, '\\d+', 0) AS year, coalesce(nullif(date, ''), 'UNK') AS or_unknown FROM ({PERIODS})""")
def period_types(spark, sf_dir):
    rows = StandIns(spark, sf_dir).read("orders").selectExpr(
        "o_orderkey", "CASE o_orderkey % 5 WHEN 0 THEN CAST(year(o_orderdate) AS string) "
        "WHEN 1 THEN concat(year(o_orderdate), 'M0', o_orderkey % 9 + 1) "
        "WHEN 2 THEN concat(year(o_orderdate), 'Q', o_orderkey % 4 + 1) "
        "WHEN 3 THEN concat(year(o_orderdate), 'M') ELSE '' END AS date")
    return rows.select("o_orderkey", "date", fn.period_type("date").alias("period_type"),
                       fn.period_type("date", corrected=True).alias("corrected"),
                       fn.leading_number("date").alias("year"), fn.or_unknown("date").alias("or_unknown"))


@registered("currency_ids", """
    SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 ELSE -1 END AS currency_id,
        upper(substring(c_mktsegment, 1, 3)) AS code, split_part(c_name, '#', 2) AS number FROM customer""")
def currency_ids(spark, sf_dir):
    return StandIns(spark, sf_dir).read("customer").select(
        "c_custkey", fn.code_id("c_mktsegment", {"BUILDING": 1, "MACHINERY": 2}).alias("currency_id"),
        F.upper(F.substring("c_mktsegment", 1, 3)).alias("code"), F.split("c_name", "#")[1].alias("number"))


@registered("fixed_point_prices", """
    SELECT o_orderkey, round(o_totalprice / 7, 4) AS close, printf('%.4f', round(o_totalprice / 7, 4)) AS close_text
    FROM orders""")
def fixed_point_prices(spark, sf_dir):
    rows = StandIns(spark, sf_dir).read("orders").select("o_orderkey", (F.col("o_totalprice") / 7).alias("close"))
    return with_fixed_prices(rows).withColumn("close_text", fn.fixed_point_text("close"))


@registered("exchange_dates", """
    SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch,
        CAST(timezone('America/New_York', to_timestamp(floor(epoch(ts)))) AS DATE) AS date,
        CAST(year(timezone('America/New_York', to_timestamp(floor(epoch(ts))))) AS INT) AS year FROM events""")
def exchange_dates(spark, sf_dir):
    rows = StandIns(spark, sf_dir).read("events").select("event_id", fn.timestamp_to_epoch("ts").alias("epoch"))
    return rows.withColumn("date", fn.exchange_date("epoch")).withColumn("year", F.year("date"))


@registered("json_fields", """
    SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.missing') AS missing FROM events""")
def json_fields(spark, sf_dir):
    return StandIns(spark, sf_dir).read("events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"), F.get_json_object("props", "$.missing").alias("missing"))


@registered("new_keys_only", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def new_keys_only(spark, sf_dir):
    tables = StandIns(spark, sf_dir)
    buyers = tables.read("orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.unmatched(tables.read("customer").select("c_custkey", "c_name"), buyers, "c_custkey")


@registered("guarded_export", "SELECT s_suppkey, s_name FROM supplier ORDER BY s_name")
def guarded_export(spark, sf_dir):
    """The first of two candidate inputs that has the wanted column."""
    tables = StandIns(spark, sf_dir)
    [usable] = [t for t in (tables.read("nation"), tables.read("supplier")) if quality.has_columns(t, "s_name")]
    return usable.select("s_suppkey", "s_name").orderBy("s_name")


# --- aggregates -------------------------------------------------------------------

@registered("table_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLE_NAMES))
def table_counts(spark, sf_dir):
    tables = StandIns(spark, sf_dir)
    return aggregates.union_all([aggregates.row_count(t, tables.read(t)) for t in TABLE_NAMES])


@registered("distinct_sources", "SELECT lang, count(DISTINCT source) AS sources FROM documents GROUP BY lang")
def distinct_sources(spark, sf_dir):
    return StandIns(spark, sf_dir).read("documents").groupBy("lang").agg(F.countDistinct("source").alias("sources"))


@registered("ticks_per_symbol", "SELECT user_id AS symbol, count(*) AS ticks FROM events GROUP BY user_id ORDER BY user_id")
def ticks_per_symbol(spark, sf_dir):
    return (StandIns(spark, sf_dir).read("events").groupBy(F.col("user_id").alias("symbol"))
            .agg(F.count(F.lit(1)).alias("ticks")).orderBy("symbol"))


@registered("average_tick_price", """
    SELECT event_type AS symbol, CAST(sum(CAST(value AS DECIMAL(28,6))) AS DOUBLE) / count(value) AS avg_price
    FROM events GROUP BY event_type""")
def average_tick_price(spark, sf_dir):
    return (StandIns(spark, sf_dir).read("events").groupBy(F.col("event_type").alias("symbol"))
            .agg(aggregates.exact_mean("value").alias("avg_price")))


@registered("highest_key", "SELECT coalesce(max(s_suppkey), 0) AS base FROM supplier")
def highest_key(spark, sf_dir):
    return keys.highest_key(StandIns(spark, sf_dir).read("supplier"), "s_suppkey")


@registered("distinct_seeds", "SELECT DISTINCT o_orderpriority, o_orderstatus, CAST(year(o_orderdate) AS INT) AS year FROM orders")
def distinct_seeds(spark, sf_dir):
    return StandIns(spark, sf_dir).read("orders").select(
        "o_orderpriority", "o_orderstatus", F.year("o_orderdate").alias("year")).distinct()


LAST_PRICES = """
    SELECT l_suppkey AS symbol, arg_max(l_extendedprice, row(l_orderkey, l_linenumber, l_extendedprice)) AS market_price
    FROM lineitem GROUP BY 1"""
# returned lines are sales
POSITIONS = f"""
    SELECT symbol, qty, avg_price, market_price, coalesce(round((market_price - avg_price) * CAST(qty AS DOUBLE), 2), 0) AS pnl
    FROM (SELECT symbol, CAST(bought - sold AS BIGINT) AS qty, CASE WHEN bought > sold THEN CAST(paid AS DOUBLE) / CAST(bought AS DOUBLE)
            WHEN sold > bought THEN CAST(received AS DOUBLE) / CAST(sold AS DOUBLE) END AS avg_price FROM (
        SELECT l_suppkey AS symbol, coalesce(sum(n) FILTER (l_returnflag <> 'R'), 0) AS bought,
            coalesce(sum(n) FILTER (l_returnflag = 'R'), 0) AS sold, sum(n * p) FILTER (l_returnflag <> 'R') AS paid,
            sum(n * p) FILTER (l_returnflag = 'R') AS received
        FROM (SELECT *, CAST(l_quantity AS DECIMAL(10,0)) AS n, CAST(l_extendedprice AS DECIMAL(18,2)) AS p FROM lineitem) GROUP BY 1))
    JOIN ({LAST_PRICES}) USING (symbol)"""


def position_rows(spark, sf_dir):
    trades = StandIns(spark, sf_dir).trades.withColumnRenamed("instrument_id", "symbol")
    fills = StandIns(spark, sf_dir).read("lineitem").select(
        F.col("l_suppkey").alias("symbol"), F.when(F.col("l_returnflag") == "R", "SELL").otherwise("BUY").alias("side"),
        F.col("l_quantity").cast("bigint").alias("quantity"), F.col("l_extendedprice").alias("price"))
    last = trades.groupBy("symbol").agg(F.max_by("price", "sequence").alias("market_price"))
    return aggregates.positions(fills, last)


@registered("positions", POSITIONS)
def positions(spark, sf_dir):
    return position_rows(spark, sf_dir)


@registered("portfolio_total", f"SELECT round(sum(pnl), 2) AS total_pnl FROM ({POSITIONS})")
def portfolio_total(spark, sf_dir):
    return rounded(aggregates.portfolio_total(position_rows(spark, sf_dir)), total_pnl=2)


@registered("money_totals", """
    WITH half AS (SELECT c_mktsegment, CAST(round(c_acctbal * 100) AS BIGINT) AS cents,
        CAST(floor(CAST(round(c_acctbal * 100) AS BIGINT) / 2.0) AS BIGINT) AS low
        FROM customer WHERE c_acctbal IS NOT NULL AND length(trim(c_mktsegment)) > 0)
    SELECT upper(c_mktsegment) AS currency, count(*) AS entries, CAST(sum(CASE WHEN cents <> 2 * low AND low % 2 <> 0
        THEN low + 1 ELSE low END) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(38,2)) AS total FROM half GROUP BY 1""")
def money_totals(spark, sf_dir):
    rows = StandIns(spark, sf_dir).read("customer").select(
        (F.col("c_acctbal").cast("decimal(18,2)") / 2).alias("amount"), F.lower("c_mktsegment").alias("currency"))
    return aggregates.money_totals(rows)


@registered("source_summary", """
    WITH runs AS (SELECT source, arg_max(n_chars, doc_id) AS bronze_keys FROM documents GROUP BY source),
    silver AS (SELECT source, count(*) AS silver_rows FROM labels JOIN documents USING (doc_id) WHERE lang = 'de' GROUP BY source)
    SELECT s.source, coalesce(bronze_keys, 0) AS bronze_keys, coalesce(silver_rows, 0) AS silver_rows
    FROM (SELECT DISTINCT source FROM documents UNION SELECT n_name FROM nation) s
    LEFT JOIN runs ON runs.source = s.source LEFT JOIN silver ON silver.source = s.source""")
def source_summary(spark, sf_dir):
    tables = StandIns(spark, sf_dir)
    documents = tables.read("documents").select("doc_id", "source", "lang", "n_chars")
    sources = documents.select("source").union(tables.read("nation").select("n_name")).distinct()
    runs = documents.select("source", F.col("doc_id").alias("last_run"), F.col("n_chars").alias("keys"))
    silver = documents.where("lang = 'de'").join(tables.read("labels").select("doc_id"), "doc_id")
    return aggregates.source_summary(sources, runs, silver)


FILLED_ROWS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{column}' AS column_name, count({column}) AS filled_rows FROM {name}"
    for name, columns in TABLE_COLUMNS.items() for column in columns.split())


@registered("schema_summary", f"""
    SELECT table_name, CAST(row_number() OVER (PARTITION BY table_name ORDER BY column_index) AS INT) AS position,
        column_name, CASE WHEN data_type = 'BIGINT' THEN 'bigint' WHEN data_type = 'INTEGER' THEN 'int'
        WHEN data_type = 'DOUBLE' THEN 'double' WHEN data_type LIKE 'TIMESTAMP%' THEN 'timestamp' ELSE 'string' END AS type,
        filled_rows
    FROM duckdb_columns() JOIN ({FILLED_ROWS}) USING (table_name, column_name) WHERE NOT internal""")
def schema_summary(spark, sf_dir):
    tables = StandIns(spark, sf_dir)
    return aggregates.schema_summary({t: tables.read(t) for t in TABLE_NAMES})


# --- series on raw tables --------------------------------------------------------

@registered("indicator_yoy", """
    WITH months AS (SELECT l_returnflag AS indicator_id, 'S' || l_suppkey AS country_iso3, strftime(l_shipdate, '%Y-%m') AS date,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM lineitem GROUP BY ALL)
    SELECT indicator_id, country_iso3, date, value, prev, (value - prev) / nullif(prev, 0) AS yoy FROM (
        SELECT *, lag(value) OVER (PARTITION BY country_iso3 ORDER BY date) AS prev FROM months WHERE indicator_id = 'N')""")
def indicator_yoy(spark, sf_dir):
    """The whole report: monthly trade per supplier, thousands of rows."""
    months = StandIns(spark, sf_dir).read("lineitem").groupBy(
        F.col("l_returnflag").alias("indicator_id"), F.concat(F.lit("S"), "l_suppkey").alias("country_iso3"),
        F.date_format("l_shipdate", "yyyy-MM").alias("date")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("value"))
    return series.indicator_yoy(months, "N")


@registered("tick_bars", sql("SELECT * FROM tick_bars"))
def tick_bars(spark, sf_dir):
    return StandIns(spark, sf_dir).tick_bars


@registered("ordered_rates", sql("SELECT * FROM fact_rates_daily ORDER BY date, indicator_id"))
def ordered_rates(spark, sf_dir):
    return StandIns(spark, sf_dir).fact_rates_daily.orderBy("date", "indicator_id")


@registered("first_five", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def first_five(spark, sf_dir):
    return (StandIns(spark, sf_dir).read("orders").select("o_orderkey", "o_totalprice")
            .orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(5))


# --- history and contracts --------------------------------------------------------

HISTORY = """
    WITH daily AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, arg_max(o_orderpriority, row(o_orderdate, o_orderkey))
            AS priority FROM orders GROUP BY 1, 2),
    marked AS (SELECT *, lag(priority) OVER (PARTITION BY o_custkey ORDER BY day) AS before FROM daily),
    changed AS (SELECT * FROM marked WHERE before IS DISTINCT FROM priority)
    SELECT o_custkey, priority, day AS valid_from,
        coalesce(CAST(lead(day) OVER w - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS valid_to,
        lead(day) OVER w IS NULL AS is_current FROM changed WINDOW w AS (PARTITION BY o_custkey ORDER BY day)"""


@registered("instrument_history", HISTORY)
def instrument_history(spark, sf_dir):
    changes = StandIns(spark, sf_dir).read("orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderdate", "o_orderkey",
        F.col("o_orderpriority").alias("priority"))
    return history.versions(changes, "o_custkey", "day", ["priority"],
                            [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


@registered("changed_history", HISTORY)
def changed_history(spark, sf_dir):
    """The same history stored and brought up to date by three batches, the newest first, with corrections of days between."""
    changes = StandIns(spark, sf_dir).read("orders").select("o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderdate", "o_orderkey",
                                                            F.col("o_orderpriority").alias("priority"))
    table = VersionedTable(spark, scratch_path(spark, "history"), [], ["o_custkey", "valid_from"])
    since = F.col("o_orderdate") >= "1997-01-01"
    for batch in (changes.where(since & (F.col("o_orderkey") % 3 > 0)), changes.where(~since), changes.where(since & (F.col("o_orderkey") % 3 == 0))):
        history.apply_changes(table, batch, "o_custkey", "day", ["priority"], ["o_orderdate", "o_orderkey"])
    return history.current_history(table)


@registered("duplicate_keys", """
    SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(StandIns(spark, sf_dir).read("lineitem"), ["l_orderkey", "l_linenumber"])


@registered("orphan_keys", """
    SELECT user_id AS instrument_id, count(*) AS row_count FROM events
    WHERE user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 1""")
def orphan_keys(spark, sf_dir):
    tables = StandIns(spark, sf_dir)
    facts = tables.read("events").select(F.col("user_id").alias("instrument_id"))
    return quality.orphan_keys(facts, tables.read("supplier").select(F.col("s_suppkey").alias("instrument_id")),
                               "instrument_id")


@registered("null_keys", """
    SELECT 'l_orderkey' AS column_name, count(*) FILTER (l_orderkey IS NULL) AS null_rows FROM lineitem
    UNION ALL SELECT 'l_shipdate', count(*) FILTER (l_shipdate IS NULL) FROM lineitem""")
def null_keys(spark, sf_dir):
    return quality.null_keys(StandIns(spark, sf_dir).read("lineitem"), ["l_orderkey", "l_shipdate"])


@registered("located_differences", """
    WITH copy AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 500 = 7 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity
        FROM lineitem WHERE l_orderkey % 500 <> 8 UNION ALL SELECT -1, 1, 1)
    SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, CASE WHEN b.n IS NULL THEN 'missing' WHEN a.n IS NULL THEN 'extra' ELSE 'changed' END AS status,
        coalesce(a.n, 0) AS left_rows, coalesce(b.n, 0) AS right_rows
    FROM (SELECT l_orderkey, count(*) AS n, list(row(l_linenumber, l_quantity) ORDER BY row(l_linenumber, l_quantity)) AS x FROM lineitem GROUP BY 1) a
    FULL JOIN (SELECT l_orderkey, count(*) AS n, list(row(l_linenumber, l_quantity) ORDER BY row(l_linenumber, l_quantity)) AS x FROM copy GROUP BY 1) b
        ON a.l_orderkey = b.l_orderkey WHERE a.x IS DISTINCT FROM b.x""")
def located_differences(spark, sf_dir):
    """Line items against a copy with changed, dropped and added ones: the orders that differ."""
    lines = StandIns(spark, sf_dir).read("lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("l_quantity"))
    changed = lines.where("l_orderkey % 500 <> 8").withColumn("l_quantity", F.when(
        F.col("l_orderkey") % 500 == 7, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    extra = lines.sparkSession.range(1).select(F.lit(-1).cast("bigint").alias("l_orderkey"), F.lit(1).cast(lines.schema["l_linenumber"].dataType).alias(
        "l_linenumber"), F.lit(1.0).alias("l_quantity"))
    return reconcile.differences(lines, changed.unionByName(extra), ["l_orderkey"])
