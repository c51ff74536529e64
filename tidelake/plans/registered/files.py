"""Write-and-read round trips of whole test tables through the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelake.operators import dedup, quality, segments
from tidelake.plans.registered.registry import registered
from tidelake.plans.registered.views import sql
from tidelake.plans.standins import StandIns, table
from tidelake.session import scratch_path
from tidelake.sources import files, payload_source, writers
from tidelake.sources.versioned import VersionedTable

ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, day date, o_orderpriority string"
ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS day, o_orderpriority
    FROM orders"""


def orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                                 F.to_date("o_orderdate").alias("day"), "o_orderpriority")


@registered("csv_copy", ORDERS_SQL + " WHERE o_totalprice > 1000")
def csv_copy(spark, sf_dir):
    path = scratch_path(spark, "csv")
    writers.write_csv(orders(spark, sf_dir), path)
    return files.read_csv(spark, path, ORDERS, where="o_totalprice > 1000")


TEXTS = """
    SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN text WHEN 1 THEN '"' || text || '", ""x""' WHEN 2 THEN '' WHEN 3 THEN NULL
        ELSE ' ' || chr(10) || text || ',' || chr(13) || chr(10) || ' ' END AS text, lang FROM documents"""


@registered("csv_texts", TEXTS)
def csv_texts(spark, sf_dir):
    """Texts with quotes, line ends, blanks, empty texts and NULLs, written and read back."""
    path, text, rest = scratch_path(spark, "texts"), F.col("text"), F.col("doc_id") % 5
    rows = table(spark, sf_dir, "documents").select("doc_id", F.when(rest == 0, text).when(
        rest == 1, F.concat(F.lit('"'), text, F.lit('", ""x""'))).when(rest == 2, "").when(
        rest == 4, F.concat(F.lit(" \n"), text, F.lit(",\r\n "))).alias("text"), "lang")
    writers.write_csv(rows, path)
    return files.read_csv(spark, path, "doc_id bigint, text string, lang string")


@registered("parquet_copy", ORDERS_SQL + " WHERE o_orderstatus = 'F'")
def parquet_copy(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    writers.write_parquet(orders(spark, sf_dir), path)
    return files.read_parquet(spark, path, where="o_orderstatus = 'F'")


EVENT = "event_id bigint, user_id bigint, value double, props string"


@registered("json_by_key", "SELECT event_type AS source_key, event_id, user_id, value, props FROM events")
def json_by_key(spark, sf_dir):
    """Line-delimited JSON per key; the key comes back from the directory name."""
    path = scratch_path(spark, "ndjson")
    events = table(spark, sf_dir, "events").select("event_type", "event_id", "user_id", "value", "props")
    writers.write_json_by_key(events.withColumnRenamed("event_type", "symbol"), path, "symbol")
    rows = files.read_json_lines(spark, path, EVENT, name_glob="*.json")
    return rows.select(files.directory_key(name="symbol").alias("source_key"), "event_id", "user_id", "value", "props")


@registered("json_array_lines", """
    SELECT o_orderkey AS id, o_orderstatus AS side, o_totalprice AS price FROM orders
    UNION ALL SELECT o_orderkey, 'copy', NULL FROM orders""")
def json_array_lines(spark, sf_dir):
    """Arrays of records, one array per line; fields outside the schema are ignored."""
    path = scratch_path(spark, "arrays")
    record = F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("side"),
                      F.col("o_totalprice").alias("price"), F.lit("x").alias("unknown"))
    copy = F.struct(F.col("o_orderkey").alias("id"), F.lit("copy").alias("side"),
                    F.lit(None).cast("double").alias("price"), F.lit("y").alias("unknown"))
    table(spark, sf_dir, "orders").select(F.to_json(F.array(record, copy)).alias("value")).write.text(path)
    return files.read_json_lines(spark, path, "id bigint, side string, price double")


@registered("audited_bars", sql("""
    SELECT symbol, date, close, 'lines' AS _source, 'batch-1' AS _batch_id, volume > 20 AS _is_valid, true AS stamped
    FROM bars"""))
def audited_bars(spark, sf_dir):
    rows = StandIns(spark, sf_dir).silver_bars.select("symbol", F.col("date").cast("date").alias("date"), "close", "volume")
    audited = writers.with_audit(rows, "lines", "batch-1", F.col("volume") > 20)
    return audited.select("symbol", "date", "close", "_source", "_batch_id", "_is_valid",
                          F.col("_ingest_ts").isNotNull().alias("stamped"))


@registered("raw_inventory", """
    SELECT source AS source_key, count(DISTINCT text) AS files, CAST(sum(strlen(text)) AS BIGINT) AS raw_len
    FROM (SELECT DISTINCT source, text FROM documents) GROUP BY source""")
def raw_inventory(spark, sf_dir):
    """Every text of a source as a payload file of its own, under names that start with an underscore."""
    path = scratch_path(spark, "raw")
    writers.write_raw(table(spark, sf_dir, "documents").select("source", "text"), path, "source", "text")
    files_ = files.file_inventory(spark, path, "_raw*.json")
    return files_.groupBy("source_key").agg(F.count("*").alias("files"), F.sum("raw_len").alias("raw_len"))


@registered("raw_payloads", "SELECT DISTINCT lang AS source_key, html AS raw FROM pages JOIN documents ON doc_id = page_id")
def raw_payloads(spark, sf_dir):
    """Pages of many lines, several to a key, come back as one row each; what a key held before is gone."""
    path = scratch_path(spark, "payloads")
    pages = table(spark, sf_dir, "pages").withColumnRenamed("page_id", "doc_id").join(
        table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id").select("lang", F.col("html").alias("value"))
    writers.write_raw(pages.select("lang", F.concat(F.lit("old "), "value").alias("value")), path, "lang")
    writers.write_raw(pages, path, "lang")
    return files.read_payloads(spark, path).select("source_key", "raw")


@registered("curve_layout", """
    SELECT l_suppkey, CAST(l_shipdate AS DATE) < DATE '1995-06-01' AS early, count(*) AS lines, CAST(sum(l_partkey) AS BIGINT) AS parts
    FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE) < DATE '1995-06-01'""")
def curve_layout(spark, sf_dir):
    """All lines stored along a curve over supplier and date, read back in two parts, each from the files that may hold it."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("day"), "l_partkey")
    stored = VersionedTable(spark, scratch_path(spark, "curve"), cluster_by=["l_suppkey", "day"], along_curve=True)
    stored.append(lines)
    border = F.lit("1995-06-01").cast("date")
    early = stored.read(files=F.col("least.day") < border).where(F.col("day") < border)
    late = stored.read(files=F.col("greatest.day") >= border).where(F.col("day") >= border)
    parts = [part.groupBy("l_suppkey").agg(F.count("*").alias("lines"), F.sum("l_partkey").alias("parts")).withColumn("early", F.lit(is_early))
             for part, is_early in ((early, True), (late, False))]
    return parts[0].unionByName(parts[1])


@registered("payload_files_sql", """
    SELECT lang AS source_key, count(*) AS payloads, CAST(sum(length(html)) AS BIGINT) AS characters, min(html) AS first_payload
    FROM (SELECT DISTINCT lang, html FROM pages JOIN documents ON doc_id = page_id) GROUP BY lang""")
def payload_files_sql(spark, sf_dir):
    """Pages written as payload files and read by SQL alone, through the data source."""
    path = scratch_path(spark, "payload-source")
    pages = table(spark, sf_dir, "pages").withColumnRenamed("page_id", "doc_id").join(
        table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id").select("lang", F.col("html").alias("value"))
    writers.write_raw(pages, path, "lang")
    payload_source.register(spark)
    view = f"payloads_{path[-32:]}"
    spark.sql(f"CREATE TEMPORARY VIEW {view} USING payload_files OPTIONS (path '{path}', key 'lang')")
    return spark.sql(f"""SELECT source_key, count(*) AS payloads, sum(length(raw)) AS characters, min(raw) AS first_payload
        FROM {view} GROUP BY source_key""")


@registered("input_fingerprint", """
    SELECT count(*) AS file_count, CAST(sum(strlen(text)) AS BIGINT) AS total_size, true AS has_time
    FROM (SELECT DISTINCT source, text FROM documents)""")
def input_fingerprint(spark, sf_dir):
    """Fingerprint of written payloads; of the modification time only that there is one."""
    path = scratch_path(spark, "fingerprint")
    writers.write_raw(table(spark, sf_dir, "documents").select("source", "text"), path, "source", "text")
    return files.fingerprint(spark, path).select("file_count", "total_size", (F.col("max_mtime") > 0).alias("has_time"))


@registered("raw_lines", """
    SELECT lang AS source_key, CAST(sum(length(html) - length(replace(html, chr(10), '')) + 1) AS BIGINT) AS lines FROM (
        SELECT regexp_extract(url, '^[a-z]+') AS lang, html FROM pages) GROUP BY lang""")
def raw_lines(spark, sf_dir):
    path = scratch_path(spark, "lines")
    pages = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "^[a-z]+", 0).alias("key"), F.col("html").alias("value"))
    writers.write_lines(pages, path, "key")
    return (files.read_lines(spark, path).groupBy(files.directory_key(name="key").alias("source_key"))
            .agg(F.count(F.lit(1)).alias("lines")))


BAR = """instrument_id bigint, date date, epoch bigint, open double, high double, low double, close double,
    adj_close double, volume bigint, year int"""


@registered("partitioned_bars", sql("SELECT * FROM fact_market_ohlcv WHERE year >= 1998"))
def partitioned_bars(spark, sf_dir):
    path = scratch_path(spark, "bars")
    writers.write_partitioned(StandIns(spark, sf_dir).fact_market_ohlcv, path, ["year"], ["instrument_id", "date"])
    return files.read_parquet(spark, path, BAR, where="year >= 1998")


@registered("replaced_partitions", sql("""
    SELECT instrument_id, date, close * CASE year WHEN 1997 THEN 2 ELSE 1 END AS close, year FROM fact_market_ohlcv"""))
def replaced_partitions(spark, sf_dir):
    """A second write touches one year only; the others stay as they were."""
    path = scratch_path(spark, "replaced")
    bars = StandIns(spark, sf_dir).fact_market_ohlcv.select("instrument_id", "date", "close", "year")
    writers.write_partitioned(bars, path, ["year"], ["instrument_id", "date"])
    corrected = bars.where("year = 1997").withColumn("close", F.col("close") * 2)
    writers.write_partitioned(corrected, path, ["year"], ["instrument_id", "date"])
    return files.read_parquet(spark, path, "instrument_id bigint, date date, close double, year int")


@registered("published_table", "SELECT c_custkey, c_name, round(c_acctbal, 2) AS balance FROM customer")
def published_table(spark, sf_dir):
    """Readers see the second published version."""
    root = scratch_path(spark, "published")
    customers = table(spark, sf_dir, "customer")
    writers.publish(customers.select("c_custkey", F.lit("stale").alias("c_name"), F.col("c_acctbal").alias("balance")), root)
    writers.publish(customers.select("c_custkey", "c_name", F.round("c_acctbal", 2).alias("balance")), root)
    return writers.read_published(spark, root)


@registered("run_records", """
    SELECT source, max(doc_id) AS last_run, arg_max(n_chars, doc_id) AS keys FROM documents GROUP BY source""")
def run_records(spark, sf_dir):
    """Every document as a run of its source: newest record per source, either count field."""
    path = scratch_path(spark, "runs")
    documents = table(spark, sf_dir, "documents")
    even = F.col("doc_id") % 2 == 0
    documents.select("source", F.lpad(F.col("doc_id").cast("string"), 19, "0").alias("last_run"),
                     F.when(even, F.col("n_chars")).alias("symbols"),
                     F.when(~even, F.col("n_chars")).alias("indicators")).write.json(path)
    newest = writers.latest_run(writers.read_run_records(spark, path))
    return newest.select("source", F.col("last_run").cast("bigint").alias("last_run"), "keys")


@registered("reconciled_copy", """
    SELECT count(*) AS expected_rows, count(*) AS written_rows, true AS matches
    FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""")
def reconciled_copy(spark, sf_dir):
    path, keys = scratch_path(spark, "reconciled"), ["l_orderkey", "l_linenumber"]
    lines = table(spark, sf_dir, "lineitem")
    writers.write_parquet(dedup.keep_latest(lines, keys, [F.col("l_shipdate").desc_nulls_last()]), path)
    return quality.reconcile(lines, files.read_parquet(spark, path), keys)


@registered("counted_write", "SELECT count(*) AS observed_rows, count(*) AS stored_rows FROM events")
def counted_write(spark, sf_dir):
    path = scratch_path(spark, "counted")
    seen = writers.write_counted(table(spark, sf_dir, "events"), path)
    return files.read_parquet(spark, path).agg(F.lit(seen).alias("observed_rows"), F.count(F.lit(1)).alias("stored_rows"))


@registered("tick_windows", """
    SELECT event_id, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) OVER so_far AS BIGINT) AS volume_so_far, lag(value) OVER so_far AS previous,
        max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) AS high_of_21
    FROM events WINDOW so_far AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def tick_windows(spark, sf_dir):
    """Windows over raw ticks, in blocks: volume so far, previous price, high of 21 ticks."""
    ticks = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", "value", F.get_json_object("props", "$.k").cast("bigint").alias("volume"))
    keys, order = ["user_id"], ["ts", "event_id"]
    framed = segments.over_blocks(ticks, keys, order, 20, {
        "previous": lambda w: F.lag("value").over(w), "high_of_21": lambda w: F.max("value").over(w.rowsBetween(-20, 0))})
    return segments.with_running(framed, keys, order, {"volume_so_far": F.col("volume")}).select(
        "event_id", "volume_so_far", "previous", "high_of_21")
