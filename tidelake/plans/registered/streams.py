"""Streaming jobs run to completion over the test tables, a file to a batch and the newest file first."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelake.functions import epoch_date, sequence_key, utc_instant
from tidelake.plans.registered.registry import registered
from tidelake.plans.registered.operators import LATEST_LINES
from tidelake.plans.standins import table
from tidelake.session import scratch_path
from tidelake.sources import payload_source, writers
from tidelake.streaming import jobs

FILES = 6


def stream_of(spark, sf_dir, name, time):
    """The table as a directory of files that run backwards in time, streamed file by file."""
    path, rows = scratch_path(spark, f"in-{name}"), table(spark, sf_dir, name)
    rows.repartitionByRange(FILES, F.col(time).desc()).write.parquet(path)
    return jobs.file_stream(spark, path, rows.schema, files_per_batch=1)


@registered("stream_tick_bars", """
    SELECT user_id AS symbol, CAST(ts AS DATE) AS day, arg_min(value, row(ts, event_id)) AS open, max(value) AS high,
        min(value) AS low, arg_max(value, row(ts, event_id)) AS close,
        CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS volume, count(*) AS trades
    FROM events GROUP BY user_id, CAST(ts AS DATE)""")
def stream_tick_bars(spark, sf_dir):
    """Daily bars of ticks that arrive days late; the log is compacted halfway through its reads."""
    events = stream_of(spark, sf_dir, "events", "ts").select(
        F.col("user_id").alias("symbol"), utc_instant("ts").alias("ts"), F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"), "event_id")
    log = scratch_path(spark, "bars-log")
    jobs.start_bars(events, log, scratch_path(spark, "bars-state"), "1 day",
                    lambda: sequence_key(F.unix_micros("ts"), "event_id")).awaitTermination()
    jobs.compact_log(spark, log, jobs.merged_bars)
    rows = jobs.read_bars(spark, log)
    return rows.withColumn("day", epoch_date(F.unix_seconds("window_start"))).drop("window_start")


@registered("stream_deduplicated", "SELECT event_id, user_id, event_type, value FROM events")
def stream_deduplicated(spark, sf_dir):
    """The table streamed twice over loses its second copy and nothing else; the log is compacted between the copies."""
    path, rows = scratch_path(spark, "in-twice"), table(spark, sf_dir, "events").withColumn("ts", utc_instant("ts"))
    log, state, keys = scratch_path(spark, "dedup-log"), scratch_path(spark, "dedup-state"), ["event_id", "ts"]
    for order in (F.col("ts").desc(), F.xxhash64("event_id")):
        rows.repartitionByRange(FILES, order).write.mode("append").parquet(path)
        jobs.start_distinct(jobs.file_stream(spark, path, rows.schema, files_per_batch=1), log, state, keys,
                            epoch_date(F.unix_seconds("ts"))).awaitTermination()
        jobs.compact_distinct(spark, log, keys)
    return jobs.read_distinct(spark, log).select("event_id", "user_id", "event_type", "value")


@registered("stream_merged_lines", LATEST_LINES)
def stream_merged_lines(spark, sf_dir):
    """Lines merged into a table partitioned by order status, newest version per line."""
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    lines = stream_of(spark, sf_dir, "lineitem", "l_shipdate").select(
        *columns, F.to_date("l_shipdate").alias("l_shipdate"), (F.col("l_linenumber") % 4).alias("part"))
    newest = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    path = scratch_path(spark, "merged")
    jobs.start_merge(lines, path, scratch_path(spark, "merged-stage"), scratch_path(spark, "merged-state"),
                     lines.schema, ["l_orderkey", "l_linenumber"],
                     lambda: [F.col(c).desc_nulls_last() for c in newest], ["part"]).awaitTermination()
    return spark.read.schema(lines.schema).parquet(path).drop("part")


@registered("stream_payload_files", "SELECT DISTINCT lang AS source_key, text AS raw FROM documents WHERE text IS NOT NULL")
def stream_payload_files(spark, sf_dir):
    """Payload files of two arrivals, streamed through the data source by a query that is stopped in between."""
    root, log, state, out = (scratch_path(spark, f"payload-{x}") for x in ("in", "log", "state", "out"))
    docs, late = table(spark, sf_dir, "documents"), F.xxhash64("lang") % 2 == 0
    payload_source.register(spark)
    for arrival in (docs.where(~late), docs.where(late)):
        writers.write_raw(arrival.select("lang", "text"), root, "lang", "text")
        stream = spark.readStream.format(payload_source.NAME).options(path=root, key="lang", log=log).load()
        stream.select("source_key", "raw").writeStream.format("parquet").option("checkpointLocation", state).trigger(
            availableNow=True).start(out).awaitTermination()
    return spark.read.parquet(out)
