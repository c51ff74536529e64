"""SQL over file functions: statements name files, which Spark writes from the tables first."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelake.functions import timestamp_to_epoch
from tidelake.plans import adhoc
from tidelake.plans.registered.registry import registered
from tidelake.plans.standins import table
from tidelake.session import scratch_path
from tidelake.sources import writers


def ticks(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.concat(F.lit("U"), "user_id").alias("symbol"), timestamp_to_epoch("ts").alias("ts"),
                                                 F.col("value").alias("price"), F.lit(3).cast("bigint").alias("volume"))


@registered("sql_read_csv", """
    SELECT 'U' || user_id AS symbol, count(*) AS ticks, max(value) AS highest, CAST(sum(3) AS BIGINT) AS volume,
        (SELECT count(*) FROM events) AS cnt FROM events GROUP BY user_id ORDER BY symbol""")
def sql_read_csv(spark, sf_dir):
    """Aggregates and a nested count over CSV files, types found in the files."""
    path = scratch_path(spark, "market_ticks")
    writers.write_csv(ticks(spark, sf_dir), path)
    return adhoc.query(spark, f"""
        SELECT symbol, count(*) AS ticks, max(price) AS highest, sum(volume) AS volume,
            (SELECT count(*) AS cnt FROM read_csv('{path}/*.csv', header=true)) AS cnt
        FROM read_csv('{path}/*.csv', header=true) GROUP BY symbol ORDER BY symbol""")


@registered("sql_read_json", """
    SELECT o_orderstatus AS side, count(*) AS cnt, max(o_totalprice) AS highest FROM orders GROUP BY o_orderstatus""")
def sql_read_json(spark, sf_dir):
    """Lines of JSON and whole arrays, told apart by the first line, united."""
    root = scratch_path(spark, "market_orders")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("side"), F.col("o_totalprice").alias("price"))
    rows.where("id % 3 > 0").write.json(f"{root}/lines")
    arrays = rows.where("id % 3 = 0").groupBy(F.floor(F.col("id") / 300)).agg(F.to_json(F.collect_list(F.struct("*")), {"pretty": "true"}).alias("raw"))
    arrays.select("raw").write.option("maxRecordsPerFile", 1).text(f"{root}/arrays")
    return adhoc.query(spark, f"""
        SELECT side, count(*) AS cnt, max(price) AS highest
        FROM (SELECT id, side, price FROM read_json('{root}/lines/*.json') UNION ALL SELECT id, side, price FROM read_json('{root}/arrays/*.txt')) t
        GROUP BY side""")


@registered("sql_file_joins", """
    SELECT n.n_name AS country, o.o_orderpriority, count(*) AS orders, CAST(sum(CAST(round(o.o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
    WHERE o.o_orderdate >= TIMESTAMP '1995-01-01' GROUP BY ALL""")
def sql_file_joins(spark, sf_dir):
    """Joins of two Parquet files and a CSV file, with columns left out, in a common table expression."""
    path = scratch_path(spark, "nations")
    writers.write_csv(table(spark, sf_dir, "nation"), path)
    return adhoc.query(spark, f"""
        -- 'read_csv(' in a comment or string is none
        WITH o AS (SELECT * EXCLUDE (o_orderstatus) FROM read_parquet('{sf_dir}/orders.parquet') WHERE o_orderdate >= :since)
        SELECT n.country, o.o_orderpriority, count(*) AS orders, sum(CAST(round(o.o_totalprice * 100) AS BIGINT)) AS cents
        FROM o JOIN '{sf_dir}/customer.parquet' c ON c.c_custkey = o.o_custkey
        JOIN (SELECT n_nationkey, n_name AS country, 'read_csv(' AS note FROM read_csv(['{path}/*.csv'], delim=',', columns={{
            'n_nationkey': 'BIGINT', 'n_name': 'VARCHAR', 'n_regionkey': 'BIGINT'}}, header := true)) n ON n.n_nationkey = c.c_nationkey
        GROUP BY ALL""", since="1995-01-01")
