"""Windows in blocks against Spark's own window over whole keys, one of which holds a third of the rows."""

from pyspark.sql import Window, functions as F

from tidelake.operators import segments


def ticks(spark, n=6000):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 97 == 0, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 40))
    return spark.range(n).select(key.alias("key"), F.pmod(F.xxhash64("id"), F.lit(50)).alias("t"), "id",
                                 F.when(F.col("id") % 11 > 0, F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1000))).alias("v"))


def same(a, b):
    return a.select(*b.columns).exceptAll(b).isEmpty() and a.count() == b.count()


def test_equal_to_plain_windows(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows, whole = ticks(spark), Window.partitionBy("key").orderBy("t", "id")
        so_far = whole.rowsBetween(Window.unboundedPreceding, 0)
        found = segments.with_running(rows, ["key"], ["t", "id"], {"total": F.col("v"), "n": F.lit(1)})
        assert same(found, rows.withColumn("total", F.sum("v").over(so_far)).withColumn("n", F.count(F.lit(1)).over(so_far)))
        look = {"before": lambda w: F.lag("v", 7).over(w), "high": lambda w: F.max("v").over(w.rowsBetween(-7, 0)),
                "n": lambda w: F.count("v").over(w.rowsBetween(-7, 0))}
        expected = rows.withColumns({name: f(whole) for name, f in look.items()})
        for size in (7, 10, 100_000):  # a block as small as its frame, blocks that cut every key, one block
            assert same(segments.over_blocks(rows, ["key"], ["t", "id"], 7, look, size), expected)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_empty_table(spark):
    rows = ticks(spark).where("false")
    assert segments.over_blocks(rows, ["key"], ["id"], 3, {"p": lambda w: F.lag("v").over(w)}).count() == 0
