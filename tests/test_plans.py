"""What the optimizer makes of the plans: exchanges, pruning, pushed filters, hash aggregation."""

import re

from pyspark.sql import functions as F

from tidelake.operators import dedup
from tidelake.plans.standins import StandIns
from tidelake.plans.views import Star, Views
from tidelake.sources.writers import write_bucketed

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", plan(df))


def test_keep_latest_reduces_before_the_exchange(spark):
    lines = StandIns(spark, SF_DIR).read("lineitem")
    text = plan(dedup.keep_latest(lines, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc()]))
    assert re.search(r"WindowGroupLimit.*Final", text) and re.search(r"WindowGroupLimit.*Partial", text)


def test_bars_use_hash_aggregation(spark):
    text = plan(StandIns(spark, SF_DIR).fact_market_ohlcv)
    assert "SortAggregate" not in text and "partial_min_by" in text


def test_return_windows_share_one_exchange(spark):
    views = StandIns(spark, SF_DIR).views
    daily, volatility = exchanges(views.returns_daily), exchanges(views.volatility_30d)
    assert daily == volatility and "SinglePartition" not in daily


def test_symbol_filter_reaches_the_dimension_scan(spark):
    text = plan(StandIns(spark, SF_DIR).views.volatility_30d.where("symbol = 'Supplier#000000001'"))
    assert "EqualTo(s_name,Supplier#000000001)" in text


def test_scans_read_only_what_is_needed(spark):
    text = plan(StandIns(spark, SF_DIR).views.returns_daily)
    [schema] = [s for s in re.findall(r"ReadSchema: struct<([^>]*)", text) if "l_suppkey" in s]
    assert "l_comment" not in schema and "l_discount" not in schema and "l_tax" not in schema


def test_summary_aggregates_before_the_join(spark):
    text = plan(StandIns(spark, SF_DIR).views.yahoo_summary)
    assert text.index("Join") < text.index("partial_max(high")


def test_yoy_has_one_window(spark):
    assert plan(StandIns(spark, SF_DIR).views.macro_yoy).count("Window [") == 1


def test_bucketed_bars_need_no_exchange(spark, tmp_path):
    star = StandIns(spark, SF_DIR).star
    write_bucketed(star["fact_market_ohlcv"], "bucketed_bars", str(tmp_path / "bars"), "instrument_id", ["date"], 4)
    bars = spark.table("bucketed_bars")
    views = Views(Star({**star.tables, "fact_market_ohlcv": lambda: bars}))
    for view in (views.returns_daily, views.returns_cumulative, views.volatility_30d, views.yahoo_summary_short):
        assert "hashpartitioning(instrument_id" not in plan(view)
    assert views.volatility_30d.exceptAll(StandIns(spark, SF_DIR).views.volatility_30d).count() == 0
    spark.sql("DROP TABLE bucketed_bars")


def test_plan_of_a_lookup_without_broadcast(spark):
    """Beyond the broadcast limit both sides are dealt by the key; hot partitions are the adaptive skew join's."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(StandIns(spark, SF_DIR).fact_filings)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert re.search(r"hashpartitioning\(symbol#\d+, \d+\)", text) and spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
