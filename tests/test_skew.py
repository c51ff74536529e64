"""Tables in which one key holds a third of all rows, with broadcasts switched off."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from tests.compare import TABLES, differences

SF_DIR = "/root/testdata/sf0.001"
HOT = {
    "lineitem": {"l_suppkey": "if(hash(l_extendedprice) % 3 = 0, 7L, l_suppkey)",
                 "l_orderkey": "if(l_partkey % 5 < 2, 11L, l_orderkey)"},
    "orders": {"o_custkey": "if(o_orderkey % 3 = 0, 5L, o_custkey)"},
    "events": {"user_id": "if(event_id % 3 = 0, 3L, user_id)"},
    "documents": {"source": "if(doc_id % 3 = 0, 'src1', source)", "text": "if(doc_id % 3 = 1, 'one text', text)"},
}
QUERIES = ["market_filings", "keep_latest_lines", "keep_latest_bars", "market_fact_load", "macro_silver", "page_observations",
           "tick_bars", "returns_cumulative", "volatility_30d", "instrument_history", "source_summary", "distinct_payloads",
           "seed_instruments", "loaded_star", "market_summary", "macro_yoy", "raw_inventory", "partitioned_bars",
           "stream_tick_bars", "positions", "new_keys_only", "orphan_keys"]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("skewed")
    for name in TABLES:
        table = spark.read.parquet(f"{SF_DIR}/{name}.parquet").withColumns(
            {column: F.expr(text) for column, text in HOT.get(name, {}).items()})
        table.coalesce(1).write.parquet(str(root / "parts" / name))
        [part] = (root / "parts" / name).glob("*.parquet")
        (root / f"{name}.parquet").symlink_to(part)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield str(root)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", QUERIES)
def test_hot_keys(spark, skewed, name):
    assert differences(spark, skewed, entry_point.queries()[name], entry_point.oracle_sql()[name]) == ""
