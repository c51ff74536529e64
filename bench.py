"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from tidelake.plans.registered import QUERIES
from tidelake.session import get_session

HEADLINE = [
    "market_summary", "returns_daily", "returns_cumulative", "volatility_30d", "macro_yoy", "source_coverage",
    "market_ohlcv", "market_filings", "instrument_detail", "keep_latest_lines", "keep_latest_bars", "market_fact_load",
    "tick_bars", "instrument_history", "positions", "chart_bars", "macro_silver", "seed_instruments",
]


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_session("bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                        spark__ui__enabled="false", spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, names[0], sf_dir)  # warm the JVM
    seconds = {name: round(min(run(spark, name, sf_dir) for _ in range(2)), 3) for name in names}
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
