"""Edge cases of the operators on small frames, checked against plain Python."""

import datetime
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidelake import functions as fn
from tidelake.operators import aggregates, dedup, history, joins, keys, quality, series

DAY = datetime.date(2024, 1, 1)


def day(n):
    return DAY + datetime.timedelta(days=n)


def tuples(df, *columns):
    return [tuple(r) for r in df.select(*columns).orderBy(*columns).collect()]


# --- keep latest ----------------------------------------------------------------

def test_keep_latest_ties_do_not_depend_on_row_order(spark):
    rows = [("A", day(0), 5, v) for v in (1.0, 3.0, 2.0)] + [("A", day(1), None, 9.0), ("A", day(1), 1, 8.0)]
    expected = [("A", day(0), 5, 3.0), ("A", day(1), 1, 8.0)]
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        frame = spark.createDataFrame(rows, "symbol string, date date, epoch bigint, close double").repartition(3)
        assert tuples(dedup.latest_bars(frame), "symbol", "date", "epoch", "close") == expected


def test_keep_latest_prefers_later_ingest_for_equal_epochs(spark):
    frame = spark.createDataFrame([("A", day(0), 5, "2024-01-02", 1.0), ("A", day(0), 5, "2024-01-03", 0.5)],
                                  "symbol string, date date, epoch bigint, _ingest_ts string, close double")
    assert tuples(dedup.latest_bars(frame), "close") == [(0.5,)]


def test_keep_latest_with_nested_and_map_columns(spark):
    frame = spark.sql("SELECT * FROM VALUES (1, 1, array(1), map('a', 1)), (1, 2, array(2), map('b', 2)) t(k, v, a, m)")
    assert dedup.keep_latest(frame, ["k"], [F.col("v").desc()]).collect()[0]["a"] == [2]


def test_keep_latest_hot_key_against_python(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(50)}", rng.randrange(1000), i) for i in range(5000)]
    frame = spark.createDataFrame(rows, "k string, v int, i int").repartition(16)
    best = {}
    for k, v, i in rows:
        best[k] = max(best.get(k, (-1, -1)), (v, i))
    assert tuples(dedup.keep_latest(frame, ["k"], [F.col("v").desc()]), "k", "v", "i") == sorted(
        (k, v, i) for k, (v, i) in best.items())


def test_aggregates_without_iso_code_are_told_apart(spark):
    rows = [("X", "", "1W", "2022", "a"), ("X", "", "EU", "2022", "b")]
    frame = spark.createDataFrame(rows, "indicator_id string, country_iso3 string, country_id string, date string, lastupdated string")
    assert dedup.latest_observations(frame).count() == 1
    assert dedup.latest_observations(frame, distinguish_aggregates=True).count() == 2


# --- series ---------------------------------------------------------------------

def bars(spark, closes, instrument=1, symbol="A"):
    return spark.createDataFrame([(instrument, symbol, day(i), c) for i, c in enumerate(closes)],
                                 "instrument_id bigint, symbol string, date date, close double")


def test_returns_guard_missing_and_zero_closes(spark):
    frame = series.with_daily_return(bars(spark, [10.0, 11.0, 0.0, 5.0, None, 6.0]))
    returns = [r["ret_1d"] for r in frame.orderBy("date").collect()]
    assert returns[0] is None and math.isclose(returns[1], 0.1) and returns[2] == -1.0
    assert returns[3:] == [None, None, None]


def test_cumulative_return_ignores_total_loss(spark):
    frame = series.with_cumulative_return(series.with_daily_return(bars(spark, [10.0, 20.0, 0.0, 5.0, 10.0])))
    values = [r["cum_return"] for r in frame.orderBy("date").collect()]
    assert [round(v, 9) for v in values] == [2.0, 2.0, 4.0]


def test_cumulative_return_range_frame_includes_ties(spark):
    rows = [(1, "A", day(1), 0.1), (1, "A", day(1), 0.2)]
    frame = spark.createDataFrame(rows, "instrument_id bigint, symbol string, date date, ret_1d double")
    values = {round(r["cum_return"], 9) for r in series.with_cumulative_return(frame).collect()}
    assert values == {1.32}


@pytest.mark.parametrize("preceding", [30, 2])
def test_volatility_frame(spark, preceding):
    rng = random.Random(3)
    closes = [100.0]
    for _ in range(45):
        closes.append(closes[-1] * (1 + rng.uniform(-0.05, 0.05)))
    returns = [b / a - 1 for a, b in zip(closes, closes[1:])]
    frame = series.with_volatility(series.with_daily_return(bars(spark, closes)), preceding)
    values = [r["vol_30d_annualized"] for r in frame.orderBy("date").collect()]
    assert values[0] is None
    for i in range(1, len(values)):
        window = returns[max(0, i - preceding):i + 1]
        assert math.isclose(values[i], statistics.stdev(window) * math.sqrt(252), rel_tol=1e-9)


def test_yoy_uses_the_previous_row_not_the_previous_year(spark):
    rows = [("I", "USA", "2020", 100.0), ("I", "USA", "2022", 150.0), ("I", "USA", "2023", 0.0), ("I", "USA", "2024", 5.0)]
    frame = series.with_yoy(spark.createDataFrame(rows, "indicator_id string, country_iso3 string, date string, value double"))
    assert tuples(frame, "date", "yoy_pct") == [("2020", None), ("2022", 0.5), ("2023", -1.0), ("2024", None)]


def test_indicator_yoy_sample(spark):
    rows = [("SP.POP.TOTL", "AFE", "2022", 731821393.0), ("SP.POP.TOTL", "AFE", "2023", 750491370.0), ("OTHER", "AFE", "2023", 1.0)]
    frame = spark.createDataFrame(rows, "indicator_id string, country_iso3 string, date string, value double")
    first, second = series.indicator_yoy(frame, "SP.POP.TOTL").collect()
    assert first["prev"] is None and abs(second["yoy"] - 0.025511657869777524) < 1e-9


# --- scalars ----------------------------------------------------------------------

def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("text, plain, corrected", [("2015", "Y", "Y"), ("2015M01", "Y", "M"), ("2015Q4", "Y", "Q"),
                                                    ("2015M", "M", "Y"), ("2015Q", "Q", "Y"), ("", "Y", "Y")])
def test_period_type(spark, text, plain, corrected):
    assert one(spark, fn.period_type(F.lit(text))) == plain
    assert one(spark, fn.period_type(F.lit(text), corrected=True)) == corrected


@pytest.mark.parametrize("amount, expected", [("0.125", "0.12"), ("0.135", "0.14"), ("-0.125", "-0.12"), ("2", "2.00")])
def test_money_rounds_half_to_even(spark, amount, expected):
    assert str(one(spark, fn.money(F.lit(amount).cast("decimal(20,6)")))) == expected


def test_money_totals_never_mix_currencies(spark):
    frame = spark.createDataFrame([("1.005", "usd"), ("1.015", "USD"), ("5", "EUR"), (None, "USD"), ("7", " ")],
                                  "amount string, currency string").withColumn("amount", F.col("amount").cast("decimal(20,6)"))
    assert [(c, str(t)) for c, t in tuples(aggregates.money_totals(frame), "currency", "total")] == [
        ("EUR", "5.00"), ("USD", "2.02")]


def test_other_scalars(spark):
    assert one(spark, fn.safe_key(F.lit("^GSPC/x y"))) == "_GSPC_x_y"
    assert one(spark, fn.leading_number(F.lit("none"))) == ""
    assert one(spark, fn.leading_number(F.lit("FY2024Q1"))) == "2024"
    assert one(spark, fn.or_unknown(F.lit(None).cast("string"))) == "UNK"
    assert one(spark, fn.symbol_class(F.lit("^VIX"))) == "INDEX"
    assert one(spark, fn.code_id(F.lit("CRYPTO"), fn.ASSET_CLASS_IDS)) == 3
    assert one(spark, fn.code_id(F.lit("FUND"), fn.ASSET_CLASS_IDS)) == -1
    assert one(spark, fn.fixed_point_text(F.lit(1.00005))) == "1.0001"
    assert one(spark, fn.log_growth(F.lit(-1.0))) is None


def test_sequence_key_orders_like_the_pair(spark):
    big = 2 ** 63 - 1
    pairs = [(0, 0), (0, big), (1, 0), (1, 5), (big, 0), (big, big)]
    frame = spark.createDataFrame(random.Random(2).sample(pairs, len(pairs)), "a bigint, b bigint")
    assert [tuple(r) for r in frame.orderBy(fn.sequence_key("a", "b")).collect()] == pairs


# --- keys, joins, history, quality ---------------------------------------------------

def test_dense_keys_continue_after_the_highest(spark):
    symbols = [f"S{n:04d}" for n in range(1500)]
    frame = spark.createDataFrame([(s,) for s in random.Random(5).sample(symbols, 1500)], "symbol string")
    existing = spark.createDataFrame([(-1,), (41,), (7,)], "instrument_id bigint")
    numbered = keys.with_dense_key(frame, ["symbol"], "instrument_id", existing)
    assert tuples(numbered, "instrument_id", "symbol") == [(42 + i, s) for i, s in enumerate(symbols)]
    fresh = keys.with_dense_key(frame, ["symbol"], "id")
    assert tuples(fresh, "id", "symbol") == [(1 + i, s) for i, s in enumerate(symbols)]


def test_dense_keys_of_nothing(spark):
    empty = spark.createDataFrame([], "symbol string")
    assert keys.with_dense_key(empty, ["symbol"], "id", spark.createDataFrame([(3,)], "id bigint")).count() == 0


def test_lookup_spreads_a_hot_key(spark):
    """A third of the facts have one key: no task gets more than a small part of them."""
    rows = 240_000
    facts = spark.range(0, rows, 1, 24).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"))
    dimension = spark.range(5000).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = joins.lookup(facts, dimension, "k")
        sizes = [r["count"] for r in joined.withColumn("task", F.spark_partition_id()).where("k = 0").groupBy("task").count().collect()]
        assert sum(sizes) >= rows / 3 and len(sizes) >= 3 and max(sizes) < rows / 6
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_insert_or_ignore(spark):
    existing = spark.createDataFrame([(1, "one")], "id int, name string")
    incoming = spark.createDataFrame([(1, "other"), (2, "b"), (2, "a")], "id int, name string")
    assert tuples(joins.insert_or_ignore(existing, incoming, "id", [F.col("name").asc()]), "id", "name") == [(1, "one"), (2, "a")]


def test_versions(spark):
    rows = [("X", day(0), 1, "A"), ("X", day(0), 2, "B"), ("X", day(3), 3, "B"), ("X", day(5), 4, None),
            ("X", day(6), 5, None), ("X", day(9), 6, "B"), ("Y", day(1), 1, "A")]
    frame = spark.createDataFrame(rows, "k string, d date, seq int, a string")
    result = history.versions(frame, "k", "d", ["a"], [F.col("seq").desc()])
    end = datetime.date(9999, 12, 31)
    assert tuples(result, "k", "valid_from", "a", "valid_to", "is_current") == [
        ("X", day(0), "B", day(4), False), ("X", day(5), None, day(8), False), ("X", day(9), "B", end, True),
        ("Y", day(1), "A", end, True)]


def test_contracts(spark):
    facts = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (9, None)], "k int, v string")
    assert tuples(quality.duplicate_keys(facts, ["k", "v"]), "k", "row_count") == [(1, 2)]
    assert tuples(quality.orphan_keys(facts, spark.createDataFrame([(1,), (2,)], "k int"), "k"), "k", "row_count") == [(9, 1)]
    assert tuples(quality.null_keys(facts, ["k", "v"]), "column_name", "null_rows") == [("k", 0), ("v", 1)]
    assert quality.reconcile(facts, facts.distinct(), ["k"]).first()["matches"]
    assert not quality.reconcile(facts, facts, ["k"]).first()["matches"]


def test_market_summary_merges_instruments_of_one_symbol(spark):
    facts = spark.createDataFrame([(1, 1.0, 2.0, 0.5, 10), (1, 3.0, 4.0, 1.0, 5), (2, 5.0, 6.0, 0.1, 1), (3, None, 1.0, 1.0, 1)],
                                  "instrument_id bigint, close double, high double, low double, volume bigint")
    instruments = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B")], "instrument_id bigint, symbol string")
    direct = aggregates.market_summary(facts.join(instruments, "instrument_id"))
    columns = ["symbol", "bars", "avg_close", "max_high", "min_low", "total_vol"]
    assert tuples(aggregates.market_summary_from_star(facts, instruments), *columns) == tuples(direct, *columns)


def test_positions_profit(spark):
    fills = spark.createDataFrame([("A", 10, 5.0), ("A", 10, 7.0), ("B", 1, 3.0)], "symbol string, quantity int, price double")
    last = spark.createDataFrame([("A", 6.5), ("B", 2.0)], "symbol string, market_price double")
    held = aggregates.positions(fills, last)
    assert tuples(held, "symbol", "qty", "avg_price", "pnl") == [("A", 20, 6.0, 10.0), ("B", 1, 3.0, -1.0)]
    assert aggregates.portfolio_total(held).first()["total_pnl"] == 9.0
    signed = spark.createDataFrame([("A", 10, 5.0), ("A", -4, 9.0), ("B", -3, 2.0), ("B", 1, 7.0), ("C", 2, 1.0), ("C", -2, 4.0)],
                                   "symbol string, quantity int, price double")
    last = spark.createDataFrame([("A", 6.0), ("B", 1.5), ("C", 9.0)], "symbol string, market_price double")
    rows = [("A", 6, 5.0, 6.0), ("B", -2, 2.0, 1.0), ("C", 0, None, 0.0)]
    assert tuples(aggregates.positions(signed, last), "symbol", "qty", "avg_price", "pnl") == rows
    sides = signed.select("symbol", F.when(F.col("quantity") < 0, "sell").otherwise("BUY").alias("side"),
                          F.abs("quantity").alias("quantity"), "price")
    assert tuples(aggregates.positions(sides, last), "symbol", "qty", "avg_price", "pnl") == rows


def test_indicator_report_has_no_cap(spark):
    rows = spark.range(2500).select(F.lit("I").alias("indicator_id"), F.format_string("C%04d", "id").alias("country_iso3"),
                                    F.lit("2022").alias("date"), F.lit(1.0).alias("value"))
    assert series.indicator_yoy(rows, "I").count() == 2500 and series.indicator_yoy(rows, "I", limit=7).count() == 7
