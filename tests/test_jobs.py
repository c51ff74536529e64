"""Composed jobs from bronze files to gold outputs."""

from pyspark.sql import functions as F

from tidelake.plans import adhoc, jobs
from tidelake.plans.standins import StandIns
from tidelake.plans.views import VIEW_NAMES, Views, register_views
from tidelake.sources import catalog, files, writers
from tests.test_files import BAR, put

SF_DIR = "/root/testdata/sf0.001"


def bronze_bars(tmp_path):
    put(tmp_path, "bronze/yahoo/symbol=AAPL/data.ndjson", "\n".join(
        [BAR.format("AAPL", "2023-12-29", 100.0), BAR.format("AAPL", "2024-01-02", 101.0), "",
         BAR.format("AAPL", "2024-01-02", 101.0).replace("1600000000", "1800000000").replace("101.0", "102.123456")]))
    put(tmp_path, "bronze/yahoo/symbol=MSFT/data.ndjson", BAR.format("MSFT", "2024-01-02", 50.0))
    return str(tmp_path / "bronze/yahoo")


def test_market_merge_is_gated_by_its_inputs(spark, tmp_path):
    bronze, silver, state = bronze_bars(tmp_path), str(tmp_path / "silver/market/ohlcv"), str(tmp_path / "state")
    assert jobs.merge_market(spark, bronze, silver, state)
    rows = catalog.read_table(spark, str(tmp_path), "silver.market_ohlcv").orderBy("symbol", "date").collect()
    assert [(r["symbol"], r["close"], r["year"]) for r in rows] == [("AAPL", 100.0, 2023), ("AAPL", 102.123456, 2024), ("MSFT", 50.0, 2024)]
    assert rows[1]["adj_close"] == 102.123456
    assert not jobs.merge_market(spark, bronze, silver, state)
    put(tmp_path, "bronze/yahoo/symbol=TSLA/data.ndjson", BAR.format("TSLA", "2024-01-02", 7.0))
    assert jobs.merge_market(spark, bronze, silver, state)
    assert catalog.read_table(spark, str(tmp_path), "silver.market_ohlcv").count() == 4


def test_bars_to_csv_rounds_prices(spark, tmp_path):
    jobs.bars_to_csv(spark, bronze_bars(tmp_path), str(tmp_path / "csv"))
    closes = sorted(r["close"] for r in files.read_csv(spark, str(tmp_path / "csv"), catalog.BAR).collect())
    assert closes == [50.0, 100.0, 102.1235]
    # the CSV form feeds the merge just as well
    assert jobs.silver_bars(spark, str(tmp_path / "csv"), "csv").count() == 3


POINT = ('{"indicator":{"id":"I","value":"i"},"country":{"id":"US","value":"U"},"countryiso3code":"USA","date":"%s",'
         '"value":%s,"unit":"","obs_status":"","decimal":0,"_lastupdated":"%s","_sourceid":"2"}')


def test_macro_merge(spark, tmp_path):
    put(tmp_path, "bronze/worldbank/indicator=batch_0001/date=2022/data.ndjson", "\n".join(
        [POINT % ("2022", "1.0", "2024-01-01"), POINT % ("2022", "2.0", "2024-06-01"), POINT % ("2021M05", "null", "2024-01-01")]))
    bronze, silver = str(tmp_path / "bronze/worldbank"), str(tmp_path / "silver/macro/observations")
    assert jobs.merge_macro(spark, bronze, silver, str(tmp_path / "state"))
    rows = catalog.read_table(spark, str(tmp_path), "silver.macro_observations").orderBy("date").collect()
    assert [(r["date"], r["value"], r["year"], r["period_type"]) for r in rows] == [
        ("2021M05", None, "2021", "Y"), ("2022", 2.0, "2022", "Y")]
    jobs.publish_observations(spark, bronze, str(tmp_path / "published"))
    assert writers.read_published(spark, str(tmp_path / "published")).count() == 2


def test_csv_conversion(spark, tmp_path):
    source = put(tmp_path, "silver/cboe.csv", "source_key,raw_len,bronze_path\nVIX,3698,a_b\n")
    tables = {"cboe": (source, catalog.INVENTORY, str(tmp_path / "silver/cboe"))}
    assert jobs.convert_csv(spark, tables, str(tmp_path / "state")) == {"cboe": True}
    assert jobs.convert_csv(spark, tables, str(tmp_path / "state")) == {"cboe": False}
    assert catalog.read_table(spark, str(tmp_path), "silver.cboe").first()["raw_len"] == 3698


def test_inventory_and_source_summary(spark, tmp_path):
    put(tmp_path, "bronze/coinbase/key=BTC-USD/data.raw", "12345")
    jobs.inventory_to_csv(spark, str(tmp_path / "bronze/coinbase"), str(tmp_path / "inventory"))
    jobs.convert_csv(spark, {"coinbase": (str(tmp_path / "inventory"), catalog.INVENTORY, str(tmp_path / "silver/coinbase"))},
                     str(tmp_path / "state"))
    runs = str(tmp_path / "runs")
    writers.append_run_record(spark, runs, "coinbase", "2024-01-01", symbols=2)
    writers.append_run_record(spark, runs, "worldbank", "2024-01-01", indicators=20)
    summary = {r["source"]: (r["bronze_keys"], r["silver_rows"]) for r in jobs.summarise_sources(spark, str(tmp_path), runs).collect()}
    assert len(summary) == 22
    assert (summary["coinbase"], summary["worldbank"], summary["gmd"]) == ((2, 1), (20, 0), (0, 0))


def test_gold_build_isolates_failures(spark, tmp_path):
    bars = jobs.silver_bars(spark, bronze_bars(tmp_path))
    curve = spark.createDataFrame([("2024-01-03", 5.0), ("2024-01-02", 4.0)], "Date string, `1 Mo` double")
    inputs = {
        "yahoo_summary": [lambda: spark.read.parquet(str(tmp_path / "absent")), lambda: bars],
        "worldbank_yoy": [lambda: bars],
        "treasury_yield_curve": [lambda: curve],
        "fred_real_rates": [lambda: curve.select(F.raise_error(F.lit("bad")).cast("string").alias("date"))],
    }
    report = jobs.build_gold(spark, jobs.standard_outputs(inputs, "SP.POP.TOTL"), str(tmp_path / "gold"))
    assert {r["output"]: r["status"] for r in report.collect()} == {
        "yahoo_summary": "written", "worldbank_yoy": "skipped", "treasury_yield_curve": "written",
        "fred_real_rates": "failed", "eia_oil_prices": "skipped", "sec_filings": "skipped"}
    written = spark.read.option("header", True).csv(str(tmp_path / "gold/yahoo_summary"))
    assert {(r["symbol"], r["bars"]) for r in written.collect()} == {("AAPL", "2"), ("MSFT", "1")}


def test_warehouse_round_trip_and_sql(spark, tmp_path):
    star = StandIns(spark, SF_DIR).star
    root = str(tmp_path / "star")
    jobs.store_star(star, root)
    stored = jobs.stored_star(spark, root, jobs.schemas_of(star))
    for name in star.tables:
        columns = star[name].columns
        assert stored[name].select(*columns).exceptAll(star[name]).count() == 0
        assert stored[name].count() == star[name].count()
    register_views(spark, stored)
    text = "SELECT symbol, max(vol_30d_annualized) AS v FROM gold_vw_volatility_30d GROUP BY symbol ORDER BY v DESC LIMIT 3"
    assert adhoc.query(spark, text).count() == 3
    assert len(VIEW_NAMES) == 33 and all(getattr(Views(stored), a).columns for a in VIEW_NAMES.values())


def test_published_databases(spark, tmp_path):
    summary = StandIns(spark, SF_DIR).views.yahoo_summary
    adhoc.publish_database(spark, "gold_test", {"yahoo_summary": summary}, str(tmp_path))
    assert spark.sql("SELECT * FROM gold_test.yahoo_summary").count() == summary.count()
    spark.sql("DROP DATABASE gold_test CASCADE")


def test_catalog_export(spark, tmp_path):
    tables = {"fact_macro_obs": StandIns(spark, SF_DIR).fact_macro_obs, "dim_currency": StandIns(spark, SF_DIR).dim_currency}
    summary = {"summary": spark.range(1).select(F.array("id").alias("ids"), F.lit(1).cast("decimal(9,2)").alias("amount"))}
    jobs.export_catalog(spark, {"dim": tables, "gold": summary}, "s3://lake", str(tmp_path / "c"))
    listed = {r["name"]: r for r in spark.read.json(str(tmp_path / "c/tables")).collect()}
    assert [(c["name"], c["type"]) for c in listed["dim_currency"]["columns"]] == [
        ("currency_id", "int"), ("currency_code", "string"), ("currency_name", "string")]
    assert [c["type"] for c in listed["summary"]["columns"]] == ["string", "double"]
    assert listed["summary"]["location"] == "s3://lake/gold/summary"
    assert spark.read.json(str(tmp_path / "c/databases")).count() == 2


def test_macro_merge_from_csv(spark, tmp_path):
    header = "indicator_id,indicator_name,country_id,country_name,country_iso3,date,year,period_type,value,unit,obs_status,decimal,source_id,lastupdated"
    source = put(tmp_path, "obs.csv", header + "\nI,i,US,U,USA,2022,2022,Y,1.0,,,0,2,2024-01-01\nI,i,US,U,USA,2022,2022,Y,2.0,,,0,2,2024-06-01\n")
    assert jobs.merge_macro(spark, source, str(tmp_path / "silver/macro/observations"), str(tmp_path / "state"), "csv")
    assert [r["value"] for r in catalog.read_table(spark, str(tmp_path), "silver.macro_observations").collect()] == [2.0]


def test_foreign_keys_keep_ids_that_are_set(spark):
    from tidelake.plans.warehouse import with_foreign_keys
    rows = spark.createDataFrame(
        [("EQUITY", "INR", -1, 1, 5), ("INDEX", "USD", 3, 2, None), ("FUND", None, -1, 1, -1)],
        "asset_class string, currency string, asset_class_id int, currency_id int, sector_id int")
    assert [tuple(r)[2:] for r in with_foreign_keys(rows).collect()] == [(1, 2, 5), (3, 2, -1), (-1, 1, -1)]


def test_command_line(spark, tmp_path, capsys):
    from tidelake.__main__ import main
    bronze_bars(tmp_path)
    put(tmp_path, "bronze/worldbank/indicator=A/date=2022/data.ndjson", POINT % ("2022", "1.0", "2024-01-01"))
    main(["--root", str(tmp_path), "merge"])
    main(["--root", str(tmp_path), "merge"])
    main(["--root", str(tmp_path), "query", "SELECT symbol, count(*) AS bars FROM silver_market_ohlcv GROUP BY symbol"])
    printed = capsys.readouterr().out
    assert "market/ohlcv: merged" in printed and "macro/observations: unchanged" in printed and "MSFT" in printed
    main(["--root", str(tmp_path), "query", "SELECT id FROM range(250)"])
    printed = capsys.readouterr().out.splitlines()
    assert printed[-1] == "(250 rows)" and len(printed) == 252
    put(tmp_path, "bronze/fred/series=DGS10/_raw.json", '{"observations":[{"date":"2024-01-02","value":"4.5"},\n{"date":"2024-01-03","value":"."}]}')
    put(tmp_path, "bronze/fred/series=BAD/_raw.json", '{"observations":')
    for command in ("load", "gold", "warehouse", "catalog"):
        main(["--root", str(tmp_path), command])
    printed = capsys.readouterr().out
    assert "fred: loaded, 1 payloads rejected" in printed and "binance: no raw files" in printed
    assert "fred_real_rates: written" in printed and "eia_oil_prices: skipped" in printed and "views published" in printed
    assert spark.sql("SELECT count(*) AS n FROM market.ohlcv").first()["n"] == 3
    for layer in ("gold", "silver", "market", "macro", "ref", "master"):
        spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")
    main(["--root", str(tmp_path), "tables"])
    assert "silver.market_ohlcv" in capsys.readouterr().out


def test_warehouse_load_from_silver(spark, tmp_path):
    from tidelake.plans import warehouse
    bars = jobs.silver_bars(spark, bronze_bars(tmp_path))
    put(tmp_path, "points.ndjson", POINT % ("2022", "1.0", "2024-01-01") + "\n" + (POINT % ("2022", "7.0", "x")).replace("USA", ""))
    points = files.read_json_lines(spark, str(tmp_path / "points.ndjson"), catalog.POINT)
    from tidelake.sources.payloads import observations
    star = warehouse.load_star(spark, warehouse.Silver(bars, observations(points)))
    assert [r["instrument_id"] for r in star["dim_instrument"].orderBy("instrument_id").collect()] == [-1, 1, 2]
    assert {r["country_iso3"]: r["value"] for r in star["fact_macro_obs"].collect()} == {"USA": 1.0, "UNK": 7.0}
    assert star["fact_market_ohlcv"].count() == 3 and star["fact_filings"].count() == 0
    views = Views(star)
    assert views.instrument_detail.count() == 3 and views.master_equity.count() == 2
    assert {(r["table_name"], r["row_count"], r["sources"]) for r in views.source_coverage.collect()} == {
        ("dim_instrument", 2, 1), ("fact_market_ohlcv", 3, 1), ("fact_macro_obs", 2, 1), ("fact_crypto_ohlcv", 0, 0),
        ("fact_rates_daily", 0, 0), ("fact_filings", 0, 0)}


def test_bronze_rejects_of_repeated_and_undated_orders(spark, tmp_path):
    from tidelake.plans.registered.feeds import bronze_rejects
    rows = [(k, k, "F", price, day, "1-URGENT") for k, price, day in [
        (12, 1.0, "1997-01-01 10:00:00"), (12, 1.0, "1997-01-01 10:00:00"), (12, 2.0, "1997-01-01 11:00:00"), (12, 2.0, "1997-01-02 11:00:00"),
        (13, 1.0, None), (20, 1.0, "1997-01-01 10:00:00"), (20, 1.0, "1997-01-01 10:00:00"), (21, 1.0, "1997-01-01 10:00:00"), (21, 1.0, None),
        (None, 1.0, "1997-01-01 10:00:00")]]
    spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, day string, o_orderpriority string").withColumn(
        "o_orderdate", F.col("day").cast("timestamp_ntz")).drop("day").write.parquet(str(tmp_path / "orders.parquet"))
    assert {(r["reason"], r["lines"]) for r in bronze_rejects(spark, str(tmp_path)).collect()} == {("torn line", 2), ("no date", 3)}
