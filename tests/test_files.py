"""Readers and writers on small files."""

import json

import pytest
from pyspark.sql import functions as F

from tidelake.plans import adhoc
from tidelake.sources import catalog, files, writers

BAR = ('{{"symbol":"{0}","date":"{1}","epoch":1600000000,"open":12.5,"high":99.5,"low":6.25,"close":{2},'
       '"adjClose":{2},"volume":345}}')


def put(root, relative, text):
    path = root / relative
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_csv_with_filter(spark, tmp_path):
    put(tmp_path, "t/a.csv", "symbol,ts,price,volume,exchange\nAAPL,1,10.5,3,X\nMSFT,2,20.0,4,Y\n")
    frame = adhoc.query_csv(spark, str(tmp_path / "t"), catalog.TICK, "price > 15")
    assert [r["symbol"] for r in frame.collect()] == ["MSFT"]


def test_json_array_document(spark, tmp_path):
    orders = [{"id": i, "symbol": "AAPL", "side": "BUY", "qty": i, "price": 1.5, "ts": 1} for i in range(50)]
    put(tmp_path, "orders.json", json.dumps(orders, indent=1))
    frame = files.read_json_documents(spark, str(tmp_path / "orders.json"), catalog.ORDER)
    assert frame.agg(F.sum("qty")).first()[0] == sum(range(50))


def test_ticks_as_text(spark, tmp_path):
    put(tmp_path, "ticks.ndjson", '{"symbol":"A","ts":"17","price":"1.5","volume":"3","exchange":"X"}\n\n'
                                  '{"symbol":"A","ts":"18","price":"2.5","volume":"4","exchange":"X","extra":1}\n')
    frame = files.read_json_lines(spark, str(tmp_path / "ticks.ndjson"), catalog.TICK_TEXT)
    typed = frame.select(F.col("price").cast("double"), F.col("volume").cast("bigint"))
    assert typed.agg(F.sum("price"), F.sum("volume")).first() == (4.0, 7)


def test_corrupt_lines_are_kept_apart(spark, tmp_path):
    put(tmp_path, "x.ndjson", BAR.format("A", "2024-01-01", 1.0) + "\n{\"symbol\":\"B\n")
    frame = files.read_json_lines(spark, str(tmp_path / "x.ndjson"), catalog.BRONZE_BAR, keep_corrupt=True).cache()
    assert frame.where(F.col(files.CORRUPT).isNotNull()).count() == 1
    assert [r["symbol"] for r in frame.where(F.col(files.CORRUPT).isNull()).collect()] == ["A"]


def test_recursive_files_of_one_name(spark, tmp_path):
    line = '{"indicator":{"id":"A","value":"a"},"country":{"id":"US","value":"U"},"countryiso3code":"USA","date":"2022","value":1}\n'
    put(tmp_path, "indicator=batch_0001/date=2022/data.ndjson", line)
    put(tmp_path, "indicator=batch_0001/date=2023/data.ndjson", line)
    put(tmp_path, "indicator=batch_0001/date=2023/raw_page=1.json", "[]")
    frame = files.read_json_lines(spark, str(tmp_path), catalog.POINT, name_glob="data.ndjson")
    assert frame.select("indicator.id", files.directory_key(name="date").alias("d")).orderBy("d").collect() == [("A", "2022"), ("A", "2023")]


def test_payload_keys_and_inventory(spark, tmp_path):
    put(tmp_path, "symbol=%5EGSPC/page.json", "abc")
    put(tmp_path, "key=BTC-USD/data.raw", "abcdef")
    rows = {r["source_key"]: r["raw"] for r in files.read_payloads(spark, str(tmp_path)).collect()}
    assert rows == {"^GSPC": "abc", "BTC-USD": "abcdef"}
    sizes = {r["source_key"]: r["raw_len"] for r in files.file_inventory(spark, str(tmp_path)).collect()}
    assert sizes == {"^GSPC": 3, "BTC-USD": 6}


def test_numeric_symbols_survive_partitioning(spark, tmp_path):
    frame = spark.createDataFrame([("600000", 1.0), ("AAPL", 2.0)], "symbol string, close double").withColumn("year", F.lit(2024))
    writers.write_partitioned(frame, str(tmp_path / "p"), ["year", "symbol"], ["close"])
    again = adhoc.query_parquet(spark, str(tmp_path / "p"), "symbol = '600000'", "symbol string, close double, year int")
    assert again.select("symbol", "close", "year").collect() == [("600000", 1.0, 2024)]


def test_raw_write_replaces_only_its_keys(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = spark.createDataFrame([("A", "one"), ("B", "two")], "symbol string, value string")
    writers.write_raw(rows, path, "symbol")
    writers.write_raw(spark.createDataFrame([("A", "new")], "symbol string, value string"), path, "symbol")
    stored = {r["source_key"]: r["raw"].strip() for r in files.read_payloads(spark, path, "_raw*.json").collect()}
    assert stored == {"A": "new", "B": "two"}
    history = str(tmp_path / "history")
    writers.write_raw(rows, history, "symbol", keep_history=True)
    writers.write_raw(rows, history, "symbol", keep_history=True)
    assert files.read_payloads(spark, history).count() == 4


def test_half_written_versions_stay_invisible(spark, tmp_path):
    root = str(tmp_path / "t")
    writers.publish(spark.range(3), root)
    spark.range(99).write.parquet(f"{root}/versions/unfinished")
    assert writers.read_published(spark, root).count() == 3
    writers.publish(spark.range(4), root)
    assert writers.read_published(spark, root).count() == 4


def test_run_records(spark, tmp_path):
    path = str(tmp_path / "runs")
    writers.append_run_record(spark, path, "yahoo", "2024-01-01T00:00:00Z", symbols=5)
    writers.append_run_record(spark, path, "yahoo", "2024-01-02T00:00:00Z", symbols=10)
    writers.append_run_record(spark, path, "worldbank", "2024-01-01T00:00:00Z", indicators=1498, lastupdated="2024")
    newest = writers.latest_run(writers.read_run_records(spark, path))
    assert {r["source"]: r["keys"] for r in newest.collect()} == {"yahoo": 10, "worldbank": 1498}


def test_fingerprint_changes_with_the_files(spark, tmp_path):
    put(tmp_path, "in/a.csv", "x")
    first = files.fingerprint(spark, str(tmp_path / "in")).first()
    assert (first["total_size"], first["file_count"]) == (1, 1)
    put(tmp_path, "in/b.csv", "yy")
    second = files.fingerprint(spark, str(tmp_path / "in")).first()
    assert (second["total_size"], second["file_count"]) == (3, 2)


@pytest.mark.parametrize("uri, expected", [("s3://lake-bronze/market_ticks/", "/d/bronze/market_ticks/"),
                                           ("s3://firehose/x", "/d/bronze/firehose/x"), ("s3://other/k", "/d/other/k"),
                                           ("s3://lake-gold", "/d/gold/")])
def test_bucket_addresses(uri, expected):
    buckets = {"lake-bronze": "bronze", "lake-gold": "gold", "firehose": "bronze/firehose"}
    assert catalog.local_path(uri, "/d", buckets) == expected


def test_registry(spark, tmp_path):
    assert len(catalog.SOURCES) == 22
    put(tmp_path, "gold/positions/p.csv", "symbol,qty,avg_price,market_price,pnl\nA,1,2.0,3.5,1.5\nB,2,2.0,1.0,-2.0\n")
    catalog.register_tables(spark, str(tmp_path), "gold.positions")
    assert adhoc.query(spark, "SELECT sum(pnl) AS total FROM gold_positions WHERE qty >= :least", least=1).first()["total"] == -0.5


def test_csv_of_other_writers(spark, tmp_path):
    path = put(tmp_path, "t.csv", 'id,name,n\n1,"Land ""A"", north",5\n2,"two\nlines",6\n3,"",\n4,,7\n5, kept ,8\n')
    rows = files.read_csv(spark, path, "id int, name string, n int").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, 'Land "A", north', 5), (2, "two\nlines", 6), (3, "", None), (4, None, 7), (5, " kept ", 8)]


def test_csv_export_doubles_its_quotes(spark, tmp_path):
    rows = [(1, 'say "x", y'), (2, ""), (3, None), (4, "back\\slash"), (5, "a\r\nb")]
    writers.write_csv(spark.createDataFrame(rows, "id int, name string").coalesce(1), str(tmp_path / "out"))
    [part] = (tmp_path / "out").glob("*.csv")
    assert 'say ""x"", y' in part.read_text()
    import csv
    with open(part, newline="") as file:
        assert [r["name"] for r in csv.DictReader(file)] == ['say "x", y', "", "", "back\\slash", "a\r\nb"]
    back = files.read_csv(spark, str(tmp_path / "out"), "id int, name string")
    assert sorted(map(tuple, back.collect())) == rows


def test_lines_lie_as_sparks_writer_would_put_them(spark, tmp_path):
    keys = ["A", "a/b", "^X", "x y", "é", "k=1%", "[q]{}", "", None]
    rows = spark.createDataFrame([(k, f"{k} {n}" if n else None) for k in keys for n in range(3)], "symbol string, value string")
    rows.write.partitionBy("symbol").text(str(tmp_path / "spark"))
    writers.write_lines(rows, str(tmp_path / "own"), "symbol", ".ndjson")

    def stored(root, suffix):
        return {d.name: sorted(line for f in d.glob(f"*{suffix}") for line in f.read_text().split("\n")[:-1])
                for d in (tmp_path / root).iterdir() if "=" in d.name}
    assert stored("own", ".ndjson") == stored("spark", ".txt")
    # a second write replaces its own keys only; one that fails replaces nothing
    writers.write_lines(rows.where("symbol = 'A'").select("symbol", F.lit("new").alias("value")), str(tmp_path / "own"), "symbol", ".ndjson")
    torn = rows.select("symbol", F.when(F.col("symbol") == "x y", F.raise_error(F.lit("torn"))).otherwise("x").alias("value"))
    with pytest.raises(Exception, match="torn"):
        writers.write_lines(torn, str(tmp_path / "own"), "symbol", ".ndjson")
    assert stored("own", ".ndjson") == {**stored("spark", ".txt"), "symbol=A": ["new"] * 3}
    assert all("=" in d.name for d in (tmp_path / "own").iterdir())


def test_a_large_key_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(40_000).select(F.when(F.col("id") % 4 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 64)).alias("symbol"),
                                      F.col("id").cast("string").alias("value"))
    writers.write_lines(rows, str(tmp_path / "t"), "symbol")
    number = {d.name: len(list(d.glob("*.txt"))) for d in (tmp_path / "t").glob("symbol=*")}
    assert len(number) == 17 and {n for d, n in number.items() if d != "symbol=hot"} == {1}
    assert sorted(int(r[0]) for r in spark.read.text(str(tmp_path / "t")).select("value").collect()) == list(range(40_000))


def test_directories_are_listed_in_a_few_tasks(spark, tmp_path):
    for k in range(spark.sparkContext.defaultParallelism * 8 + 40):
        put(tmp_path, f"symbol={k}/data.ndjson", BAR.format(k, "2024-01-01", 1.0))
    context = spark.sparkContext
    context.setJobGroup(str(tmp_path), "listing")
    try:
        files.read_json_lines(spark, str(tmp_path), catalog.BRONZE_BAR, name_glob="*.ndjson")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(str(tmp_path)) for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(s.numTasks for s in stages) <= context.defaultParallelism * 8
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == "10000"


def test_the_driver_holds_no_directories(spark, tmp_path, monkeypatch):
    for k in range(300):
        put(tmp_path, f"symbol={k}/deep/_raw.json", "x" * k)
    put(tmp_path, "plain.json", "y")
    rows, create = [], type(spark).createDataFrame

    def counted(self, data, *rest, **named):
        rows.append(len(data))
        return create(self, data, *rest, **named)
    monkeypatch.setattr(type(spark), "createDataFrame", counted)
    one = files.fingerprint(spark, str(tmp_path)).first()
    assert (one["file_count"], one["total_size"]) == (301, 1 + sum(range(300)))
    assert sorted(len(r["raw"]) for r in files.read_payloads(spark, [str(tmp_path)], "_raw*").collect()) == list(range(300))
    assert max(rows) == 1
