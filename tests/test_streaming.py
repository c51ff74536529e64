"""Streams over several file drops against the batch results."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidelake.functions import sequence_key
from tidelake.streaming import jobs

BAR = "symbol string, date date, epoch bigint, close double, year int"


def drop(spark, rows, path, schema):
    spark.createDataFrame(rows, schema).write.mode("append").parquet(path)


def day(text):
    return datetime.date.fromisoformat(text)


def merge(spark, tmp_path):
    stream = jobs.file_stream(spark, str(tmp_path / "in"), BAR)
    jobs.start_merge(stream, str(tmp_path / "table"), str(tmp_path / "stage"), str(tmp_path / "state"), BAR,
                     ["symbol", "date"], lambda: [F.col("epoch").desc_nulls_last()]).awaitTermination()
    table = spark.read.schema(BAR).parquet(str(tmp_path / "table"))
    return [tuple(r) for r in table.select("symbol", "date", "epoch", "close").orderBy("symbol", "date").collect()]


def test_merge_over_two_drops(spark, tmp_path):
    first = [("A", day("2023-05-01"), 1, 1.0, 2023), ("A", day("2024-05-01"), 1, 2.0, 2024), ("A", day("2024-05-01"), 2, 3.0, 2024)]
    drop(spark, first, str(tmp_path / "in"), BAR)
    assert merge(spark, tmp_path) == [("A", day("2023-05-01"), 1, 1.0), ("A", day("2024-05-01"), 2, 3.0)]
    before = sorted(p.name for p in (tmp_path / "table/year=2023").iterdir())
    second = [("A", day("2024-05-01"), 1, 9.0, 2024), ("B", day("2024-05-02"), 1, 4.0, 2024)]
    drop(spark, second, str(tmp_path / "in"), BAR)
    assert merge(spark, tmp_path) == [("A", day("2023-05-01"), 1, 1.0), ("A", day("2024-05-01"), 2, 3.0), ("B", day("2024-05-02"), 1, 4.0)]
    assert sorted(p.name for p in (tmp_path / "table/year=2023").iterdir()) == before, "untouched year was rewritten"
    assert merge(spark, tmp_path)[-1] == ("B", day("2024-05-02"), 1, 4.0)


TICK = "symbol string, ts timestamp, price double, volume bigint, n bigint"


def bars(spark, tmp_path, duration):
    stream = jobs.file_stream(spark, str(tmp_path / "in"), TICK, files_per_batch=1)
    jobs.start_bars(stream, str(tmp_path / "log"), str(tmp_path / "state"), duration,
                    lambda: sequence_key(F.unix_micros("ts"), "n")).awaitTermination()
    return jobs.read_bars(spark, str(tmp_path / "log")).orderBy("window_start").collect()


def test_bars_of_late_ticks(spark, tmp_path):
    """Files days out of order, in batches of one file: every bar is there, also after compaction and a later file."""
    moment = datetime.datetime(2024, 1, 10, 9, 0)
    ticks = [("A", moment - datetime.timedelta(days=i % 6, seconds=40 * i), float(i % 7), 1, i) for i in range(60)]

    def expected(some):
        out = {}
        for _, ts, price, _, n in some:
            out.setdefault(ts.replace(minute=ts.minute - ts.minute % 5, second=0), []).append((ts, n, price))
        return [(min(b)[2], max(p for _, _, p in b), min(p for _, _, p in b), max(b)[2], len(b)) for _, b in sorted(out.items())]

    def found():
        return [(b["open"], b["high"], b["low"], b["close"], b["trades"]) for b in bars(spark, tmp_path, "5 minutes")]

    for k in range(5):
        drop(spark, ticks[k * 10:k * 10 + 10], str(tmp_path / "in"), TICK)
    assert found() == expected(ticks[:50])
    jobs.compact_log(spark, str(tmp_path / "log"), jobs.merged_bars)
    assert [p.name for p in (tmp_path / "log/new").iterdir() if p.is_dir()] == []
    drop(spark, ticks[50:], str(tmp_path / "in"), TICK)
    assert found() == expected(ticks)


def test_duplicates_across_drops(spark, tmp_path):
    schema = "symbol string, ts timestamp, price double"
    moment = datetime.datetime(2024, 1, 1)
    rows = [("A", moment, 1.0), ("A", moment + datetime.timedelta(minutes=1), 2.0), (None, moment, 5.0)]

    def run():
        stream = jobs.file_stream(spark, str(tmp_path / "in"), schema, files_per_batch=1)
        jobs.start_distinct(stream, str(tmp_path / "log"), str(tmp_path / "state"), ["symbol", "ts"], F.to_date("ts")).awaitTermination()
        return jobs.read_distinct(spark, str(tmp_path / "log")).count()

    drop(spark, rows, str(tmp_path / "in"), schema)
    assert run() == 3
    drop(spark, rows + [("B", moment, 3.0), ("B", moment - datetime.timedelta(days=900), 3.0)], str(tmp_path / "in"), schema)
    assert run() == 5


@pytest.mark.parametrize("by_day", [True, False])
def test_duplicates_after_a_compaction(spark, tmp_path, by_day):
    """Keys that the compacted part holds are known, also those with nulls; later repeats and new keys go on as before."""
    schema, log = "symbol string, ts timestamp, price double", str(tmp_path / "log")
    moment = datetime.datetime(2024, 1, 1)
    rows = [("A", moment, 1.0), ("A", moment + datetime.timedelta(days=40), 2.0), (None, moment, 5.0), ("A", None, 6.0)]

    def run(some):
        drop(spark, some, str(tmp_path / "in"), schema)
        stream = jobs.file_stream(spark, str(tmp_path / "in"), schema, files_per_batch=1)
        jobs.start_distinct(stream, log, str(tmp_path / "state"), ["symbol", "ts"], F.to_date("ts")).awaitTermination()
        return sorted(map(tuple, jobs.read_distinct(spark, log).collect()), key=repr)

    want = sorted(rows, key=repr)
    for k in range(3):
        new = [("B", moment + datetime.timedelta(days=k), 3.0)]
        want = sorted(want + new, key=repr)
        assert run(rows + new) == want
        if by_day:
            jobs.compact_distinct(spark, log, ["symbol", "ts"])
        else:
            jobs.compact_log(spark, log, lambda r: r)
        assert [p.name for p in (tmp_path / "log/new").iterdir() if p.is_dir()] == []
    assert run(rows) == want


def test_merge_of_thousands_of_partitions(spark, tmp_path):
    """A batch that touches 5000 partitions, and stages that do not pile up."""
    schema = "k int, v int, part int"
    newest = lambda: [F.col("v").desc()]

    def run(rows):
        rows.coalesce(2).write.mode("append").parquet(str(tmp_path / "in"))
        jobs.start_merge(jobs.file_stream(spark, str(tmp_path / "in"), schema), str(tmp_path / "t"), str(tmp_path / "stage"),
                         str(tmp_path / "state"), schema, ["k"], newest, ["part"]).awaitTermination()

    run(spark.range(5000).selectExpr("CAST(id AS int) AS k", "1 AS v", "CAST(id AS int) AS part"))
    run(spark.range(0, 5000, 50).selectExpr("CAST(id AS int) AS k", "2 AS v", "CAST(id AS int) AS part"))
    sums = spark.read.schema(schema).parquet(str(tmp_path / "t")).agg(F.count("*"), F.sum("v")).first()
    assert tuple(sums) == (5000, 5100)
    assert [p.name for p in (tmp_path / "stage").iterdir()] == ["batch_id=1"]


def test_file_and_directory_tables(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "d.parquet"))
    [part] = (tmp_path / "d.parquet").glob("*.parquet")
    for path in (tmp_path / "d.parquet", part):
        name = f"seen{len(str(path))}"
        jobs.file_stream(spark, str(path), "id bigint").writeStream.format("memory").queryName(name).trigger(
            availableNow=True).start().awaitTermination()
        assert spark.table(name).count() == 5


def test_replayed_batch_republishes_its_stage(spark, tmp_path):
    """A stage that finished before a failure is used as it is, not merged again."""
    drop(spark, [("A", day("2024-05-01"), 1, 1.0, 2024)], str(tmp_path / "in"), BAR)
    drop(spark, [("A", day("2024-05-01"), 7, 7.0, 2024)], str(tmp_path / "stage/batch_id=0"), BAR)
    assert merge(spark, tmp_path) == [("A", day("2024-05-01"), 7, 7.0)]
