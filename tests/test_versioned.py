"""Versioned tables: whole versions, conflicts, key-wise replacement, file skipping, clean-up."""

import pytest
from pyspark.sql import functions as F

from tidelake.sources.versioned import ConflictError, VersionedTable


def bars(spark, *rows):
    return spark.createDataFrame(list(rows), "symbol string, day int, close double, year int")


def content(table, version=None):
    return sorted(map(tuple, table.read(version).collect()), key=repr)


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "a b+c" / "bars"), ["year"], ["symbol", "day"], rows_per_file=20)


FIRST = [("A/B", 1, 1.0, 2020), ("C", 1, 2.0, 2020), ("C", 400, 3.0, 2021), (None, 1, 4.0, None)]


def test_versions_stay_readable(spark, table):
    assert table.version() is None
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.append(bars(spark, *FIRST)) == 0
    assert table.replace_partitions(bars(spark, ("D", 5, 9.0, 2020), ("N", 2, 8.0, None))) == 1
    assert content(table) == sorted([("D", 5, 9.0, 2020), ("C", 400, 3.0, 2021), ("N", 2, 8.0, None)], key=repr)
    assert content(table, 0) == sorted(FIRST, key=repr)
    table.overwrite(bars(spark).limit(0))
    assert content(table) == []
    assert table.append(table.read(1).select("year", "close", "day", "symbol")) == 3 and content(table) == content(table, 1)


def test_a_reader_during_a_write_and_a_failed_write(spark, table, monkeypatch):
    table.append(bars(spark, *FIRST))
    reader = table.read()
    monkeypatch.setattr(VersionedTable, "_publish", lambda self, *_: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError, match="crash"):
        table.replace_partitions(bars(spark, ("X", 1, 1.0, 2020), ("X", 1, 1.0, 2021)))
    monkeypatch.undo()
    assert table.version() == 0 and content(table) == sorted(map(tuple, reader.collect()), key=repr) == sorted(FIRST, key=repr)
    before = len(table.spark.read.option("recursiveFileLookup", True).parquet(f"{table.root}/data").inputFiles())
    assert table.expire() >= 1
    after = table.spark.read.option("recursiveFileLookup", True).parquet(f"{table.root}/data").inputFiles()
    assert before > len(after) and content(table) == sorted(FIRST, key=repr)


def interleaved(table, monkeypatch, first, second):
    """``second`` commits while ``first`` is about to."""
    plain, ran = VersionedTable._publish, []

    def publish(self, version, entry):
        if not ran:
            ran.append(1)
            second()
        return plain(self, version, entry)

    monkeypatch.setattr(VersionedTable, "_publish", publish)
    return first()


def test_writers_of_different_partitions_are_both_kept(spark, table, monkeypatch):
    table.append(bars(spark, *FIRST))
    other = VersionedTable(spark, table.root, ["year"], ["symbol", "day"])
    interleaved(table, monkeypatch, lambda: table.replace_partitions(bars(spark, ("X", 1, 1.0, 2020))),
                lambda: other.replace_partitions(bars(spark, ("Y", 1, 1.0, 2021))))
    assert content(table) == sorted([("X", 1, 1.0, 2020), ("Y", 1, 1.0, 2021), (None, 1, 4.0, None)], key=repr)


def test_writers_of_one_partition_conflict(spark, table, monkeypatch):
    table.append(bars(spark, *FIRST))
    other = VersionedTable(spark, table.root, ["year"], ["symbol", "day"])
    with pytest.raises(ConflictError):
        interleaved(table, monkeypatch, lambda: table.replace_partitions(bars(spark, ("X", 1, 1.0, 2020))),
                    lambda: other.append(bars(spark, ("Y", 1, 1.0, 2020))))
    monkeypatch.undo()
    keys = bars(spark, ("Z", 1, 1.0, 2020)).select("symbol")
    with pytest.raises(ConflictError):
        interleaved(table, monkeypatch, lambda: table.replace_keys(bars(spark, ("Z", 1, 2.0, 2020)), keys),
                    lambda: other.append(bars(spark, ("Z", 7, 1.0, 2021))))
    assert ("Y", 1, 1.0, 2020) in content(table) and ("X", 1, 1.0, 2020) not in content(table)


def test_keys_are_replaced_in_their_files_only(spark, table):
    table.append(bars(spark, *[(f"S{k:03d}", k, 1.0, 2020 + k % 3) for k in range(300)]))
    before = {r["path"] for r in table.files().collect()}
    keys = spark.createDataFrame([("S010",), ("NEW",), (None,)], "symbol string")
    table.replace_keys(bars(spark, ("S010", 10, 7.0, 2021), ("NEW", 1, 7.0, 2022)), keys)
    after = {r["path"] for r in table.files().collect()}
    assert len(before - after) == 1 and len(before) > 3
    assert table.read().where("close = 7").count() == 2 and table.read().count() == 301
    assert table.replace_keys(bars(spark).limit(0), spark.createDataFrame([("absent",)], "symbol string")) is None
    table.replace_keys(bars(spark).limit(0), spark.createDataFrame([("S010",)], "symbol string"))
    assert table.read().where("symbol = 'S010'").isEmpty() and table.read().count() == 300


def test_conditions_skip_files(spark, table):
    table.append(bars(spark, *[(f"S{k:03d}", k, 1.0, 2020 + k % 3) for k in range(300)]))
    every = table.files().count()
    few = table.where_part(year=2021) & table.where_between("symbol", "S010", "S012")
    assert table.files().where(few).count() < every / 3
    assert [r["symbol"] for r in table.read(files=few).where("symbol BETWEEN 'S010' AND 'S012'").collect()] == ["S010"]
    assert table.files().agg(F.sum("rows")).first()[0] == 300


def test_expire_keeps_what_remaining_versions_have(spark, table):
    table.append(bars(spark, *FIRST))
    table.replace_partitions(bars(spark, ("X", 1, 1.0, 2020)))
    table.replace_partitions(bars(spark, ("Y", 1, 1.0, 2020)))
    now = content(table)
    assert table.expire(keep=2, older_than_ms=0) == 0
    assert table.expire() >= 2 and table.versions() == [2] and content(table) == now
    assert table.expire() == 0


def test_without_partitions(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.append(bars(spark, *FIRST))
    table.overwrite(bars(spark, FIRST[0]))
    assert content(table) == [FIRST[0]] and len(content(table, 0)) == 4
