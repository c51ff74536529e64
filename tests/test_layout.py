"""Tables along a space-filling curve: what files a filter on either column leaves."""

import pytest
from pyspark.sql import functions as F

from tidelake.operators import layout
from tidelake.sources.versioned import VersionedTable


def trades(spark, n=20_000, hot=3):
    """A third of all rows belong to one symbol."""
    symbol = F.when(F.col("id") % hot == 0, F.lit("HOT")).otherwise(F.format_string("S%04d", F.pmod(F.xxhash64("id"), F.lit(500))))
    return spark.range(n).select(symbol.alias("symbol"), F.date_add(F.lit("2020-01-01").cast("date"),
                                 F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).cast("int")).alias("day"), "id")


def share(table, column, low, high):
    files = table.files()
    return files.where(table.where_between(column, low, high)).count() / files.count()


def test_filters_on_either_column_skip_most_files(spark, tmp_path):
    rows = trades(spark)
    along = VersionedTable(spark, str(tmp_path / "curve"), cluster_by=["symbol", "day"], rows_per_file=100, along_curve=True)
    plain = VersionedTable(spark, str(tmp_path / "plain"), cluster_by=["symbol", "day"], rows_per_file=100)
    for table in (along, plain):
        table.append(rows)
        assert table.read().exceptAll(rows).isEmpty() and table.read().count() == 20_000
        assert table.read().columns == ["symbol", "day", "id"]
    days, symbols = ("day", "2021-03-01", "2021-03-07"), ("symbol", "S0100", "S0104")
    assert share(along, *days) < 0.2 and share(along, *symbols) < 0.2
    assert share(plain, *days) > 0.5  # ordered by symbol alone, nearly every file of other symbols holds that week
    one = along.files().where(along.where_between("symbol", "HOT", "HOT") & along.where_between(*days))
    assert one.count() / along.files().count() < 0.05
    week = along.read(files=along.where_between(*days)).where("day BETWEEN '2021-03-01' AND '2021-03-07'")
    assert len(week.inputFiles()) == along.files().where(along.where_between(*days)).count()
    assert week.count() == rows.where("day BETWEEN '2021-03-01' AND '2021-03-07'").count()


def test_places_on_the_curve(spark):
    rows = spark.createDataFrame([(x, y) for x in range(4) for y in range(4)], "x int, y int")
    found = {(r["x"], r["y"]): r["z"] for r in rows.withColumn("z", layout.curve(rows, ["x", "y"], 2)).collect()}
    assert found == {(x, y): (x >> 1) << 3 | (y >> 1) << 2 | (x & 1) << 1 | y & 1 for x, y in found}


def test_nulls_ties_and_empty_tables(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), cluster_by=["x", "y"], along_curve=True)
    empty = spark.createDataFrame([], "x string, y double")
    table.append(empty)
    assert table.read().count() == 0
    rows = spark.createDataFrame([(None, None), ("a", None), (None, 1.0), ("a" * 1000, 2.0)] + [("same", 3.0)] * 50, empty.schema)
    table.append(rows)
    assert table.read().exceptAll(rows).isEmpty() and table.read().count() == 54
    with pytest.raises(ValueError):
        layout.curve(rows, ["x", "y"], 32)


def test_partitions_stay_apart(spark, tmp_path):
    rows = trades(spark, 2000).withColumn("year", F.year("day"))
    table = VersionedTable(spark, str(tmp_path / "t"), ["year"], ["symbol", "day"], along_curve=True)
    table.append(rows)
    assert table.read(files=table.where_part(year=2021)).exceptAll(rows.where("year = 2021")).isEmpty()
    assert table.files().select("part.year").distinct().count() == rows.select("year").distinct().count()
