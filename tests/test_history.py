"""Stored histories: any order of batches gives the history of all changes at once."""

import random

import pytest
from pyspark.sql import functions as F

from tidelake.operators import history
from tidelake.sources.versioned import VersionedTable

SCHEMA = "k string, d date, seq int, a string, b int"


def frame(spark, rows):
    return spark.createDataFrame([(k, d and f"2024-01-{d:02d}", s, a, b) for k, d, s, a, b in rows], "k string, d string, seq int, a string, b int").withColumn(
        "d", F.col("d").cast("date"))


def at_once(spark, rows):
    rows = frame(spark, [r for r in rows if r[0] is not None and r[1] is not None])
    newest = [F.col(c).desc_nulls_last() for c in ("seq", "a", "b")]
    return sorted(map(tuple, history.versions(rows, "k", "d", ["a", "b"], newest).collect()), key=repr)


def stored(table):
    return sorted(map(tuple, history.current_history(table).collect()), key=repr)


def apply(table, spark, rows):
    return history.apply_changes(table, frame(spark, rows), "k", "d", ["a", "b"], ["seq"])


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "history"), [], ["k", "valid_from"], rows_per_file=4)


BASE = [("x", 5, 1, "p", 1), ("x", 10, 1, "p", 1), ("x", 15, 1, "q", 1), ("x", 20, 1, "p", 1), ("y", 3, 1, "p", None)]


LATE = [
    [("x", 7, 2, "q", 1)],  # splits a version, whose later confirmation remains
    [("x", 12, 2, "q", 1)],  # brings the next one forward
    [("x", 15, 2, "p", 1)],  # a correction joins three versions
    [("x", 1, 2, "p", 1), ("x", 30, 2, "q", 9)],  # before the first and after the last
    [("x", 5, 0, "zz", 1)],  # older than what the day has
    [("x", 5, 2, None, None), ("x", 10, 2, None, None)],  # a version of no attributes replaces one
    [("z", 1, 1, "p", 1), (None, 1, 1, "p", 1), ("x", None, 1, "p", 1)]]


def test_late_changes(spark, table):
    def keyed(rows, case):
        return [(k and f"{k}{case}", *rest) for k, *rest in rows]

    base = [r for case in range(len(LATE)) for r in keyed(BASE, case)]
    apply(table, spark, base)
    assert stored(table) == at_once(spark, base)
    late = [r for case, rows in enumerate(LATE) for r in keyed(rows, case)]
    apply(table, spark, late)
    assert stored(table) == at_once(spark, base + late)


def test_any_order_of_batches(spark, table):
    rng = random.Random(11)
    rows = [(rng.choice("uvw"), rng.randrange(1, 29), rng.randrange(3), rng.choice("pq"), rng.choice([1, None])) for _ in range(70)]
    for k in range(0, 70, 24):
        apply(table, spark, rows[k:k + 24])
    assert stored(table) == at_once(spark, rows)
    version = table.version()
    assert apply(table, spark, []) is None and table.version() == version


def test_distant_versions_are_left_alone(spark, table):
    apply(table, spark, [("x", d, 1, "pq"[d % 2], 1) for d in range(1, 29)] + [("y", d, 1, "pq"[d % 2], 1) for d in range(1, 29)])
    added, gone = history.changed_versions(table.read(), frame(spark, [("x", 9, 2, "r", 1), ("x", 20, 2, "r", 1)]), "k", "d", ["a", "b"], ["seq"])
    assert sorted(r["valid_from"].day for r in gone.collect()) == [8, 9, 10, 19, 20, 21] and added.count() == 6
    files = {r["path"] for r in table.files().collect()}
    apply(table, spark, [("x", 9, 2, "r", 1)])
    assert len(files - {r["path"] for r in table.files().collect()}) <= 2
