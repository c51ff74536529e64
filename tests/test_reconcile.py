"""Content reconciliation: planted differences are located, equal leaves left alone."""

from pyspark.sql import functions as F

from tidelake.operators import reconcile

ROWS = [(k, "ab"[k % 2] if k % 5 else None, float(k)) for k in range(500)] + [(None, "n", 1.0), (7, "second", None)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, s string, v double")


def found(left, right, **options):
    return sorted(map(tuple, reconcile.differences(left, right, ["k"], **options).collect()), key=repr)


def test_planted_differences(spark):
    left = frame(spark, ROWS)
    other = [r for r in ROWS if r[0] not in (3, 100)] + [(100, None, -1.0), (9999, "x", 0.0), (None, "n", 2.0), (8, "b", 8.0)]
    right = frame(spark, other).select("v", "s", "k").repartition(7)
    assert found(left, right) == sorted([(3, "missing", 1, 0), (100, "changed", 1, 1), (9999, "extra", 0, 1), (None, "changed", 1, 2),
                                         (8, "changed", 1, 2)], key=repr)
    assert found(left, right, leaves=16) == found(left, right) == found(left, right, leaves=1)
    leaves = reconcile.unequal_leaves(reconcile.digest_tree(left, ["k"]), reconcile.digest_tree(right, ["k"]))
    assert len(leaves) == 5 and found(left, left.repartition(3)) == []


def test_nulls_and_neighbours_are_told_apart(spark):
    a = spark.createDataFrame([(1, "x", None)], "k int, s string, t string")
    b = spark.createDataFrame([(1, None, "x")], "k int, s string, t string")
    assert found(a, b) == [(1, "changed", 1, 1)] and found(a.limit(0), a) == [(1, "extra", 0, 1)] and found(a.limit(0), b.limit(0)) == []


def test_upper_levels_add_up(spark):
    tree = reconcile.digest_tree(frame(spark, ROWS), ["k"])
    totals = tree.groupBy("level").agg(F.sum("rows"), F.sum("total"), F.bit_xor("mixed")).drop("level").distinct().collect()
    assert len(totals) == 1 and totals[0][0] == len(ROWS)
