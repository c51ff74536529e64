"""What several operators share: table access, partition counts, and connected classes."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelake.session import checkpointed

SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    """All columns renamed, so that joins never meet clashing names."""
    return df.select([F.col(f"`{c}`").alias(f"{prefix}{c}") for c in df.columns])


def tasks_for(spark: SparkSession, rows: int, rows_per_task: int) -> int:
    """Partitions for so many rows; never fewer than the session's own setting."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_task))


def resource(path: str) -> bytes:
    """A vocabulary file: a file of every machine, or one sent with SparkContext.addFile under its own name."""
    if not os.path.exists(path):
        from pyspark import SparkFiles
        path = SparkFiles.get(os.path.basename(path))
    with open(path, "rb") as file:
        return file.read()


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def connected(links: DataFrame) -> DataFrame:
    """Smallest node reachable from each linked node: columns (node, root) from links (a, b).

    Alternating star contraction: every round links each node to the smallest of its larger, then of its
    smaller neighbours, which ends after about log(n) rounds. All edges stay distributed; each round is
    checkpointed. A star with a third of the nodes is aggregated partially before its exchange.
    Links with a null end and loops are ignored; no links give an empty result.
    """
    def stars(edges: DataFrame, large: bool) -> DataFrame:
        near, far = ("a", "b") if large else ("b", "a")
        both = edges.select("a", "b")
        if large:
            both = both.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(near).agg(F.min(far).alias("m"))
        least = least.select(near, F.least("m", near).alias("m"))
        joined = both.join(least, near)
        if large:
            out = joined.where("b > a").select(F.col("m").alias("a"), "b")
        else:
            out = joined.select(F.col("m").alias("x"), F.col("a").alias("y")).union(
                least.select(F.col("m").alias("x"), F.col("b").alias("y"))).where("x <> y").select(
                F.col("x").alias("a"), F.col("y").alias("b"))
        return out.distinct()

    edges = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = checkpointed(edges.distinct())
    state = None
    while True:
        edges = checkpointed(stars(stars(edges, True), False))
        summary = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if summary == state:
            break
        state = summary
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


#: Keys that hold over 1 / HEAVY of all rows are fewer than HEAVY, which bounds what is broadcast.
HEAVY = 1000


def spread_join(rows: DataFrame, side: DataFrame, key: str, of: str) -> DataFrame:
    """Left join of ``rows.key`` with ``side.of``, unique there, in which no key gathers more than a thousandth of the rows.

    Rows of heavier keys meet their part of the side by broadcast, at most a thousand rows of it; all others by an
    exchange. ``rows`` is read three times, so it should be stored.
    """
    total = rows.count()
    heavy = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__heavy")).count().where(F.col("count") * HEAVY > total)
    heavy = checkpointed(heavy.select("__heavy"))
    hot = F.col(key) == F.col("__heavy")
    few = side.join(F.broadcast(heavy), F.col(of) == F.col("__heavy"), "left_semi")
    many = rows.join(F.broadcast(heavy), hot, "left_anti").join(side, F.col(key) == F.col(of), "left")
    return rows.join(F.broadcast(heavy), hot, "left_semi").join(F.broadcast(few), F.col(key) == F.col(of), "left").unionByName(many)
