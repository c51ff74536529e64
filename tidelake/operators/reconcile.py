"""Reconciliation of two tables by content: digest trees tell where they differ, and only there are rows compared.

A leaf holds the rows whose keys hash to it: their number, and the sum and exclusive or of their digests, which no order of rows changes. Trees are
small, so a copy can be checked by the tree that was stored with it. Differing leaves are found from the root down.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

LEAVES, FANOUT_BITS = 1 << 12, 4


def row_digest(columns: Sequence[str]) -> Column:
    """64-bit digest of a row, in which a null differs from every value and columns do not run into each other."""
    return F.xxhash64(*[part for c in sorted(columns) for part in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())])


def leaf_of(keys: Sequence[str], leaves: int) -> Column:
    return F.pmod(row_digest(keys), F.lit(leaves)).cast("int")


def _digests(digest: str) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), F.sum(F.col(digest).cast("decimal(38,0)")).alias("total"), F.bit_xor(digest).alias("mixed")]


def digest_tree(rows: DataFrame, keys: Sequence[str], leaves: int = LEAVES) -> DataFrame:
    """``(level, node, rows, total, mixed)``; level 0 is the root, a node's parent is ``node / 16``. One partial aggregate, one scan."""
    depth = -(-(leaves - 1).bit_length() // FANOUT_BITS)
    own = rows.select(leaf_of(keys, leaves).alias("leaf"), row_digest(rows.columns).alias("digest")).groupBy("leaf").agg(*_digests("digest"))
    steps = own.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(depth))))
    node = F.shiftright("leaf", 0) if depth == 0 else F.floor(F.col("leaf") / F.pow(F.lit(2.0), (F.lit(depth) - F.col("level")) * FANOUT_BITS)).cast("int")
    return steps.groupBy("level", node.alias("node")).agg(F.sum("rows").alias("rows"), F.sum("total").alias("total"), F.bit_xor("mixed").alias("mixed"))


def unequal_leaves(left: DataFrame, right: DataFrame) -> list[int]:
    """Leaves in which two trees of one size differ; a level is compared only below differing nodes of the one above."""
    depth = left.unionByName(right).agg(F.max("level")).first()[0]
    if depth is None:
        return []
    open_ = [0]
    for level in range(depth + 1):
        a, b = (t.where((F.col("level") == level) & F.col("node").isin(open_)).drop("level") for t in (left, right))
        same = (a.node == b.node) & (a.rows == b.rows) & (a.total == b.total) & (a.mixed == b.mixed)
        differ = sorted({r["node"] for r in a.join(b, same, "left_anti").union(b.join(a, same, "left_anti")).select("node").collect()})
        if level == depth or not differ:
            return differ
        open_ = [node * (1 << FANOUT_BITS) + k for node in differ for k in range(1 << FANOUT_BITS)]
    return []


def differences(left: DataFrame, right: DataFrame, keys: Sequence[str], leaves: int = LEAVES) -> DataFrame:
    """``(keys, status, left_rows, right_rows)`` of each key whose rows differ: missing or extra on the right, or changed.

    Rows of equal leaves are neither shuffled nor compared. A key may have several rows, which count as a bag; nulls are values.
    Both sides need the same columns, in any order; columns of other types differ. Equal or empty tables give no rows.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"columns differ: {sorted(left.columns)} and {sorted(right.columns)}")
    found = unequal_leaves(digest_tree(left, keys, leaves), digest_tree(right, keys, leaves))  # at most as many as leaves

    def by_key(rows: DataFrame, side: str) -> DataFrame:
        own = rows.where(leaf_of(keys, leaves).isin(found)) if found else rows.limit(0)
        own = own.select(*keys, row_digest(rows.columns).alias("__digest")).groupBy(*keys).agg(*_digests("__digest"))
        return own.select(*[F.col(k).alias(f"{side}_{k}") for k in keys], F.struct("rows", "total", "mixed").alias(side))

    same = F.lit(True)
    for k in keys:
        same &= F.col(f"l_{k}").eqNullSafe(F.col(f"r_{k}"))
    both = by_key(left, "l").join(by_key(right, "r"), same, "full").where(~F.col("l").eqNullSafe(F.col("r")))
    status = F.when(F.col("r").isNull(), "missing").when(F.col("l").isNull(), "extra").otherwise("changed")
    return both.select(*[F.coalesce(f"l_{k}", f"r_{k}").alias(k) for k in keys], status.alias("status"),
                       F.coalesce("l.rows", F.lit(0)).alias("left_rows"), F.coalesce("r.rows", F.lit(0)).alias("right_rows"))
