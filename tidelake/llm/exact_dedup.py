"""Exact duplicates: a minimal perfect hash over the distinct digests of earlier batches.

The history is sharded by digest. A shard is one row: the bit levels of a minimal perfect hash, and for every slot
the full digest and the locator of its winner. Lookups compare all 32 bytes, so a digest that the history does not hold is
recognised whatever slot it hashes to; those are grouped among themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidelake.llm.common import SPACE, tasks_for
from tidelake.session import checkpointed

DIGEST = 32
SLOT = np.dtype([("digest", np.uint64, 4), ("size", np.int64), ("none", np.bool_), ("doc_id", np.int64),
                 ("row", np.int64), ("n", np.int64)])
SHARD_ROWS = 100_000
BITS_PER_KEY = 2
#: Digests are uniform, so a level keeps over 60 % of its keys; this many levels are never needed by distinct keys.
MOST_LEVELS = 200


def level_hash(keys: np.ndarray, level: int) -> np.ndarray:
    """Hash of each 256-bit key, another one at every level."""
    with np.errstate(over="ignore"):
        h = keys[:, level % 4] ^ (keys[:, (level + 1) % 4] >> np.uint64(17))
        h = (h + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(32))


class PerfectHash:
    """Cascade of bit levels: a key belongs to the first level where no other key shares its bit; its slot is the bit's rank."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, first = [], 0
        for bits in levels:
            self.ranks.append(first + np.cumsum(bits) - 1)
            first += int(bits.sum())
        self.slots = first

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            if len(levels) == MOST_LEVELS:
                raise ValueError("keys of a perfect hash must be distinct")
            size = max(8, BITS_PER_KEY * len(keys))
            at = (level_hash(keys, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[at]]
        return cls(levels)

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where no level claims it. A foreign key may get a slot: compare its bytes."""
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = (level_hash(keys[open_], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[open_[hit]] = ranks[at[hit]]
            open_ = open_[~hit]
        return out

    def dump(self) -> tuple[list[int], bytes]:
        return [len(b) for b in self.levels], b"".join(np.packbits(b).tobytes() for b in self.levels)

    @classmethod
    def load(cls, sizes: list[int], data: bytes) -> PerfectHash:
        levels, raw = [], np.frombuffer(data, np.uint8)
        for size in sizes:
            n = -(-size // 8)
            levels.append(np.unpackbits(raw[:n], count=size).astype(bool))
            raw = raw[n:]
        return cls(levels)


def digest_of(text: Column) -> Column:
    """SHA-256 of the text without white space; null is empty."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, ""), 256))


def digested(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, size, digest) of every row, stored once; ``row`` tells repeated rows apart."""
    return checkpointed(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.length(F.coalesce(F.col(f"`{text}`"), F.lit(""))).cast("long").alias("size"),
        digest_of(F.col(f"`{text}`")).alias("digest")))


def distinct_digests(rows: DataFrame) -> DataFrame:
    """One row per digest: its winner (longest text, then smallest doc_id, null last, then first row) and its count.

    Partial aggregation sends one row per digest and task, however many copies a text has.
    """
    best = F.min(F.struct((-F.col("size")).alias("shorter"), F.col("doc_id").isNull().alias("none"),
                          F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("row")))
    return rows.groupBy("digest").agg(best.alias("best"), F.count("*").alias("n")).select(
        "digest", (-F.col("best.shorter")).alias("size"), F.col("best.none").alias("none"),
        F.col("best.doc_id").alias("doc_id"), F.col("best.row").alias("row"), "n")


def shard_of(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int").alias("shard")


def slots(rows: pa.Table) -> np.ndarray:
    out = np.zeros(rows.num_rows, SLOT)
    digests = rows["digest"].combine_chunks()
    out["digest"] = np.frombuffer(b"".join(digests.to_pylist()), np.uint64).reshape(-1, 4)
    for name in ("size", "none", "doc_id", "row", "n"):
        out[name] = rows[name].to_numpy()
    return out


STORE = "shard int, levels array<int>, bits binary, slots binary"


def store_history(digests: DataFrame, shards: int) -> DataFrame:
    """History table of distinct digests: one row per shard with its perfect hash and slots."""
    def build(key: tuple, rows: pa.Table) -> pa.Table:
        own = slots(rows)
        hashed = PerfectHash.build(own["digest"])
        placed = np.empty_like(own)
        placed[hashed.lookup(own["digest"])] = own
        sizes, bits = hashed.dump()
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "levels": pa.array([sizes], pa.list_(pa.int32())),
                         "bits": pa.array([bits], pa.binary()), "slots": pa.array([placed.tobytes()], pa.binary())})

    return digests.select(shard_of(shards), "*").groupBy("shard").applyInArrow(build, STORE)


WINNERS = "digest binary, size long, none boolean, doc_id long, row long, n long, known boolean"


def merge(digests: DataFrame, history: DataFrame, shards: int) -> DataFrame:
    """Winners over history and new digests: all slots, with counts and winners brought up to date, then all nonmembers.

    ``known`` tells members of the history. ``shards`` must be the history's.
    """
    def look_up(key: tuple, new: pa.Table, old: pa.Table) -> pa.Table:
        rows, known = slots(new), np.zeros(new.num_rows, bool)
        kept = np.empty(0, SLOT)
        if old.num_rows:
            kept = np.frombuffer(old["slots"][0].as_py(), SLOT).copy()
            at = PerfectHash.load(old["levels"][0].as_py(), old["bits"][0].as_py()).lookup(rows["digest"])
            known = (at >= 0) & (kept["digest"][at] == rows["digest"]).all(axis=1) if len(kept) else known
            mine, repeats = kept[at[known]], rows[known]
            order = [(-x["size"], x["none"], x["doc_id"], x["row"]) for x in (repeats, mine)]
            better, tied = np.zeros(len(mine), bool), np.ones(len(mine), bool)
            for a, b in zip(*order, strict=True):
                better |= tied & (a < b)
                tied &= a == b
            total = mine["n"] + repeats["n"]
            mine[better] = repeats[better]
            mine["n"] = total
            kept[at[known]] = mine
        out = np.concatenate([kept, rows[~known]])
        flat = out["digest"].copy().view(np.uint8).tobytes()
        return pa.table({
            "digest": pa.array([flat[i:i + DIGEST] for i in range(0, len(flat), DIGEST)], pa.binary()),
            **{name: pa.array(out[name].copy()) for name in ("size", "none", "doc_id", "row", "n")},
            "known": pa.array(np.arange(len(out)) < len(kept))})

    sharded = digests.select(shard_of(shards), "*")
    return sharded.groupBy("shard").cogroup(history.groupBy("shard")).applyInArrow(look_up, WINNERS)


#: Digests that hold over 1 / HEAVY of all rows are at most HEAVY, which bounds what is broadcast.
HEAVY = 1000


def decided(rows: DataFrame, winners: DataFrame) -> DataFrame:
    """Each row with its group's winner. Heavy digests meet their rows by broadcast, all others by an exchange."""
    total = rows.count()
    won = winners.select(F.col("digest").alias("of"), F.col("none"), F.col("doc_id").alias("best"), F.col("row").alias("best_row"),
                         "n")
    heavy = F.broadcast(won.where(F.col("n") * HEAVY > total))
    light = won.where(F.col("n") * HEAVY <= total)
    same = F.col("digest") == F.col("of")
    both = rows.join(heavy, same).unionByName(rows.join(heavy, same, "left_anti").join(light, same))
    return both.select("row", "doc_id", F.when(~F.col("none"), F.col("best")).alias("keep_id"), F.col("n").alias("group_size"),
                       (F.col("row") == F.col("best_row")).alias("kept"), "digest")


def deduplicated(rows: DataFrame, past: Column) -> DataFrame:
    """Decide about ``digested`` rows, those where ``past`` holds being the earlier batch.

    The earlier batch becomes the history; digests of the later one are looked up there, and what the history lacks
    groups separately. Every row comes back: row, doc_id, keep_id, group_size, kept, digest. Exactly one row of a group is kept, also
    among repeated rows. Null texts count as empty; a null doc_id comes after all others. An empty table gives no rows.
    """
    spark = rows.sparkSession
    shards = tasks_for(spark, rows.count(), SHARD_ROWS)
    history = store_history(distinct_digests(rows.where(past)), shards)
    winners = checkpointed(merge(distinct_digests(rows.where(~past)), history, shards))
    return decided(rows, winners)


def earlier_half(doc_id: str = "doc_id") -> Column:
    """The split of a single table into an earlier and a later batch: by a hash of the id."""
    return F.pmod(F.xxhash64(doc_id), F.lit(2)) == 0
