"""Near-duplicate classes by MinHash signatures and a multi-index Hamming join.

A signature holds the low 16 bits of the minima of CHUNK * chunks hash functions over a text's shingles. Two texts whose shingle sets have
a Jaccard coefficient j disagree at each place with probability 1 - j, so linked texts hardly ever disagree at more than
``Plan.distance`` places (``Plan.of`` takes so many chunks that this is rarer than ``MISS``). Signatures are split into chunks, and
of at most distance = chunks * (ERRORS + 1) - 1 errors some chunk holds at most ERRORS: the values of a chunk with each set of ERRORS
places left out are the keys under which a text is indexed, so all pairs within the distance meet under a key.

Texts under one key are not paired. Each is compared with the key's least text by signature; those within the distance are absorbed. Texts that
are not, the strays, are compared with all others of their key in blocks of bounded size, of which only connections leave. A family is
what these connect; its members are verified on full sets in blocks, unless earlier links of the block connect two already.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidelake.llm import ngram_join
from tidelake.llm.common import connected, spread_join, tasks_for
from tidelake.llm.textbytes import mixed
from tidelake.session import checkpointed

CHUNK, ERRORS = 5, 1
#: How rarely a pair at the very bar of similarity may exceed the signature distance.
MISS = 1e-6
#: Texts of one side of a block.
BLOCK = 1024


@dataclass(frozen=True)
class Plan:
    chunks: int

    @property
    def places(self) -> int:
        return self.chunks * CHUNK

    @property
    def distance(self) -> int:
        return self.chunks * (ERRORS + 1) - 1

    @classmethod
    def of(cls, percent: int) -> Plan:
        """The fewest chunks for which texts of that similarity exceed the distance less often than ``MISS``."""
        apart = 1 - percent / 100
        plan = cls(2)
        while sum(comb(plan.places, k) * apart**k * (1 - apart)**(plan.places - k)
                  for k in range(plan.distance + 1, plan.places + 1)) > MISS:
            plan = cls(plan.chunks + 1)
        return plan


def signatures(sets: list[np.ndarray], places: int) -> np.ndarray:
    """One row of 16-bit values per set of 64-bit tokens; empty sets have zeros."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    out = np.zeros((len(sets), places), np.uint16)
    filled = np.flatnonzero(sizes)
    if not len(filled):
        return out
    every = (np.concatenate([sets[k] for k in filled]) >> np.uint64(32)).astype(np.uint32)
    first = np.r_[0, np.cumsum(sizes[filled])[:-1]]
    seeds = mixed(np.arange(1, 2 * places + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for k in range(places):
        hashed = (every ^ np.uint32(seeds[2 * k] >> np.uint64(32))) * (np.uint32(seeds[2 * k + 1] >> np.uint64(32)) | np.uint32(1))
        least = np.minimum.reduceat(hashed, first).astype(np.uint64)
        out[filled, k] = mixed(least + (np.uint64(k) << np.uint64(32))).astype(np.uint16)
    return out


def chunk_keys(found: np.ndarray) -> np.ndarray:
    """Keys of each signature: every chunk with each choice of ERRORS of its places left out."""
    keys = []
    for at in range(0, found.shape[1], CHUNK):
        for left in combinations(range(CHUNK), CHUNK - ERRORS):
            key = np.full(len(found), len(keys) + 1, np.uint64)
            for place in left:
                key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + found[:, at + place])
            keys.append(key)
    return np.stack(keys, 1)


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Places in which each signature of one side differs from each of the other."""
    out = np.zeros((len(x), len(y)), np.uint16)
    for a, b in zip(x.T, y.T, strict=True):
        out += a[:, None] != b
    return out


def _rows(blobs: pa.Array, places: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs.to_pylist()), np.uint16).reshape(-1, places)


INFO = "doc_id long, key binary, short long, n long, bits binary, signature binary"


def summarised(docs: DataFrame, width: int, places: int) -> DataFrame:
    """Digest of the words, number of shingles, parity bitmap and signature of each row, stored once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = ngram_join.Shingler(width)

        def out(ids: pa.Array, keys: list, sets: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                ids, pa.array(keys, pa.binary()), pa.array([k and ngram_join.short_key(k) for k in keys], pa.int64()),
                pa.array(list(map(len, sets)), pa.int64()), pa.array([ngram_join.bitmap(x) for x in sets], pa.binary()),
                pa.array([x.tobytes() for x in signatures(sets, places)], pa.binary())], names=[c.split()[0] for c in INFO.split(", ")])

        for batch in batches:
            keys, sets, held, done = [], [], 0, 0
            for _, key, own in shingler.rows(batch.column("text")):
                keys.append(key)
                sets.append(own)
                held += len(own)
                if held > 1 << 18:
                    yield out(batch.column("doc_id").slice(done, len(keys)), keys, sets)
                    done, keys, sets, held = done + len(keys), [], [], 0
            if keys:
                yield out(batch.column("doc_id").slice(done, len(keys)), keys, sets)

    return checkpointed(ngram_join._own(docs).mapInArrow(run, INFO))


def postings(texts: DataFrame, places: int) -> DataFrame:
    """(key of a chunk, short key of a text), stored once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = chunk_keys(_rows(batch.column("signature"), places)).view(np.int64)
            short = np.repeat(batch.column("short").to_numpy(), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(short)], names=["bucket", "short"])

    return checkpointed(texts.select("short", "signature").mapInArrow(run, "bucket long, short long"))


def close_pairs(pairs: DataFrame, texts: DataFrame, plan: Plan, bound: ngram_join.Bound) -> DataFrame:
    """The stored pairs (hub, short) whose signatures and sizes allow a link."""
    side = lambda p: texts.select(F.col("short").alias(f"of_{p}"), F.col("n").alias(f"n_{p}"), F.col("signature").alias(f"s_{p}"))
    both = spread_join(pairs.join(side("b"), F.col("short") == F.col("of_b")), side("a"), "hub", "of_a").where(
        F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * bound.percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (_rows(batch.column(c), plan.places) for c in ("s_a", "s_b"))
            yield batch.select(["hub", "short"]).filter(pa.array((x != y).sum(1) <= plan.distance))

    return both.select("hub", "short", "s_a", "s_b").mapInArrow(run, "hub long, short long")


def stray_links(members: DataFrame, texts: DataFrame, plan: Plan, bound: ngram_join.Bound) -> DataFrame:
    """Connections (hub, short) between strays of a key and its other members; all members of a component get its first as hub.

    ``members`` are stored rows (bucket, short, stray). Strays are cut into blocks by hash, and so are the absorbed: blocks of strays meet each other
    and those of the absorbed, which do not meet each other, so a large tight group with few strays costs time in proportion to its size.
    """
    sizes = members.groupBy("bucket").agg(F.sum(F.col("stray").cast("long")).alias("s"), F.count("*").alias("m")).where(
        "s > 0 and m > 1").select(F.col("bucket").alias("of"), (F.col("m") <= BLOCK).alias("small"), F.ceil(F.col("s") / BLOCK).alias("cs"),
                                  F.ceil((F.col("m") - F.col("s")) / BLOCK).alias("cd"))
    own = spread_join(members, checkpointed(sizes), "bucket", "of").where(F.col("of").isNotNull())
    cs = F.when(F.col("small"), 1).otherwise(F.col("cs"))
    cd = F.when(F.col("small"), 0).otherwise(F.col("cd"))
    place = F.xxhash64("short")
    own = own.withColumns({"c": F.when(F.col("stray"), F.pmod(place, cs)).when(F.col("small"), 0).otherwise(cs + F.pmod(place, cd)),
                           "others": F.when(F.col("stray") | F.col("small"), cs + cd).otherwise(cs)})
    side = texts.select(F.col("short").alias("of_short"), "n", "signature")
    cut = own.join(side, F.col("short") == F.col("of_short")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    blocks = cut.select("bucket", F.least("c", "j").alias("i"), F.greatest("c", "j").alias("k"), "stray", "short", "n", "signature")
    dealt = blocks.repartition("bucket", "i", "k").sortWithinPartitions("bucket", "i", "k", "short")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def linked(rows: pa.Table) -> pa.Table:
            keys = np.stack([rows[c].to_numpy() for c in ("bucket", "i", "k")], 1)
            short, n, stray = (rows[c].to_numpy() for c in ("short", "n", "stray"))
            found = _rows(rows["signature"], plan.places)
            edges = np.r_[0, np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, len(keys)]
            hubs, ends = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for p, q in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                near = apart(found[p:q], found[p:q]) <= plan.distance
                near &= stray[p:q, None] | stray[p:q]
                low = np.minimum(n[p:q, None], n[p:q])
                near &= 100 * low >= bound.percent * np.maximum(n[p:q, None], n[p:q])
                near |= np.eye(q - p, dtype=bool)
                label = np.arange(q - p)
                while True:
                    least = np.where(near, label, q - p).min(1)
                    if (least == label).all():
                        break
                    label = least
                moved = np.flatnonzero(label != np.arange(q - p))
                hubs.append(short[p + label[moved]])
                ends.append(short[p + moved])
            return pa.table({"hub": np.concatenate(hubs), "short": np.concatenate(ends)})

        for batch in batches:
            every = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            last = [every[c][-1].as_py() for c in ("bucket", "i", "k")]
            of_last = np.logical_and.reduce([every[c].to_numpy() == x for c, x in zip(("bucket", "i", "k"), last, strict=True)])
            whole = len(every) - int(of_last.sum())
            rest = every.slice(whole)
            if whole:
                yield from linked(every.slice(0, whole)).to_batches()
        if rest is not None and len(rest):
            yield from linked(rest).to_batches()

    return dealt.mapInArrow(run, "hub long, short long").distinct()


def families(texts: DataFrame, plan: Plan, bound: ngram_join.Bound) -> DataFrame:
    """(node, root) of the short keys that pairs within the signature distance connect with others."""
    posted = postings(texts, plan.places)
    hubs = posted.groupBy("bucket").agg(F.min("short").alias("hub"), F.max("short").alias("top")).where("hub < top")
    starred = checkpointed(spread_join(posted, checkpointed(hubs.select(F.col("bucket").alias("of"), "hub")), "bucket", "of").where(
        "short > hub").select("bucket", "hub", "short"))
    absorbed = checkpointed(close_pairs(checkpointed(starred.select("hub", "short").distinct()), texts, plan, bound))
    known = absorbed.select(F.col("hub").alias("by"), F.col("short").alias("held"))
    members = starred.join(known, (F.col("hub") == F.col("by")) & (F.col("short") == F.col("held")), "left").select(
        "bucket", "short", F.col("by").isNull().alias("stray"))
    edges = absorbed.unionByName(stray_links(checkpointed(members), texts, plan, bound))
    return connected(edges.select(F.col("hub").alias("a"), F.col("short").alias("b")))


def classes(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Each row's class: (doc_id, n_shingles, component_id, kept).

    Two documents link when their sets of ``width``-word shingles have a Jaccard coefficient of at least percent / 100, which is confirmed on
    full sets; words are cut at ASCII white space, A-Z count as a-z. Fewer words than ``width`` make one shingle. Rows without words, or
    with a null text, have no shingles and their own doc_id as component_id. Equal word sequences are one text from the start. component_id is the
    smallest doc_id reachable, null only where all reachable ones are null; ``kept`` tells whether it is the row's own, so repeated rows of
    the smallest are all kept. One row per input row; only doc_id and text are read; an empty table gives no rows.
    A pair at the very bar is missed with probability ``MISS`` at most, a closer one more rarely.
    """
    bound, plan = ngram_join.Bound(percent), Plan.of(percent)
    info = summarised(docs, width, plan.places)
    texts = checkpointed(info.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("doc_id").alias("least"), *[F.first(c).alias(c) for c in ("short", "n", "bits", "signature")]))
    found = families(texts, plan, bound)
    members = checkpointed(found.join(texts, F.col("node") == F.col("short")).select("root", "key", "least", "n", "bits"))
    links = ngram_join.family_links(members, ngram_join.token_sets(docs, width, members.select("least")), bound)
    named = connected(links.distinct()).join(texts.select(F.col("key").alias("node"), "least"), "node")
    smallest = named.groupBy("root").agg(F.min("least").alias("smallest"))
    of_key = named.join(smallest, "root").select("node", "smallest")
    every = texts.join(of_key, F.col("key") == F.col("node"), "left").select(
        F.col("key").alias("of"), F.coalesce("smallest", "least").alias("component"))
    out = spread_join(info, checkpointed(every), "key", "of")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))
