"""Ranked lexical search over K2-treaps: quadtrees of a term-document grid whose cells hold impact maxima.

A shard covers a run of documents. Its grid has a row per term, frequent ones first, and a column per document, in order of doc_id; an
entry is the impact of the term in the document without the term's weight. Only cells with an entry exist: a level keeps, for each cell, four
bits that tell which quarters exist, and its maximum as the difference from the parent's. The position of a cell's quarters in the next
level follows from the number of bits before them. The index covers all terms of all documents and is written once.

A query descends along the paths of all its terms' rows at once: a document range has one cell per row, and the weighted sum of their maxima bounds
every score within. Ranges are taken best first, a batch at a time, halved, and left out below the tenth best score found.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidelake.llm.alignment import packed, unpacked
from tidelake.llm.textbytes import Powers, byte_values, segment_hashes, slices, words
from tidelake.session import scratch_path

#: Postings and documents of one shard: a shard ends with the document that reaches either.
SHARD_POSTINGS, SHARD_DOCUMENTS = 1 << 20, 1 << 15
#: Ranges that are halved at once.
BATCH = 512
#: Terms of the items of one block, whose rows every task holds; one longer item makes a block alone.
BLOCK_TERMS = 1 << 18
NO_ID = np.int64(2**63 - 1)

# Bytes that part terms are those below 0x80 that are neither digits nor letters.
BETWEEN = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])


class Terms:
    """Hashes of the terms of each row of a text column."""

    def __init__(self):
        self.powers, self.values = Powers(), byte_values(True)

    def slices(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, hashes of all terms, offsets of the rows among them) of runs of rows."""
        for first, _, data, offsets in slices(texts):
            starts, ends, at = words(data, offsets, BETWEEN)
            yield first, (segment_hashes(data, starts, ends, self.values, self.powers) if len(starts) else np.empty(0, np.uint64)), at

    def counted(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(row, distinct terms, their numbers) of each row."""
        for first, hashes, at in self.slices(texts):
            for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
                yield first + k, *np.unique(hashes[a:b], return_counts=True)


@dataclass(frozen=True)
class Corpus:
    """Documents that hold a term, and all their terms."""
    documents: int
    terms: int

    def length_share(self, n: int) -> int:
        return 100 - 90 + (90 * n * self.documents) // self.terms

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * df + 1)))


def corpus(docs: DataFrame) -> Corpus:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            number = [np.diff(at) for _, _, at in terms.slices(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array([sum(int((n > 0).sum()) for n in number)], pa.int64()),
                                              pa.array([sum(int(n.sum()) for n in number)], pa.int64())], names=["documents", "terms"])

    return Corpus(*docs.select("text").mapInArrow(run, "documents long, terms long").agg(
        F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first())


def spread(x: np.ndarray) -> np.ndarray:
    """Whole numbers below 2^32 with a zero bit before each of their bits."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333),
                        (1, 0x5555555555555555)):
        x = (x | x << np.uint64(shift)) & np.uint64(mask)
    return x


_ONES = np.array([bin(k).count("1") for k in range(16)], np.int32)


class Treap:
    """Cells of all levels, the root first. ``quarters`` holds four bits a cell (2 * row half + column half), ``most`` its maximum."""

    def __init__(self, height: int, quarters: np.ndarray, most: np.ndarray):
        self.height, self.quarters, self.most = height, quarters, most
        number = _ONES[quarters]
        self.next = 1 + np.cumsum(number, dtype=np.int32) - number  # quarters follow in the order of their cells

    @classmethod
    def build(cls, rows: np.ndarray, columns: np.ndarray, values: np.ndarray) -> Treap:
        height = max(1, int(max(rows.max(), columns.max())).bit_length())
        codes = spread(rows) << np.uint64(1) | spread(columns)
        order = np.argsort(codes)
        codes, values = codes[order], values[order]
        levels = [(np.zeros(len(codes), np.uint8), values)]
        for _ in range(height):
            parent = codes >> np.uint64(2)
            heads = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
            bits = np.left_shift(1, (codes & np.uint64(3)).astype(np.uint8)).astype(np.uint8)
            levels.append((np.bitwise_or.reduceat(bits, heads), np.maximum.reduceat(levels[-1][1], heads)))
            codes = parent[heads]
        return cls(height, *(np.concatenate([level[k] for level in levels[::-1]]) for k in (0, 1)))

    def differences(self) -> np.ndarray:
        """Each cell's maximum as what it lacks to its parent's; the root's own comes first."""
        parents = np.repeat(np.arange(len(self.quarters)), _ONES[self.quarters])
        return np.r_[self.most[:1], self.most[parents] - self.most[1:]]

    @classmethod
    def restored(cls, height: int, quarters: np.ndarray, lacking: np.ndarray) -> Treap:
        most, number, begin, end = lacking.astype(np.int32), _ONES[quarters], 0, 1
        while end < len(most):
            count = number[begin:end]
            after = end + int(count.sum())
            most[end:after] = np.repeat(most[begin:end], count) - most[end:after]
            begin, end = end, after
        return cls(height, quarters, most)

    def quarter(self, cells: np.ndarray, which: np.ndarray) -> np.ndarray:
        """The cell's quarter, -1 where it or the cell itself does not exist."""
        bits = self.quarters[cells]
        found = self.next[cells] + _ONES[bits & ((1 << which) - 1)]
        return np.where((cells >= 0) & (bits >> which & 1 == 1), found, -1)

    def best(self, rows: np.ndarray, weights: np.ndarray, most: int, least: int) -> list[tuple[int, int]]:
        """The highest (score, column) of columns: as many as ``most``, ties to the smaller column, none below ``least`` or 1."""
        found: list[tuple[int, int]] = []  # heap of (score, -column)
        floor = max(1, least)
        bound = np.array([int((weights * self.most[0]).sum())])
        level, start = np.zeros(1, np.int64), np.zeros(1, np.int64)
        cells = np.zeros((1, len(rows)), np.int64)
        while len(bound):
            if len(bound) > BATCH:
                order = np.argpartition(-bound, BATCH)
                taken, left = order[:BATCH], order[BATCH:]
            else:
                taken, left = np.arange(len(bound)), np.arange(0)
            row_half = rows >> (self.height - 1 - level[taken])[:, None] & 1
            parts = []
            for half in (0, 1):
                below = self.quarter(cells[taken], 2 * row_half + half)
                score = (np.where(below >= 0, self.most[below], 0) * weights).sum(axis=1)
                parts.append((score, level[taken] + 1, start[taken] + (half << (self.height - 1 - level[taken])), below))
            score, depth, first, below = (np.concatenate(x) for x in zip(*parts, strict=True))
            whole = (depth == self.height) & (score >= floor)
            for value, column in zip(score[whole].tolist(), first[whole].tolist(), strict=True):
                if len(found) < most:
                    heapq.heappush(found, (value, -column))
                else:
                    heapq.heappushpop(found, (value, -column))
            if len(found) == most:
                floor = max(floor, found[0][0])
            more, rest = (depth < self.height) & (score >= floor), left[bound[left] >= floor]
            bound, level, start = (np.r_[x[rest], y[more]] for x, y in ((bound, score), (level, depth), (start, first)))
            cells = np.concatenate([cells[rest], below[more]])
        return [(value, -column) for value, column in sorted(found, reverse=True)]


SHARD = "docs binary, terms binary, holders binary, row binary, quarters binary, most binary, height int"


def build_index(docs: DataFrame, stats: Corpus, path: str) -> DataFrame:
    """Write the shards of all documents that hold a term; one row per shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, held, postings = Terms(), [], 0

        def shard() -> pa.RecordBatch:
            ids = np.array([h[0] for h in held], np.int64)
            rank = np.argsort(ids, kind="stable")
            size = np.array([len(held[k][1]) for k in rank])
            tokens, tf = (np.concatenate([held[k][c] for k in rank]) for c in (1, 2))
            share = np.array([stats.length_share(int(held[k][2].sum())) for k in rank], np.int64)
            column = np.repeat(np.arange(len(rank)), size)
            impact = 1_000_000_000 * tf.astype(np.int64) // (1000 * tf.astype(np.int64) + 8 * share[column])
            terms, where, holders = np.unique(tokens, return_inverse=True, return_counts=True)
            row = np.empty(len(terms), np.int64)
            row[np.argsort(-holders, kind="stable")] = np.arange(len(terms))
            tree = Treap.build(row[where], column, impact)
            blobs = (ids[rank].astype("<i8").tobytes(), terms.astype("<u8").tobytes(), packed(holders), packed(row),
                     packed(tree.quarters), packed(tree.differences()))
            return pa.RecordBatch.from_arrays([*[pa.array([x], pa.binary()) for x in blobs], pa.array([tree.height], pa.int32())],
                                              names=[c.split()[0] for c in SHARD.split(", ")])

        for batch in batches:
            ids = batch.column("doc_id").fill_null(int(NO_ID)).to_pylist()
            for k, terms, counts in reader.counted(batch.column("text")):
                if len(terms):
                    held.append((ids[k], terms, counts))
                    postings += len(terms)
                    if postings >= SHARD_POSTINGS or len(held) >= SHARD_DOCUMENTS:
                        yield shard()
                        held, postings = [], 0
        if held:
            yield shard()

    docs.mapInArrow(run, SHARD).write.parquet(path)
    return docs.sparkSession.read.schema(SHARD).parquet(path)


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, np.ndarray]]]:
    """The items with their distinct terms, some at a time: blocks are dealt by hash, so the driver holds one of about BLOCK_TERMS terms."""
    reader = F.length(F.coalesce("text", F.lit("")))
    total = items.agg(F.coalesce(F.sum(reader), F.lit(0))).first()[0]
    number = max(1, -(-total // (4 * BLOCK_TERMS)))
    for block in range(number):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(number)) == block).toArrow().combine_chunks()
        if rows.num_rows:
            texts = rows.column("text").combine_chunks() if isinstance(rows.column("text"), pa.ChunkedArray) else rows.column("text")
            ids = rows.column("item_id").to_pylist()
            yield [(ids[k], terms) for k, terms, _ in Terms().counted(texts)]


def document_numbers(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """In how many documents each of the sorted terms of a block occurs."""
    shared = index.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for own, holders in zip(batch.column("terms").to_pylist(), batch.column("holders").to_pylist(), strict=True):
                own, holders = np.frombuffer(own, "<u8"), unpacked(holders)
                at = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
                total += np.where(own[at] == wanted, holders[at], 0)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    out = np.zeros(len(terms), np.int64)
    for at, n in index.select("terms", "holders").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n")).collect():
        out[at] = n
    return out


def probed(index: DataFrame, stats: Corpus, block: list[tuple[int | None, np.ndarray]], number: int, most: int) -> DataFrame:
    """(block, item, item_id, doc_id, score): the highest scores that each task's shards hold for each item of a block."""
    terms = np.unique(np.concatenate([t for _, t in block]))
    weight = np.array([stats.weight(int(df)) if df else 0 for df in document_numbers(index, terms)], np.int64)
    weighed = [(t, weight[np.searchsorted(terms, t)]) for _, t in block]
    shared = index.sparkSession.sparkContext.broadcast(([i for i, _ in block], [(t[w > 0], w[w > 0]) for t, w in weighed]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries = shared.value
        best: list[list[tuple[int, int]]] = [[] for _ in queries]  # (-score, doc_id)
        for batch in batches:
            for at in range(batch.num_rows):
                shard = {c: batch.column(c)[at].as_py() for c in batch.schema.names}
                docs, own, row = np.frombuffer(shard["docs"], "<i8"), np.frombuffer(shard["terms"], "<u8"), unpacked(shard["row"])
                tree = Treap.restored(shard["height"], unpacked(shard["quarters"]).astype(np.uint8), unpacked(shard["most"]))
                for k, (wanted, weights) in enumerate(queries):
                    place = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
                    here = own[place] == wanted
                    if not here.any():
                        continue
                    floor = -best[k][-1][0] if len(best[k]) == most else 0
                    found = tree.best(row[place[here]].astype(np.int64), weights[here], most, floor)
                    best[k] = sorted(best[k] + [(-score, int(docs[c])) for score, c in found])[:most]
        item = np.repeat(np.arange(len(best)), [len(b) for b in best])
        doc = [d if d != NO_ID else None for b in best for _, d in b]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(item), number, np.int64)), pa.array(item), pa.array([ids[k] for k in item], pa.int64()),
            pa.array(doc, pa.int64()), pa.array([-s for b in best for s, _ in b], pa.int64())],
            names=["block", "item", "item_id", "doc_id", "score"])

    return index.select("docs", "terms", "row", "height", "quarters", "most").mapInArrow(
        run, "block long, item long, item_id long, doc_id long, score long")


def ranked(spark: SparkSession, docs: DataFrame, items: DataFrame, most: int = 10) -> DataFrame:
    """The ``most`` highest-scoring documents of each item: (item_id, rank, doc_id, score).

    Terms are runs of digits, letters and characters beyond ASCII, A-Z as a-z; null texts have none. Scores are whole numbers, see ``Corpus``; a
    score of 0 is left out, equal ones go by ascending doc_id, a null doc_id comes last. Repeated documents rank one by one, repeated items
    each get their ranks. Items without terms, an empty table of items or of documents give no rows. Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    stats = corpus(docs)
    index = build_index(docs, stats, scratch_path(spark, "treap"))
    found = spark.createDataFrame([], "block long, item long, item_id long, doc_id long, score long")
    for number, block in enumerate(item_blocks(items)):
        if stats.documents:
            path = scratch_path(spark, "ranks")
            probed(index, stats, block, number, most).write.parquet(path)
            found = found.unionByName(spark.read.parquet(path))
    order = Window.partitionBy("block", "item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
