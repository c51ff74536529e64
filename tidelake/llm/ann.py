"""Approximate nearest neighbours by an inverted multi-index: two codebooks for the two halves of a vector."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tidelake.session import checkpointed


@dataclass(frozen=True)
class Codebooks:
    """Centroids of the first and of the second half of the components."""
    first: np.ndarray
    second: np.ndarray

    @property
    def cells(self) -> int:
        return len(self.first) * len(self.second)

    @property
    def width(self) -> int:
        return self.first.shape[1] + self.second.shape[1]

    def cell(self, x: np.ndarray) -> np.ndarray:
        """Cell of each row: the nearest centroid of either half."""
        own = []
        for half, book in ((x[:, :self.first.shape[1]], self.first), (x[:, self.first.shape[1]:], self.second)):
            own.append(((book ** 2).sum(1) - 2 * half @ book.T).argmin(1))
        return own[0] * len(self.second) + own[1]

    def traverse(self, q: np.ndarray, counts: np.ndarray, least: int) -> list[int]:
        """Cells in order of summed distance (minus the inner product of either half), until they hold ``least`` entries.

        Both halves' centroids are sorted; a heap holds the frontier of pairs, each of which is pushed once both its
        predecessors are done. Empty cells are passed over.
        """
        costs = [-(self.first @ q[:self.first.shape[1]]), -(self.second @ q[self.first.shape[1]:])]
        orders = [np.argsort(c, kind="stable").tolist() for c in costs]
        a, b = (c[o].tolist() for c, o in zip(costs, orders, strict=True))
        rows, columns = len(a), len(b)
        reached, held, out = [0] * rows, 0, []  # reached[i]: done pairs of row i, always its first ones
        heap = [(a[0] + b[0], 0, 0)]
        while heap and held < least:
            _, i, j = heapq.heappop(heap)
            reached[i] = j + 1
            cell = orders[0][i] * columns + orders[1][j]
            if n := int(counts[cell]):
                held += n
                out.append(cell)
            if j + 1 < columns and (i == 0 or reached[i - 1] > j + 1):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
            if i + 1 < rows and reached[i + 1] == j:
                heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
        return out


def centroids(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's algorithm from distinct rows; fewer rows than ``k`` give fewer centroids."""
    distinct = np.unique(x, axis=0)
    book = distinct[rng.permutation(len(distinct))[:k]].copy()
    for _ in range(rounds):
        near = ((book ** 2).sum(1) - 2 * x @ book.T).argmin(1)
        for c in range(len(book)):
            if (own := near == c).any():
                book[c] = x[own].mean(0)
    return book


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not zero, no null or non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) of the rows that take part; an id given more than once counts once, with its least vector."""
    own = rows.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    return own.where(F.col("id").isNotNull() & usable(F.col("v"))).groupBy("id").agg(F.min("v").alias("v"))


def fit(rows: DataFrame, centers: int = 32, sample: int = 20_000, rounds: int = 8, seed: int = 1) -> Codebooks | None:
    """Codebooks from at most about ``sample`` vectors, taken by a hash of their id; all vectors are indexed later.

    Vectors of a width other than the most frequent one take no part. No vectors give no codebooks.
    """
    widths = rows.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").first()
    if widths is None:
        return None
    width, n = widths["w"], widths["count"]
    share = int((1 << 20) * min(1.0, sample / n)) + 1
    taken = rows.where((F.size("v") == width) & (F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 20)) < share)).select("id", "v")
    x = np.array([r["v"] for r in sorted(taken.collect())], np.float64).reshape(-1, width)
    if not len(x):
        x = np.array([rows.where(F.size("v") == width).first()["v"]], np.float64)
    rng, half = np.random.default_rng(seed), width // 2
    return Codebooks(centroids(x[:, :half], centers, rounds, rng), centroids(x[:, half:], centers, rounds, rng))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, width)


def indexed(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(id, v, cell) of every vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = books.cell(matrix(batch.column("v"), books.width)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(cell)], names=["id", "v", "cell"])

    return rows.where(F.size("v") == books.width).mapInArrow(run, "id long, v array<double>, cell int")


def bundles(counts: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """First bundle and number of bundles of each cell: neighbouring cells share one, a large cell is spread over several."""
    before = np.cumsum(counts) - counts
    first = before // entries
    return first.astype(np.int32), np.maximum(1, -(-counts // entries)).astype(np.int32)


def nearest(rows: DataFrame, queries: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", share: float = 0.6,
            centers: int = 32, bundle: int = 4096, block: int = 512) -> DataFrame:
    """(query_id, rank, neighbour, score): the k vectors of largest inner product found for each query, itself left out.

    ``queries`` is a condition on a column named id. A query visits cells in order of summed distance until they hold
    ``share`` of all entries (and k + 1 at least); those are scored exactly, in double precision, and ties go to smaller
    ids. Cells are stored in bundles of about ``bundle`` vectors, a cell that holds a third of all vectors in many; queries
    go in blocks to the bundles they visit. A task holds one bundle and one block, so both bounds are those of its memory.
    """
    spark = rows.sparkSession
    given = checkpointed(vectors(rows, key, vector))
    schema = "query_id long, rank int, neighbour long, score double"
    books = fit(given, centers)
    if books is None:
        return spark.createDataFrame([], schema)
    own = checkpointed(indexed(given, books))
    counts = np.zeros(books.cells, np.int64)
    for cell, n in own.groupBy("cell").count().collect():  # one row per cell, whatever the number of vectors
        counts[cell] = n
    total = int(counts.sum())
    first, parts = bundles(counts, bundle)
    least = max(k + 1, int(np.ceil(share * total)))
    width, cells = books.width, books.cells

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            to, marks = [], []
            for v in matrix(batch.column("v"), width) if batch.num_rows else []:
                seen = books.traverse(v, counts, least)
                to.append(sorted({int(x) for c in seen for x in range(first[c], first[c] + parts[c])}))
                mask = np.zeros(cells, bool)
                mask[seen] = True
                marks.append(np.packbits(mask).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), batch.column("block"),
                                              pa.array(to, pa.list_(pa.int32())), pa.array(marks, pa.binary())],
                                             names=["id", "v", "block", "to", "cells"])

    asked = own.where(queries)
    blocks = max(1, -(-asked.count() // block))
    asked = asked.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"))
    visits = checkpointed(asked.repartition("id").mapInArrow(
        visit, "id long, v array<double>, block int, to array<int>, cells binary"))
    sent = visits.select("id", "v", "block", "cells", F.explode("to").alias("bundle"))
    tables = spark.createDataFrame([(c, int(first[c]), int(parts[c])) for c in range(cells)], "of int, first int, parts int")
    # two codebooks make a fixed number of cells, which bounds this broadcast
    stored = own.join(F.broadcast(tables), F.col("cell") == F.col("of")).select(
        "id", "v", "cell", (F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int").alias("bundle"))
    needed = visits.select(F.col("block").alias("for_block"), F.explode("to").alias("for_bundle")).distinct()
    copies = stored.join(needed, F.col("bundle") == F.col("for_bundle")).select("id", "v", "cell", "for_block", "for_bundle")

    def score(group: tuple, asked: pa.Table, there: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if asked.num_rows and there.num_rows:
            q, x = (matrix(t["v"].combine_chunks(), width) for t in (asked, there))
            ids, cell = there["id"].to_numpy(), there["cell"].to_numpy()
            order = np.lexsort((ids, cell))
            x, ids, cell = x[order], ids[order], cell[order]
            marks = np.unpackbits(np.frombuffer(b"".join(asked["cells"].to_pylist()), np.uint8).reshape(len(q), -1), axis=1)
            visited = marks[:, cell].astype(bool)
            for row, (me, v) in enumerate(zip(asked["id"].to_numpy(), q, strict=True)):
                at = np.flatnonzero(visited[row] & (ids != me))
                rough = x[at] @ v
                if len(at) > k:
                    edge = np.partition(rough, len(rough) - k)[len(rough) - k]
                    at = at[rough >= edge - 1e-9 * max(1.0, abs(edge))]
                exact = (x[at] * v).sum(axis=1)  # in one order for all, so that equal vectors have equal scores
                best = np.lexsort((ids[at], -exact))[:k]
                out.append((np.full(len(best), me), ids[at][best], exact[best]))
        a, b, c = (np.concatenate(z) for z in zip(*out, strict=True)) if out else (np.empty(0, np.int64),) * 2 + (np.empty(0),)
        return pa.table({"query_id": pa.array(a, pa.int64()), "neighbour": pa.array(b, pa.int64()), "score": pa.array(c, pa.float64())})

    found = sent.groupBy("block", "bundle").cogroup(copies.groupBy("for_block", "for_bundle")).applyInArrow(
        score, "query_id long, neighbour long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "neighbour"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "neighbour", "score")
