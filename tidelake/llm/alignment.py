"""Alignment of the tokens that two tokenizers make of the same text.

Tokens are byte ranges of one text. All documents of a slice are merged in lockstep: a state vector holds one pointer into the tokens of
A and one into those of B for each document, a step links the two current tokens of every document and advances whichever ends
first, both where they end together, which is a cut. Documents that reach their end leave the vector. A long document takes several
places of the vector: it is parted where a token of B happens to end with every so-many-th token of A.

How often an id pair is linked in the whole corpus is counted per chunk of documents first. A chunk keeps its distinct pairs once and
its documents refer to them by number, so totals come back to documents by one join of (chunk, pair) rows, never by a row per link.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidelake.llm import bpe, packing
from tidelake.llm.common import resource
from tidelake.llm.textbytes import slices
from tidelake.session import scratch_path

#: Tokens of A to a place of the state vector, and links to a chunk.
LANE = 256
CHUNK_LINKS = 4_000_000
SLICE = 1 << 20


@dataclass(frozen=True)
class Sides:
    """Ids and byte ends (global in the slice) of both sides, and the rows' offsets among them; rows that differ have none."""
    a: np.ndarray
    b: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    a_rows: np.ndarray
    b_rows: np.ndarray


class PieceModel:
    """A sentencepiece model: its pieces as bytes, and the ids of texts."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=resource(path))
        tokens = [bytes([int(p[3:5], 16)]) if self.model.is_byte(k) else p.replace("▁", " ").encode()
                  for k, p in enumerate(map(self.model.id_to_piece, range(self.model.vocab_size())))]
        self.offsets = np.r_[0, np.cumsum([len(t) for t in tokens])].astype(np.int64)
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.model.encode(texts, num_threads=1)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        ids = [np.array(x, np.int64) for x in found]
        return np.concatenate(ids) if ids else np.empty(0, np.int64), np.r_[0, np.cumsum(counts)]


class Aligner:
    def __init__(self, merges: bpe.Merges, encoder: type[bpe.Encoder], piece_path: str):
        self.a, self.b = encoder(merges), PieceModel(piece_path)
        self.sizes = np.diff(merges.offsets)
        self.width = len(self.b.offsets) - 1  # a pair is a * width + b
        number = lambda sep, n: [f"{sep}{k}".encode() for k in range(n)]
        self.shown = number(",", len(self.sizes)) + number(";", len(self.sizes)) + number(",", self.width) + number("|", self.width)

    def sides(self, texts: pa.Array) -> Sides:
        """Tokens of space + text by A, and of text by B, which adds the space; rows whose bytes do not agree get none."""
        plain = [t or "" for t in texts.to_pylist()]
        spaced = [b" " + t.encode() if t else b"" for t in plain]
        size = np.fromiter(map(len, spaced), np.int64, len(spaced))
        data, rows = np.frombuffer(b"".join(spaced), np.uint8), np.r_[0, np.cumsum(size)]
        a, a_rows = self.a.encode(data, rows)
        b, b_rows = self.b.encode(plain)
        a = a.astype(np.int64)
        b_sizes = np.diff(self.b.offsets)[b]
        total = np.r_[0, np.cumsum(b_sizes)][b_rows]
        fits = np.diff(total) == size
        same = self.b.data[bpe.ragged(self.b.offsets[b], b_sizes)]
        if not (fits.all() and np.array_equal(same, data)):
            fits &= [np.array_equal(same[p:q], data[r:s]) for p, q, r, s in zip(total[:-1], total[1:], rows[:-1], rows[1:], strict=True)]
        fits &= size > 0
        keep_a, keep_b = np.repeat(fits, np.diff(a_rows)), np.repeat(fits, np.diff(b_rows))
        counted = lambda r: np.r_[0, np.cumsum(np.where(fits, np.diff(r), 0))]
        return Sides(a[keep_a], b[keep_b], np.cumsum(self.sizes[a[keep_a]]), np.cumsum(b_sizes[keep_b]), counted(a_rows), counted(b_rows))


def lanes(s: Sides) -> tuple[np.ndarray, np.ndarray]:
    """Where the places of the state vector begin on either side; both sides begin a token at the same byte there."""
    first, last = s.a_rows[:-1], s.a_rows[1:]
    filled = last > first
    number = np.maximum(0, (last - first - 1) // LANE)
    wanted = np.repeat(first, number) + (bpe.ragged(np.zeros(len(number), np.int64), number) + 1) * LANE - 1
    end = np.repeat(last, number)
    found_a, found_b = [], []
    while len(wanted):  # the next token of A that ends with a token of B
        at = np.searchsorted(s.b_ends, s.a_ends[wanted])
        cut = s.b_ends[np.minimum(at, len(s.b_ends) - 1)] == s.a_ends[wanted]
        found_a.append(wanted[cut] + 1)
        found_b.append(at[cut] + 1)
        wanted, end = wanted[~cut] + 1, end[~cut]
        wanted, end = wanted[wanted < end], end[wanted < end]
    every = np.unique(np.concatenate([first[filled], *found_a])), np.unique(np.concatenate([s.b_rows[:-1][filled], *found_b]))
    return every[0][every[0] < len(s.a)], every[1][every[1] < len(s.b)]


def lockstep(s: Sides) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All links (token of A, token of B), and the last tokens of A and of B before each cut, in order of the text."""
    if not len(s.a):
        return (np.empty(0, np.int64),) * 4
    i, j = lanes(s)
    stop = np.r_[i[1:], len(s.a)]
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(i):
        x, y = s.a_ends[i], s.b_ends[j]
        links_a.append(i)
        links_b.append(j)
        cut = x == y
        cuts_a.append(i[cut])
        cuts_b.append(j[cut])
        i, j = i + (x <= y), j + (y <= x)
        live = i < stop  # both sides end together
        if not live.all():
            i, j, stop = i[live], j[live], stop[live]
    return np.concatenate(links_a), np.concatenate(links_b), np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


def group_texts(aligner: Aligner, s: Sides, cuts_a: np.ndarray, cuts_b: np.ndarray) -> list[bytes]:
    """Each row's groups as text: ids of A, a bar, ids of B; groups are parted by semicolons."""
    size_a, size_b = np.diff(cuts_a, prepend=-1), np.diff(cuts_b, prepend=-1)
    na, nb = len(aligner.sizes), aligner.width
    keys = np.empty(len(s.a) + len(s.b), np.int64)
    opens_a, opens_b = np.zeros(len(s.a), bool), np.zeros(len(s.b), bool)
    opens_a[cuts_a - size_a + 1], opens_b[cuts_b - size_b + 1] = True, True
    keys[np.arange(len(s.a)) + np.repeat(cuts_b - size_b + 1, size_a)] = s.a + na * opens_a
    keys[np.arange(len(s.b)) + np.repeat(cuts_a + 1, size_b)] = s.b + 2 * na + nb * opens_b
    rows, shown = (s.a_rows + s.b_rows).tolist(), aligner.shown
    parts = [shown[k] for k in keys.tolist()]
    return [b"".join(parts[p:q])[1:] for p, q in zip(rows[:-1], rows[1:], strict=True)]


def packed(values: np.ndarray) -> bytes:
    """Whole numbers below 2^32 as compressed byte planes."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
    return len(values).to_bytes(4, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:4], "little")
    planes = pa.decompress(blob[4:], decompressed_size=4 * n, codec="zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, n).T).view("<u4").ravel()


def _aligner(docs: DataFrame, a_path: str, b_path: str):
    merges, kind = packing._encoder(a_path)
    shared = docs.sparkSession.sparkContext.broadcast(vars(merges))  # its size depends on the vocabulary only
    return lambda: Aligner(bpe.Merges(**shared.value), kind, b_path)


def _own(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def alignments(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Each row's tokens, links and cuts: (doc_id, a_ids, b_ids, link_a, link_b, cut_a, cut_b).

    Links are pairs of token positions in the order of the text; a cut is the number of tokens of A and of B before it. Null and
    empty texts, and those that either side does not give back byte by byte, have empty lists. One row per row, repeated ones too.
    """
    make = _aligner(docs, a_path, b_path)
    names = "a_ids b_ids link_a link_b cut_a cut_b".split()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = make()
        for batch in batches:
            for first, end, _, _ in slices(batch.column("text"), SLICE):
                s = aligner.sides(batch.column("text").slice(first, end - first))
                link_a, link_b, cut_a, cut_b = lockstep(s)
                order = np.lexsort((link_b, link_a))
                link_a, link_b = link_a[order], link_b[order]
                links, cuts = np.searchsorted(link_a, s.a_rows), np.searchsorted(cut_a, s.a_rows)
                per_link, per_cut = (np.repeat(np.arange(end - first), np.diff(x)) for x in (links, cuts))
                lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x.astype(np.int64))) for at, x in (
                    (s.a_rows, s.a), (s.b_rows, s.b), (links, link_a - s.a_rows[per_link]), (links, link_b - s.b_rows[per_link]),
                    (cuts, cut_a + 1 - s.a_rows[per_cut]), (cuts, cut_b + 1 - s.b_rows[per_cut]))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, end - first), *lists], names=["doc_id", *names])

    return _own(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"{c} array<long>" for c in names))


DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
CHUNKED = f"chunk string, {DOCUMENT}, held binary, times binary, pairs array<long>, counts array<long>"


def _chunks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Rows of documents, whose pairs are numbers within their chunk, and one row with the distinct pairs of each chunk."""
    make = _aligner(docs, a_path, b_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        aligner, task, number = make(), TaskContext.get().partitionId(), 0
        waiting: list[tuple] = []  # (columns of the documents, bounds of the rows, pairs, times) of each slice
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal waiting, held, number
            pairs, where = np.unique(np.concatenate([w[2] for w in waiting]), return_inverse=True)
            times = np.concatenate([w[3] for w in waiting])
            counts = np.bincount(where, times, len(pairs)).astype(np.int64)
            blobs, at = [], 0
            for _, bounds, own, _ in waiting:
                for p, q in zip(bounds[:-1], bounds[1:], strict=True):
                    blobs.append((packed(np.diff(where[at + p:at + q], prepend=0)), packed(times[at + p:at + q])))
                at += len(own)
            n = len(blobs)
            columns = [pa.concat_arrays([*(w[0][k] for w in waiting), pa.nulls(1, w0.type)]) for k, w0 in enumerate(waiting[0][0])]
            lists = [pa.ListArray.from_arrays(pa.array([*[0] * (n + 1), len(x)], pa.int32()), pa.array(x),
                                              mask=pa.array([*[True] * n, False])) for x in (pairs, counts)]
            name = f"{task}-{number}"
            waiting, held, number = [], 0, number + 1
            return pa.RecordBatch.from_arrays([pa.array([name] * (n + 1)), *columns, pa.array([x for x, _ in blobs] + [None], pa.binary()),
                                               pa.array([x for _, x in blobs] + [None], pa.binary()), *lists],
                                              names=[c.split()[0] for c in CHUNKED.split(", ")])

        for batch in batches:
            for first, end, _, _ in slices(batch.column("text"), SLICE):
                s = aligner.sides(batch.column("text").slice(first, end - first))
                link_a, link_b, cut_a, cut_b = lockstep(s)
                digests = [hashlib.sha256(t).hexdigest() if t else "" for t in group_texts(aligner, s, cut_a, cut_b)]
                row = np.repeat(np.arange(end - first), np.diff(s.a_rows))[link_a]
                span = len(aligner.sizes) * aligner.width
                keys, times = np.unique(row * span + s.a[link_a] * aligner.width + s.b[link_b], return_counts=True)
                bounds = np.searchsorted(keys, np.arange(end - first + 1) * span)
                columns = [batch.column("doc_id").slice(first, end - first), *map(pa.array, (
                    np.diff(s.a_rows), np.diff(s.b_rows), np.diff(np.searchsorted(cut_a, s.a_rows)), np.bincount(row, minlength=end - first))),
                    pa.array(digests, pa.string())]
                waiting.append((columns, bounds, keys % span, times))
                held += len(keys)
                if held >= CHUNK_LINKS:
                    yield flush()
        if waiting:
            yield flush()

    return _own(docs).mapInArrow(run, CHUNKED)


def counted(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Each row's numbers of tokens, groups and links, and what the corpus-wide counts of its linked id pairs say.

    ``n_best`` is the number of links whose count is the highest that their B id has in the corpus, ``count_sum`` the sum of the counts over
    the links. Null and empty texts, and those that either side does not give back byte by byte, have zeros and an empty
    digest. One row per row, repeated ones too, which count as often as they occur; a null doc_id stays null; other columns are not read.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "alignment")
    _chunks(docs, a_path, b_path).write.parquet(path)
    stored = spark.read.schema(CHUNKED).parquet(path)
    width = PieceModel(b_path).offsets.size - 1
    each = stored.where(F.col("pairs").isNotNull()).select("chunk", "counts", F.posexplode("pairs").alias("at", "pair")).select(
        "chunk", "at", "pair", F.element_at("counts", F.col("at") + 1).alias("n"))
    totals = each.groupBy("pair").agg(F.sum("n").alias("total"))
    of_b = Window.partitionBy(F.pmod("pair", F.lit(width)))
    totals = totals.select(F.col("pair").alias("of"), "total", (F.col("total") == F.max("total").over(of_b)).alias("best"))
    back = each.select("chunk", "at", "pair").join(totals, F.col("pair") == F.col("of")).select("chunk", "at", "total", "best").withColumnRenamed("chunk", "of_chunk")
    names = [c.split()[0] for c in DOCUMENT.split(", ")]

    def rate(documents: pa.Table, counts: pa.Table) -> pa.Table:
        order = np.argsort(counts["at"].to_numpy())
        total, best = counts["total"].to_numpy()[order], counts["best"].to_numpy()[order]
        n_best, count_sum = [], []
        for held, times in zip(documents["held"].to_pylist(), documents["times"].to_pylist(), strict=True):
            at, n = np.cumsum(unpacked(held), dtype=np.int64), unpacked(times).astype(np.int64)
            n_best.append(int(n[best[at]].sum()))
            count_sum.append(int((n * total[at]).sum()))
        return documents.select(names).append_column("n_best", pa.array(n_best, pa.int64())).append_column(
            "count_sum", pa.array(count_sum, pa.int64()))

    own = stored.where(F.col("pairs").isNull()).select("chunk", *names, "held", "times")
    return own.groupBy("chunk").cogroup(back.groupBy("of_chunk")).applyInArrow(rate, f"{DOCUMENT}, n_best long, count_sum long")
