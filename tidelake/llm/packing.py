"""Best-fit packing of documents into sequences: partitions pack locally, underfull sequences merge up a tree."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidelake.llm import bpe
from tidelake.session import checkpointed

LENGTH = 2048
END_OF_TEXT = 0
#: Bytes of text encoded at once, which bounds a worker's arrays: they take many times a slice's size.
SLICE = 1 << 19
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class PieceEncoder(bpe.Encoder):
    """Pieces that a task has not met before go to tiktoken, which is given the vocabulary of the tokenizer file."""

    def __init__(self, merges: bpe.Merges):
        import public_tokenizers
        import tiktoken

        super().__init__(merges)
        tokens = {merges.data[a:b]: k for k, (a, b) in enumerate(zip(merges.offsets[:-1], merges.offsets[1:], strict=True)) if b > a}
        self.library = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tokens, special_tokens={})

    def pieces(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw, encode = data.tobytes(), self.library.encode_ordinary
        ids = [encode(raw[a:b].decode()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((x for some in ids for x in some), np.uint32, int(counts.sum())), counts


def _encoder(path: str):
    """The encoder class for a tokenizer file: tiktoken merges by id, which must be the order of the file's merges."""
    merges = bpe.read_merges(path)
    by_rank = merges.merged[np.argsort(merges.rank, kind="stable")]
    return merges, PieceEncoder if (np.diff(by_rank.astype(np.int64)) > 0).all() else bpe.Encoder


def encoded(encoder: bpe.Encoder, added: dict[bytes, int], data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows and the offsets of the rows among them; added tokens, the longest first, part a row into texts of their own."""
    pattern = re.compile(b"|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)))
    raw = data.tobytes()
    if not added or not pattern.search(raw):
        return encoder.encode(data, offsets)
    texts, tokens, rows = [], [], [0]
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        for m in pattern.finditer(raw, a, b):
            texts.append(raw[a:m.start()])
            tokens.append(added[m[0]])
            a = m.end()
        texts.append(raw[a:b])
        tokens.append(-1)
        rows.append(len(texts))
    cuts = np.r_[0, np.cumsum([len(x) for x in texts])]
    ids, at = encoder.encode(np.frombuffer(b"".join(texts), np.uint8), cuts)
    tokens = np.array(tokens, np.int64)
    closed = tokens >= 0
    ids = np.insert(ids, at[1:][closed], tokens[closed].astype(np.uint32))
    return ids, (at + np.r_[0, np.cumsum(closed)])[rows]


def token_pieces(docs: DataFrame, path: str, length: int = LENGTH, end: int = END_OF_TEXT) -> DataFrame:
    """Documents as ids plus an end token, cut into pieces: only longer ones, the first piece being the shorter one.

    Each row gives at least one piece, an empty or null text that of the end token alone. The file's added tokens that a
    text holds literally get their own ids, as in the tokenizers library's default setting.
    """
    merges, kind = _encoder(path)
    added = bpe.read_added(path)
    shared = docs.sparkSession.sparkContext.broadcast(vars(merges))  # plain arrays: workers may lack this package
    names = [c.split()[0] for c in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kind(bpe.Merges(**shared.value))
        for batch in batches:
            for first, last, data, offsets in bpe.slices(batch.column("text"), SLICE):
                ids, at = encoded(encoder, added, data, offsets)
                total = np.diff(at) + 1
                number = -(-total // length)
                row = np.repeat(np.arange(len(total)), number)
                piece = bpe.ragged(np.zeros(len(total), np.int64), number)
                head = total - (number - 1) * length
                start = np.where(piece == 0, 0, head[row] + (piece - 1) * length)
                size = np.where(piece == 0, head[row], length)
                tail = np.array([end], "<u4").tobytes()
                raw, begin = ids.astype("<u4").tobytes(), at[row] + start
                closing = piece == number[row] - 1
                crc = [zlib.crc32(tail, zlib.crc32(raw[4 * b:4 * (b + n - 1)])) if c else zlib.crc32(raw[4 * b:4 * (b + n)])
                       for b, n, c in zip(begin.tolist(), size.tolist(), closing.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(first, last - first).take(pa.array(row)), pa.array(piece.astype(np.int32)),
                    pa.array(start), pa.array(size), pa.array(crc, pa.int64())], names=names)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, PIECES)


def best_fit(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Best fit over sizes in decreasing order: bin and offset of each item."""
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    open_: list[list[int]] = [[] for _ in range(length + 1)]  # bins by room left
    rooms, n = 0, 0  # bit r: there is a bin with room r
    for k in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[k])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            at = open_[room].pop()
            if not open_[room]:
                rooms &= ~(1 << room)
        else:
            room, at, n = length, n, n + 1
        bins[k], offsets[k] = at, length - room
        left = room - size
        if left:
            open_[left].append(at)
            rooms |= 1 << left
    return bins, offsets


PACKED = PIECES + ", item long, unit long, offset long, fill long"


def _packed(rows: DataFrame, length: int) -> DataFrame:
    """One round: each partition packs its units, which are items or sequences of the round before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches).sort_by([("unit", "ascending"), ("offset", "ascending")])
        unit, offset = table["unit"].to_numpy(), table["offset"].to_numpy()
        _, first, inverse = np.unique(unit, return_index=True, return_inverse=True)
        fills = table["fill"].to_numpy()[first]
        bins, at = best_fit(fills, length)
        total = np.bincount(bins, weights=fills).astype(np.int64)
        leader = np.full(len(total), np.iinfo(np.int64).max)
        np.minimum.at(leader, bins, unit[first])
        new = {"unit": leader[bins][inverse], "offset": offset + at[inverse], "fill": total[bins][inverse]}
        yield from pa.table({n: pa.array(new[n]) if n in new else table[n] for n in table.column_names}).to_batches()

    return rows.mapInArrow(run, PACKED)


def packed(pieces: DataFrame, length: int = LENGTH, slack: int = 16, units_per_task: int = 50_000, rounds: int = 12) -> DataFrame:
    """Pack pieces into sequences of at most ``length`` ids: adds sequence_id and offset.

    Partitions pack their units best-fit, longest first. Sequences with at most ``slack`` ids of room, or less room than the
    shortest unit left, are done; the others are units of the next round, dealt anew to fewer partitions. The tree ends
    in one partition, or where a round saves less than 2 % of its units, so that no task ever holds more than about
    ``units_per_task`` units. Rows with equal values are items of their own; an empty table gives no rows.
    """
    spark = pieces.sparkSession
    rows = checkpointed(pieces.select("*", F.monotonically_increasing_id().alias("item"))).select(
        "*", F.col("item").alias("unit"), F.lit(0).cast("long").alias("offset"), F.col("length").alias("fill"))
    done = [rows.where(F.col("fill") >= length - slack)]
    open_ = rows.where(F.col("fill") < length - slack)
    units = open_.count()
    for level in range(rounds):
        if not units:
            break
        parts = -(-units // units_per_task)
        dealt = open_.repartition(parts, F.xxhash64("unit", F.lit(level)))
        now = checkpointed(_packed(dealt, length))
        heads = now.where(F.col("unit") == F.col("item"))
        shortest = heads.agg(F.min("fill")).first()[0]
        full = F.col("fill") > length - max(slack + 1, shortest)
        left = heads.where(~full).count()
        total = heads.count()
        if parts == 1 and total == units or left < 2 or total > 0.98 * units or level == rounds - 1:
            done.append(now)
            break
        done.append(now.where(full))
        open_, units = now.where(~full), left
    out = done[0]
    for some in done[1:]:
        out = out.unionByName(some)
    return out.select(*[c.split()[0] for c in PIECES.split(", ")], F.col("unit").alias("sequence_id"), "offset")
