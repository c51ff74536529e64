"""Byte-level BPE in numpy: pieces of a text, padded matrices of pieces, one merge per row and round, decoding."""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidelake.llm.common import resource
from tidelake.llm.textbytes import Powers, byte_values, segment_hashes, slices

NONE = np.uint32(0xFFFFFFFF)
SLICE = 1 << 21
#: Rows of longer pieces are kept apart, since a matrix costs the square of its width (see Encoder.long_piece).
WIDE = 64
#: Cells of one padded matrix, and pieces whose ids a task remembers before it starts anew.
CELLS = 1 << 20
REMEMBERED = 1 << 20

# Code points with Unicode's White_Space property.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SPACE, LETTER, NUMBER, OTHER = range(4)


@dataclass(frozen=True)
class Merges:
    """A vocabulary as arrays: pairs of ids with rank and merged id, the id of each byte, the bytes of each id."""
    left: np.ndarray
    right: np.ndarray
    rank: np.ndarray
    merged: np.ndarray
    bytes_ids: np.ndarray
    offsets: np.ndarray
    data: bytes


def _vocabulary(tokens: dict[bytes, int], pairs: list[tuple[int, int, int, int]]) -> Merges:
    size = max(tokens.values()) + 1
    by_id: list[bytes] = [b""] * size
    for token, at in tokens.items():
        by_id[at] = token
    table = np.array(pairs, np.int64).reshape(-1, 4)
    return Merges(table[:, 0].astype(np.uint32), table[:, 1].astype(np.uint32), table[:, 2].astype(np.uint32),
                  table[:, 3].astype(np.uint32), np.array([tokens[bytes([b])] for b in range(256)], np.uint32),
                  np.r_[0, np.cumsum([len(t) for t in by_id])].astype(np.int64), b"".join(by_id))


def read_ranks(path: str) -> Merges:
    """A rank file: a line per token, base64 and rank. Any two tokens whose bytes make a token merge, at its rank."""
    tokens = {base64.b64decode(a): int(b) for a, b in map(bytes.split, resource(path).splitlines()) if a}
    pairs = [(tokens[t[:k]], tokens[t[k:]], rank, rank) for t, rank in tokens.items() for k in range(1, len(t))
             if t[:k] in tokens and t[k:] in tokens]
    return _vocabulary(tokens, pairs)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself where printable, else the next from 256 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def read_merges(path: str) -> Merges:
    """A tokenizer file in JSON: vocabulary by letters, and merges in order of rank."""
    model = json.loads(resource(path))["model"]
    letters = byte_letters()
    vocab = model["vocab"]
    tokens = {bytes(letters[c] for c in token): at for token, at in vocab.items() if all(c in letters for c in token)}
    pairs = []
    for rank, merge in enumerate(model["merges"]):
        a, b = merge.split(" ") if isinstance(merge, str) else merge
        pairs.append((vocab[a], vocab[b], rank, vocab[a + b]))
    return _vocabulary(tokens, pairs)


def read_added(path: str) -> dict[bytes, int]:
    """The added tokens of a tokenizer file in JSON, which match in a text before its pieces are found, and their ids."""
    added = json.loads(resource(path)).get("added_tokens", [])
    if any(token.get(flag) for token in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens that match by more than their content are not read")
    return {token["content"].encode(): token["id"] for token in added}


class PairTable:
    """Open addressing over pairs of ids; misses give NONE."""

    def __init__(self, merges: Merges):
        bits = max(10, int(len(merges.left) * 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.uint64((1 << bits) - 1)
        keys = merges.left.astype(np.uint64) << np.uint64(32) | merges.right
        self.keys = np.full(1 << bits, 2**64 - 1, np.uint64)
        self.rows = np.zeros(1 << bits, np.uint32)
        self.rank, self.merged = merges.rank, merges.merged
        todo, at = np.arange(len(keys)), self._home(keys)
        while len(todo):
            spot, first = np.unique(np.where(self.keys[at] == 2**64 - 1, at.astype(np.int64), -1), return_index=True)
            first = first[spot >= 0]
            self.keys[at[first]] = keys[todo[first]]
            self.rows[at[first]] = todo[first]
            left = np.ones(len(todo), bool)
            left[first] = False
            todo, at = todo[left], (at[left] + np.uint64(1)) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Row of each pair among the merges, or NONE."""
        keys = left.astype(np.uint64) << np.uint64(32) | right
        at = self._home(keys)
        out = np.full(len(keys), NONE, np.uint32)
        open_ = np.arange(len(keys))
        while len(open_):
            there = self.keys[at]
            hit = there == keys[open_]
            out[open_[hit]] = self.rows[at[hit]]
            more = ~hit & (there != np.uint64(2**64 - 1))
            open_, at = open_[more], (at[more] + np.uint64(1)) & self.mask
        return out

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        rows = self.find(left, right)
        return np.where(rows == NONE, NONE, self.rank[np.minimum(rows, len(self.rank) - 1)])


class Encoder:
    def __init__(self, merges: Merges):
        self.merges, self.pairs = merges, PairTable(merges)
        self.by_rank = np.zeros(int(merges.rank.max()) + 1 if len(merges.rank) else 1, np.uint32)
        self.by_rank[merges.rank] = merges.merged
        # a rank whose token takes part in no pair of lower rank: merging it cannot make a better pair
        least = np.full(len(merges.offsets), NONE, np.uint32)
        for part in (merges.left, merges.right):
            np.minimum.at(least, part, merges.rank)
        self.final = least[self.by_rank] > np.arange(len(self.by_rank))
        self.lookup: dict[int, int] = {}
        self.classes = code_point_classes()
        self.values, self.powers = byte_values(False), Powers()
        self.forget()

    def forget(self) -> None:
        self.known = np.empty(0, np.uint64)
        self.known_first = np.empty(0, np.int64)
        self.known_size = np.empty(0, np.int64)
        self.known_ids = np.empty(0, np.uint32)

    def bucket(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Encode a matrix whose rows are pieces of one length, as byte ids: (ids padded with NONE, their numbers)."""
        n, width = ids.shape
        out, sizes = ids.copy(), np.full(n, width)
        rows, ids = np.arange(n), ids.copy()
        rank = self.pairs.ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        columns = np.arange(width)
        while len(rows):
            at = rank.argmin(axis=1)
            least = rank[np.arange(len(rows)), at]
            done = least == NONE
            if done.any():
                out[rows[done], :ids.shape[1]] = ids[done]
                out[rows[done], ids.shape[1]:] = NONE
                rows, ids, rank, at, least = (x[~done] for x in (rows, ids, rank, at, least))
                if not len(rows):
                    break
            # compaction: each row drops the column right of its merge
            line, width = np.arange(len(rows)), ids.shape[1]
            ids[line, at] = self.by_rank[least]
            source = columns[:width - 1] + (columns[:width - 1] > at[:, None])
            ids = np.take_along_axis(ids, source, axis=1)
            sizes[rows] -= 1
            if width == 2:
                out[rows, 0], out[rows, 1:] = ids[:, 0], NONE
                break
            gone = columns[:width - 2] + (columns[:width - 2] >= at[:, None])
            rank = np.take_along_axis(rank, gone, axis=1)
            for near, lone in ((at - 1, at > 0), (at, at < width - 2)):
                r, c = line[lone], near[lone]
                right = ids[r, c + 1]
                found = self.pairs.ranks(ids[r, c], np.where(right == NONE, 0, right))
                rank[r, c] = np.where(right == NONE, NONE, found)
        return out, (out != NONE).sum(axis=1)

    def long_piece(self, ids: np.ndarray) -> np.ndarray:
        """Encode one long piece: its ranks by place, and the places of each rank; a merge renews only the ranks beside it.

        All occurrences of the minimum rank merge at once where none can make a better pair, else one after another. Work grows with
        the length and, for each rank that occurs, with one round.
        """
        n = len(ids)
        after, before = np.arange(1, n + 1), np.arange(-1, n)  # of the merged ids that are left; n and -1 are the ends
        rank, left = np.full(n, NONE, np.uint32), np.ones(n, bool)
        places: dict[int, list[np.ndarray]] = {}
        waiting: list[int] = []

        def renew(at: np.ndarray) -> None:
            rank[at] = found = self.pairs.ranks(ids[at], ids[after[at]])
            at, found = at[found != NONE], found[found != NONE]
            order = np.argsort(found, kind="stable")
            at, found = at[order], found[order]
            first = np.flatnonzero(np.r_[True, found[1:] != found[:-1]]) if len(at) else at
            for value, low, high in zip(found[first].tolist(), first.tolist(), [*first[1:].tolist(), len(at)], strict=False):
                if value not in places:
                    places[value] = []
                    heapq.heappush(waiting, value)
                places[value].append(at[low:high])

        renew(np.arange(n - 1))
        while waiting:
            least = heapq.heappop(waiting)
            at = np.unique(np.concatenate(places.pop(least)))
            at = at[rank[at] == least]
            if not len(at):
                continue
            if self.final[least]:
                run = np.r_[True, after[at[:-1]] != at[1:]]
                place = np.arange(len(at))
                at = at[(place - place[run][np.cumsum(run) - 1]) % 2 == 0]  # of overlapping pairs, every other one from the left
            else:
                renew(self.one_by_one(at, least, ids, rank, after, before, left))
                continue
            gone = after[at]
            ids[at], rank[gone], left[gone] = self.by_rank[least], NONE, False
            after[at] = after[gone]
            before[after[at]] = at
            rank[at] = NONE
            beside = np.unique(np.concatenate([at, before[at]]))
            renew(beside[(beside >= 0) & (after[np.maximum(beside, 0)] < n)])
        return ids[left]

    def one_by_one(self, at: np.ndarray, least: int, ids: np.ndarray, rank: np.ndarray, after: np.ndarray, before: np.ndarray,
                   left: np.ndarray) -> np.ndarray:
        """Merge the places of a rank from the left, better pairs that come up first; returns the places whose rank to renew."""
        if not self.lookup:
            keys = (self.merges.left.astype(np.uint64) << np.uint64(32) | self.merges.right).tolist()
            self.lookup = dict(zip(keys, self.merges.rank.tolist(), strict=True))
        none, n, later = int(NONE), len(ids), set()
        todo = [(least, place) for place in at.tolist()]
        while todo:
            value, place = heapq.heappop(todo)
            if not left[place] or rank[place] != value:
                continue
            gone, end = int(after[place]), int(after[after[place]])
            ids[place], rank[gone], left[gone], after[place], before[end] = self.by_rank[value], NONE, False, end, place
            rank[place] = NONE
            for one in (int(before[place]), place):
                if one < 0 or after[one] == n:
                    continue
                rank[one] = found = self.lookup.get(int(ids[one]) << 32 | int(ids[after[one]]), none)
                if found <= least:
                    heapq.heappush(todo, (found, one))
                elif found != none:
                    later.add(one)
        found = np.array(sorted(later), np.int64)
        return found[left[found] & (after[found] < n)]

    def pieces(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces: all ids, and the number of each piece's."""
        size = ends - starts
        counts = np.ones(len(size), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        order = np.argsort(size, kind="stable")
        bounds = np.flatnonzero(np.diff(size[order])) + 1
        for group in np.split(order, bounds) if len(order) else []:
            width = int(size[group[0]])
            if width > WIDE:
                for k in group:
                    ids = self.long_piece(self.merges.bytes_ids[data[starts[k]:ends[k]]].copy())
                    counts[k] = len(ids)
                    parts.append((np.array([k]), ids))
                continue
            for some in np.array_split(group, -(-len(group) * width // CELLS)):
                ids = self.merges.bytes_ids[data[starts[some][:, None] + np.arange(width)]]
                if width > 1:
                    ids, counts[some] = self.bucket(ids)
                parts.append((some, ids[ids != NONE]))
        first = np.r_[0, np.cumsum(counts)]
        out = np.empty(first[-1], np.uint32)
        for some, ids in parts:
            out[ragged(first[some], counts[some])] = ids
        return out, counts

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a slice, one after another, and the offsets of the rows among them."""
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts = piece_starts(data, offsets, self.classes)
        ends = np.r_[starts[1:], len(data)]
        hashes = segment_hashes(data, starts, ends, self.values, self.powers)
        distinct, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > REMEMBERED:
            self.forget()
        at = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != distinct[inside]
        if new.any():
            ids, counts = self.pieces(data, starts[where[new]], ends[where[new]])
            first = len(self.known_ids) + np.r_[0, np.cumsum(counts)[:-1]]
            self.known_ids = np.concatenate([self.known_ids, ids])
            merged = np.concatenate([self.known, distinct[new]])
            order = np.argsort(merged, kind="stable")
            self.known = merged[order]
            self.known_first = np.concatenate([self.known_first, first])[order]
            self.known_size = np.concatenate([self.known_size, counts])[order]
            at = np.searchsorted(self.known, distinct)
        first, size = self.known_first[at][inverse], self.known_size[at][inverse]
        ids = self.known_ids[ragged(first, size)]
        totals = np.r_[0, np.cumsum(size)]
        return ids, totals[np.searchsorted(starts, offsets)]

    def decode(self, ids: np.ndarray) -> bytes:
        first = self.merges.offsets[ids]
        return self.raw[ragged(first, self.merges.offsets[ids + np.uint32(1)] - first)].tobytes()

    @property
    def raw(self) -> np.ndarray:
        return np.frombuffer(self.merges.data, np.uint8)


def ragged(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices first, first + 1, ... of each run of the given size, one run after another."""
    total = np.cumsum(size)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(first - (total - size), size)


def code_point_classes() -> np.ndarray:
    """Class of every code point: white space, letter, number or other."""
    import regex

    out = np.full(0x110000, OTHER, np.uint8)
    every = np.r_[:0xD800, 0xE000:0x110000].astype("<u4").tobytes().decode("utf-32-le")  # every worker makes it: no list of characters
    for kind, name in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(name, every):
            low, high = ord(every[m.start()]), ord(every[m.end() - 1])
            out[low:high + 1] = kind
    out[WHITE_SPACE] = SPACE
    return out


def piece_starts(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Byte positions where the pieces of the rows start.

    The pieces are the matches of: contractions after an apostrophe; runs of letters, numbers or others, each with
    at most one space before; white space, whose last character stands alone or joins what follows it.
    """
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    code = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(code)
    kind = classes[code]
    row = np.zeros(n + 1, bool)  # a row starts here
    row[np.searchsorted(at, offsets)] = True
    row[0] = row[n] = True
    before = np.r_[np.uint8(255), kind[:-1]]
    before[row[:n]] = 255
    space = kind == SPACE
    blank = np.r_[False, code[:-1] == 0x20] & ~row[:n]
    starts = np.where(space, before != SPACE, (before != kind) & ~blank)
    ends_run = space & ~row[1:] & np.r_[kind[1:] != SPACE, True]  # a visible character of the same row follows
    starts |= ends_run
    apostrophe = np.flatnonzero(starts & (code == ord("'")))
    if len(apostrophe):
        text = np.r_[code, np.zeros(3, np.uint32)]
        edge = np.r_[row, np.ones(3, bool)]
        one, two = text[apostrophe + 1], text[apostrophe + 2]
        fits1 = np.isin(one, [ord(c) for c in "stmd"]) & ~edge[apostrophe + 1]
        pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        fits2 = pair & ~edge[apostrophe + 1] & ~edge[apostrophe + 2] & ~fits1
        for fits, length in ((fits1, 2), (fits2, 3)):
            there = apostrophe[fits]
            starts[there + 1] = False
            after = there + length
            after = after[after < n]
            starts[after] |= kind[after] == LETTER
    return at[starts]


def encoded(docs: DataFrame, text: str, schema: str, merges: Merges,
            rows: Callable[[Encoder, pa.RecordBatch, int, int, np.ndarray, np.ndarray], pa.RecordBatch]) -> DataFrame:
    """Map batches of documents with the ids of their texts.

    ``rows(encoder, batch, first row, end row, ids, offsets of the rows among the ids)`` makes the output. Whole texts are
    encoded, a slice of about two megabytes at a time. The vocabulary, whose size does not depend on the data, is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(merges))  # plain arrays: workers may lack this package

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Merges(**shared.value))
        for batch in batches:
            for first, end, data, offsets in slices(batch.column(text), SLICE):
                yield rows(encoder, batch, first, end, *encoder.encode(data, offsets))

    return docs.mapInArrow(run, schema)


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, merges: Merges) -> DataFrame:
    """Encode each text and decode its ids: their number and the digests of ids and decoded bytes.

    One row per row: null and empty texts have no ids; repeated rows repeat; a null doc_id stays null; other columns are not read.
    """
    def rows(encoder: Encoder, batch: pa.RecordBatch, first: int, end: int, ids: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
        own = [ids[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        return pa.RecordBatch.from_arrays([
            batch.column("doc_id").slice(first, end - first), pa.array(np.diff(at)),
            pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in own], pa.string()),
            pa.array([hashlib.sha256(encoder.decode(x)).hexdigest() for x in own], pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    from pyspark.sql import functions as F
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return encoded(plain, "text", DIGESTS, merges, rows)
