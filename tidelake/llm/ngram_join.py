"""Similarity join of documents by the Jaccard coefficient of their word shingles.

Tokens are shingle hashes, in one global order: rare tokens by hash, then frequent ones. A set of n tokens that is linked
lacks at most ``missing(n)`` of them in its partner. Hence

* if it has more rare tokens than that, its first missing(n) + 1 rare tokens are its prefix, indexed singly;
* else all its rare tokens are indexed singly, and its prefix extends over so many frequent tokens that two which
  are shared follow each other with at most one foreign token between them on either side. Pairs of frequent tokens at a
  distance of one or two are indexed: two per token, not all combinations.

Of two linked sets, all that the shorter prefix (in the global order) shares lies in the longer one, so the argument holds whichever
of them has it, whichever tokens are called frequent. Rare tokens occur in fewer than LEAST_FREQUENT texts at every size of the corpus,
which bounds their lists and keeps their candidate pairs in proportion to the texts. The frequent ones are known by a mask of fixed size, in which some rare
tokens count as frequent. Pairs of frequent tokens may be as frequent as a family of near copies is large. Candidate pairs of rare tokens are thinned by size and by a parity bitmap, both exact
bounds; what they and shared pairs of frequent tokens connect is a family. Its members are compared in blocks: bitmaps first, then
full sets, unless earlier links of the block connect the two already.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidelake.llm.common import connected, spread_join, tasks_for
from tidelake.llm.textbytes import Powers, byte_values, mixed, segment_hashes, shingle_hashes, slices, whole_hash, words
from tidelake.session import checkpointed

LEAST_BITS = 1024
#: Size codes grow by 2 % a step.
STEP = 1.02
#: Tokens of at least so many texts are frequent, however large the corpus.
LEAST_FREQUENT = 64
#: Bits of the mask of frequent tokens, the only thing about them that is broadcast (16 MB): a token's upper bits are its place.
FREQUENT_BITS = 27
#: Bits of the mask by which the documents of candidates are found; more documents than bits only cost time.
MASK, MASK_PARTS = 1 << 23, 64
BLOCK_TOKENS = 1 << 20


@dataclass(frozen=True)
class Bound:
    """What a coefficient of at least percent / 100 implies, in whole numbers."""
    percent: int

    def missing(self, n: int) -> int:
        """Tokens of a set of n that a linked set may lack."""
        return n - -(-self.percent * n // 100)

    def largest(self, n: int) -> int:
        """Size of the largest linked set."""
        return 100 * n // self.percent

    def extended(self, n: int, rare: int) -> int:
        """Frequent tokens that the prefix needs when all of ``rare`` rare tokens are foreign to the partner."""
        own, other = self.missing(n) - rare, self.missing(self.largest(n))
        return own + 2 + (own + other) // 2

    def linked(self, a: int, b: int, common: int) -> bool:
        return 100 * common >= self.percent * (a + b - common)


class Shingler:
    """For each row: digest of its word sequence, and its sorted distinct shingles; no digest without words."""

    def __init__(self, width: int):
        self.width, self.powers, self.values = width, Powers(), byte_values(True)

    def rows(self, texts: pa.Array) -> Iterator[tuple[int, bytes | None, np.ndarray]]:
        for first, _, data, offsets in slices(texts):
            starts, ends, at = words(data, offsets)
            hashes = segment_hashes(data, starts, ends, self.values, self.powers) if len(starts) else np.empty(0, np.uint64)
            shingles = shingle_hashes(hashes, self.width)
            for k in range(len(offsets) - 1):
                a, b = at[k], at[k + 1]
                if a == b:
                    yield first + k, None, shingles[:0]
                    continue
                own = np.unique(shingles[a:b - self.width + 1]) if b - a >= self.width else np.array([whole_hash(hashes[a:b])])
                yield first + k, hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest(), own


def short_key(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def bitmap(tokens: np.ndarray) -> bytes:
    """Parity of the tokens of each bit; bits in which two bitmaps differ never outnumber tokens in which the sets do.

    A set has at least half as many bits as tokens, a power of two: with fewer, those of two unrelated sets would not
    differ enough to tell.
    """
    width = max(LEAST_BITS, 1 << max(0, len(tokens) // 2 - 1).bit_length())
    bits = np.bincount((tokens & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """A bitmap as one of fewer words: parities of bits that fall together add up."""
    return np.bitwise_xor.reduce(bits.reshape(-1, words), axis=0)


def differences(a: bytes, b: bytes) -> int:
    """Bits in which two bitmaps differ, at the width of the narrower one."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    words = min(len(x), len(y))
    return int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum(dtype=np.int64))


def size_code(n: int) -> int:
    return int(np.log(n) / np.log(STEP))


def _own(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


INFO = "doc_id long, key binary, short long, n long, bits binary"


def summarised(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, key, short key, number of shingles, bitmap) of each row, stored once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            found = [(key, len(own), bitmap(own)) for _, key, own in shingler.rows(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([x[0] for x in found], pa.binary()),
                pa.array([x[0] and short_key(x[0]) for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64()),
                pa.array([x[2] for x in found], pa.binary())], names=["doc_id", "key", "short", "n", "bits"])

    return checkpointed(_own(docs).mapInArrow(run, INFO))


def slot_bits(total: int) -> int:
    """Upper bits by which tokens are counted: at least as many slots as shingles, and places of the mask are prefixes of slots."""
    return min(63, max(32, FREQUENT_BITS, total.bit_length()))


def frequent_tokens(docs: DataFrame, width: int, total: int) -> np.ndarray:
    """Packed mask of the places of all tokens in at least LEAST_FREQUENT texts; counts cover all tokens of all rows.

    A task counts its tokens once per text and sends, per range of tokens, one sorted array of differences with
    counts; a text that is copied throughout the corpus thus weighs once per task. Tokens of one slot count as one, tokens of one place
    share its bit: both at most call a rare one frequent. Every range gives its own stretch of the mask, so the driver gets the mask's size
    and a few bytes a range.
    """
    limit, bits = LEAST_FREQUENT, slot_bits(total)
    parts = tasks_for(docs.sparkSession, total, 4_000_000)
    edges = np.array([(k << bits) // parts for k in range(parts + 1)], np.uint64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen, kept, held = Shingler(width), set(), [], 0
        for batch in batches:
            for _, key, own in shingler.rows(batch.column("text")):
                if key is None or key in seen:
                    continue
                seen.add(key)
                kept.append(own >> np.uint64(64 - bits))
                held += len(own)
                if held >= 4_000_000:
                    yield packed(kept)
                    kept, held = [], 0
        if kept:
            yield packed(kept)

    def packed(kept: list[np.ndarray]) -> pa.RecordBatch:
        tokens, counts = np.unique(np.concatenate(kept), return_counts=True)
        at = np.searchsorted(tokens, edges)
        rows = [(k, planes(np.diff(tokens[a:b], prepend=edges[k]), "<u8"), planes(counts[a:b], "<u4"))
                for k, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)) if b > a]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()),
                                           pa.array([r[2] for r in rows], pa.binary())], names=["part", "steps", "counts"])

    def planes(x: np.ndarray, kind: str) -> bytes:
        x = x.astype(kind)
        return np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes()

    def plain(x: bytes, kind: str) -> np.ndarray:
        return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = edges[key[0].as_py()]
        tokens, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def fold() -> None:
            nonlocal tokens, counts
            every = np.concatenate([tokens, *[t for t, _ in waiting]])
            weight = np.concatenate([counts, *[c for _, c in waiting]])
            order = np.argsort(every, kind="stable")
            every, weight = every[order], weight[order]
            heads = np.flatnonzero(np.r_[True, every[1:] != every[:-1]]) if len(every) else np.empty(0, np.int64)
            tokens, counts = every[heads], np.add.reduceat(weight, heads) if len(heads) else weight
            waiting.clear()

        for batch in batches:
            for steps, n in zip(batch.column("steps"), batch.column("counts"), strict=True):
                waiting.append((first + np.cumsum(plain(steps.as_py(), "<u8"), dtype=np.uint64), plain(n.as_py(), "<u4").astype(np.int64)))
                if sum(len(t) for t, _ in waiting) > 4_000_000:
                    fold()
        fold()
        places = (tokens[counts >= limit] >> np.uint64(bits - FREQUENT_BITS)).astype(np.int64)
        if len(places):
            at = int(places[0]) >> 3
            stretch = np.zeros((int(places[-1]) >> 3) - at + 1, np.uint8)
            np.bitwise_or.at(stretch, (places >> 3) - at, (1 << (places & 7)).astype(np.uint8))
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([stretch.tobytes()], pa.binary())], names=["at", "bits"])

    counted = _own(docs).mapInArrow(count, "part int, steps binary, counts binary")
    mask = np.zeros(1 << FREQUENT_BITS - 3, np.uint8)
    for at, stretch in counted.groupBy("part").applyInArrow(add, "at long, bits binary").collect():
        mask[at:at + len(stretch)] |= np.frombuffer(stretch, np.uint8)
    return mask


def rarely(own: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Which tokens of a set are rare."""
    place = (own >> np.uint64(64 - FREQUENT_BITS)).astype(np.int64)
    return mask[place >> 3] >> (place & 7).astype(np.uint8) & 1 == 0


def signatures(own: np.ndarray, rare: np.ndarray, bound: Bound) -> list[tuple[int, np.ndarray]]:
    """Signatures of one set by kind: 0 single rare tokens, 1 pairs of frequent tokens, 2 the whole set.

    ``own`` is sorted by hash; ``rare`` tells which of its tokens are rare.
    """
    n = len(own)
    if bound.missing(n) == 0 and bound.largest(n) == n:  # linked with equal sets only
        return [(2, mixed(np.array([own.sum(dtype=np.uint64) + np.uint64(n)])))]
    prefix = bound.missing(n) + 1
    single = own[rare]
    if len(single) >= prefix:
        return [(0, single[:prefix])]
    common = own[~rare][:bound.extended(n, len(single))]
    pairs = [mixed(common[:-k] * np.uint64(0x9E3779B97F4A7C15) + common[k:]) for k in (1, 2) if len(common) > k]
    return [(0, single), (1, np.concatenate(pairs))]


#: A posting's first word: 51 bits of the signature, 2 of its kind, 11 of the size code.
def posted(signature: np.ndarray, kind: int, code: int) -> np.ndarray:
    return (signature & ~np.uint64(0x1FFF)) | np.uint64(kind << 11 | code)


def candidates(docs: DataFrame, width: int, bound: Bound, frequent: np.ndarray, total: int) -> DataFrame:
    """Stored rows (kind, a, b): kind 0 candidate pairs of short keys; kind 1 postings (signature, short key)."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    apart = int(np.log(100 / bound.percent) / np.log(STEP)) + 2

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen, often = Shingler(width), set(), shared.value
        for batch in batches:
            kept: list[np.ndarray] = []
            keys: list[np.ndarray] = []
            for _, key, own in shingler.rows(batch.column("text")):
                if key is None or key in seen:
                    continue
                seen.add(key)
                code = size_code(len(own))
                for kind, found in signatures(own, rarely(own, often), bound):
                    kept.append(posted(found, kind, code))
                    keys.append(np.full(len(found), short_key(key), np.int64))
            if kept:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(kept).view(np.int64)), pa.array(np.concatenate(keys))],
                                                 names=["posting", "short"])

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column("posting").to_numpy().view(np.uint64), b.column("short").to_numpy()) for b in batches if b.num_rows]
        if not got:
            return
        posting, short = (np.concatenate([g[k] for g in got]) for k in (0, 1))
        kind = posting >> np.uint64(11) & np.uint64(3)
        order = np.lexsort((short, posting))
        posting, short, kind = posting[order], short[order], kind[order]
        new = np.r_[True, (posting[1:] != posting[:-1]) | (short[1:] != short[:-1])]
        posting, short, kind = posting[new], short[new], kind[new]
        yield out(1, (posting[kind == 1] & ~np.uint64(0x1FFF)).view(np.int64), short[kind == 1])
        found = [np.empty((0, 2), np.int64)]
        for k, rest in ((0, kind == 0), (2, kind == 2)):
            some, who = posting[rest], short[rest]
            signature, code = some >> np.uint64(13), (some & np.uint64(0x7FF)).astype(np.int64)
            if k == 2:  # equal sets: each with the first is enough
                first = np.searchsorted(signature, signature)
                found.append(np.stack([who[first], who], 1))
                continue
            live, distance = np.arange(len(some)), 1
            while len(live):
                live = live[live + distance < len(some)]
                live = live[signature[live + distance] == signature[live]]
                near = live[code[live + distance] - code[live] <= apart]
                found.append(np.stack([who[near], who[near + distance]], 1))
                live, distance = near, distance + 1
        pairs = np.concatenate(found)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        pairs.sort(axis=1)
        if len(pairs):
            pairs = np.unique(pairs, axis=0)
            yield out(0, pairs[:, 0].copy(), pairs[:, 1].copy())

    def out(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b)],
                                          names=["kind", "a", "b"])

    postings = _own(docs).mapInArrow(post, "posting long, short long")
    signature = F.shiftrightunsigned("posting", 13)
    many = F.shiftrightunsigned("posting", 11).bitwiseAND(F.lit(3)) == 1  # only those are ever shared by more than a few
    dealt = postings.repartition(tasks_for(docs.sparkSession, total // 5, 1_500_000), signature,
                                 F.when(many, F.col("short")).otherwise(F.lit(0)))
    return checkpointed(dealt.mapInArrow(pair, "kind int, a long, b long"))


def close(pairs: DataFrame, info: DataFrame, bound: Bound) -> DataFrame:
    """Candidate pairs (keys) that sizes and bitmaps leave possible; a short key of two texts stands for both."""
    side = lambda p: info.select(F.col("short").alias(p), F.col("key").alias(f"k{p}"), F.col("n").alias(f"n{p}"),
                                 F.col("bits").alias(f"b{p}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(
        (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * bound.percent) & (F.col("ka") != F.col("kb")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            differ = [differences(a.as_py(), b.as_py()) for a, b in zip(batch.column("ba"), batch.column("bb"), strict=True)]
            fits = possible(np.array(differ, np.int64), batch.column("na").to_numpy(), batch.column("nb").to_numpy(), bound)
            yield batch.select(["ka", "kb"]).filter(pa.array(fits))

    return both.select("ka", "kb", "na", "nb", "ba", "bb").mapInArrow(run, "ka binary, kb binary")


def possible(differ: np.ndarray, na: np.ndarray, nb: np.ndarray, bound: Bound) -> np.ndarray:
    """Whether sets that differ in at least so many tokens can be linked: common = (na + nb - differ) / 2 at most."""
    return 100 * (na + nb - differ) >= bound.percent * (na + nb + differ)


def token_sets(docs: DataFrame, width: int, wanted: DataFrame) -> DataFrame:
    """(key, doc_id, tokens) of the rows whose doc_id is wanted (column least), and of a few others.

    What is wanted reaches the tasks as a mask of fixed size over a residue of the ids; a join on key and id follows.
    """
    def mark(key: tuple, rows: pa.Table) -> pa.Table:
        part = np.zeros(MASK // MASK_PARTS, bool)
        part[rows["r"].to_numpy() // MASK_PARTS] = True
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(part).tobytes()], pa.binary())})

    residues = wanted.select(F.pmod(F.coalesce("least", F.lit(-1)), F.lit(MASK)).cast("int").alias("r")).distinct()
    parts = residues.groupBy(F.pmod("r", F.lit(MASK_PARTS)).alias("part")).applyInArrow(mark, "part int, bits binary").collect()
    mask = np.zeros((MASK // MASK_PARTS, MASK_PARTS), bool)
    for part, bits in parts:
        mask[:, part] = np.unpackbits(np.frombuffer(bits, np.uint8))
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(mask))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, open_ = Shingler(width), np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            ids = batch.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(open_[np.mod(ids, MASK)]))
            found = [(key, own.astype("<u8").tobytes()) for _, key, own in shingler.rows(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.binary()), batch.column("doc_id"),
                                              pa.array([x[1] for x in found], pa.binary())], names=["key", "doc_id", "tokens"])

    return _own(docs).mapInArrow(run, "key binary, doc_id long, tokens binary")


def stars(postings: DataFrame, info: DataFrame) -> DataFrame:
    """Edges (ka, kb) between texts that share a pair of frequent tokens: each pair's least text with all others."""
    least = postings.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("hub"), F.max("b").alias("top")).where("hub < top")
    edges = spread_join(postings, checkpointed(least), "a", "of").where("b > hub").select("hub", "b").distinct()
    side = lambda p: info.select(F.col("short").alias(p), F.col("key").alias(f"k{p}"))
    return edges.withColumnRenamed("hub", "a").join(side("a"), "a").join(side("b"), "b").select("ka", "kb")


def family_links(members: DataFrame, sets: DataFrame, bound: Bound, every: bool = False) -> DataFrame:
    """Links (a, b, common tokens) within families (root, key, least, n, bits): all, or enough to connect what all connect.

    A family is cut by hash into chunks of about a million tokens; every two chunks meet in one block. The set of a member of
    a family of one chunk thus moves once, however many candidate pairs it is in.
    """
    size = members.groupBy("root").agg(F.sum("n").alias("tokens")).select(
        F.col("root").alias("r"), F.ceil(F.col("tokens") / BLOCK_TOKENS).cast("int").alias("chunks"))
    cut = members.join(size, F.col("root") == F.col("r")).withColumn("c", F.expr("pmod(xxhash64(key), chunks)").cast("int"))
    blocks = cut.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "root", F.least("c", "j").alias("i"), F.greatest("c", "j").alias("k"), (F.col("c") > F.col("j")).alias("second"),
        F.col("key").alias("of"), "least", "n", "bits")
    joined = blocks.join(sets, (F.col("of") == F.col("key")) & F.col("least").eqNullSafe(F.col("doc_id"))).drop("of", "least", "doc_id")

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        keys, first = rows["key"].to_pylist(), np.unique(np.array(rows["key"].to_pylist(), object), return_index=True)[1]
        sizes = rows["n"].to_numpy()
        whole = rows["bits"].to_pylist()
        bits = np.stack([folded(np.frombuffer(x, np.uint64), LEAST_BITS // 64) for x in whole])
        tokens, parent = rows["tokens"], list(range(len(keys)))
        second, split = rows["second"].to_numpy(), key[1].as_py() != key[2].as_py()
        sets_: dict[int, np.ndarray] = {}

        def of(k: int) -> np.ndarray:
            if k not in sets_:
                sets_[k] = np.frombuffer(tokens[k].as_py(), "<u8")
            return sets_[k]

        def root(k: int) -> int:
            while parent[k] != k:
                parent[k] = parent[parent[k]]
                k = parent[k]
            return k

        links = []
        left = first[~second[first]] if split else first
        right = first[second[first]] if split else first
        for a in left.tolist():
            others = right if split else right[right > a]
            differ = np.bitwise_count(bits[others] ^ bits[a]).sum(axis=1, dtype=np.int64)
            fits = possible(differ, sizes[others], sizes[a], bound)
            for b in others[fits][np.argsort(differ[fits], kind="stable")].tolist():
                x, y = root(a), root(b)
                if x == y and not every or not possible(differences(whole[a], whole[b]), sizes[a], sizes[b], bound):
                    continue
                common = len(np.intersect1d(of(a), of(b), assume_unique=True))
                if bound.linked(sizes[a], sizes[b], common):
                    parent[max(x, y)] = min(x, y)
                    links.append((keys[a], keys[b], common))
        return pa.table({"a": pa.array([x[0] for x in links], pa.binary()), "b": pa.array([x[1] for x in links], pa.binary()),
                         "common": pa.array([x[2] for x in links], pa.int64())})

    return joined.groupBy("root", "i", "k").applyInArrow(run, "a binary, b binary, common long")


def families(docs: DataFrame, width: int, bound: Bound) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows as ``summarised``, different texts (key, short, n, bits, least doc_id), and texts with candidates by family (root)."""
    if not 50 < bound.percent <= 100:
        raise ValueError("percent must be over 50 and at most 100")
    info = summarised(docs, width)
    one = info.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("short").alias("short"), F.min("n").alias("n"), F.min("bits").alias("bits"), F.min("doc_id").alias("least"))
    one = checkpointed(one)
    total = one.agg(F.sum("n")).first()[0] or 0
    frequent = frequent_tokens(docs, width, total)
    found = candidates(docs, width, bound, frequent, total)
    pairs = close(found.where("kind = 0").select("a", "b").distinct(), one, bound)
    edges = pairs.union(stars(found.where("kind = 1").select("a", "b"), one)).select(F.col("ka").alias("a"), F.col("kb").alias("b"))
    members = checkpointed(connected(edges).join(one.select(F.col("key").alias("node"), "least", "n", "bits"), "node").select(
        "root", F.col("node").alias("key"), "least", "n", "bits"))
    return info, one, members


def classes(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Each row's class: (doc_id, n_shingles, key, component_id).

    Two documents link when their sets of ``width``-word shingles have a Jaccard coefficient of at least percent / 100; words are
    cut at ASCII white space, A-Z count as a-z. Fewer words than ``width`` make one shingle. Rows without words, or with a null
    text, have no shingles and their own doc_id as component_id. Equal word sequences are one text from the start. component_id is
    the smallest doc_id reachable by links, null only where all reachable ones are null. One row per input row, also for
    repeated rows; only doc_id and text are read; an empty table gives no rows.
    """
    info, one, members = families(docs, width, Bound(percent))
    links = family_links(members, token_sets(docs, width, members.select("least")), Bound(percent)).distinct()
    roots = connected(links)
    named = roots.join(one.select(F.col("key").alias("node"), "least"), "node")
    component = named.groupBy("root").agg(F.min("least").alias("component"))
    of_key = named.join(component, "root").select(F.col("node").alias("key"), "component")
    every = one.join(of_key, "key", "left").select(F.col("key").alias("of"), F.coalesce("component", "least").alias("component"))
    out = spread_join(info, checkpointed(every), "key", "of")
    return out.select("doc_id", F.col("n").alias("n_shingles"), "key", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(
        F.col("component")).alias("component_id"))


def links(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """All links between different texts: (a, b, common, n_a, n_b), a and b the smallest doc_ids of their word sequences.

    The rule is that of ``classes``, whose keys tell which documents are copies of a and b; copies are not expanded. Each link comes
    once, a below b (a null doc_id first). Their number grows with the square of a group of different linked texts. Rows without words, null
    texts and empty tables give none.
    """
    bound = Bound(percent)
    _, one, members = families(docs, width, bound)
    found = family_links(members, token_sets(docs, width, members.select("least")), bound, every=True).distinct()
    side = lambda p: one.select(F.col("key").alias(p), F.struct("least", "n").alias(f"of_{p}"))
    both = found.join(side("a"), "a").join(side("b"), "b").select(
        F.least("of_a", "of_b").alias("x"), F.greatest("of_a", "of_b").alias("y"), "common")
    return both.select(F.col("x.least").alias("a"), F.col("y.least").alias("b"), "common", F.col("x.n").alias("n_a"), F.col("y.n").alias("n_b"))
