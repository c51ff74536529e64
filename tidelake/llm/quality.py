"""Naive Bayes support vectors: a linear hinge-loss model over n-gram indicators scaled by class log-count ratios."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidelake.llm.textbytes import Powers, byte_values, mixed, segment_hashes, slices, words
from tidelake.session import checkpointed

BITS = 18
FEATURES = 1 << BITS
BLOCKS = 16
#: Words are compared with so many words before them, which makes repetition visible to indicators.
BACK = 4
THRESHOLD = 0.3
#: Bytes of text whose features are made at once, which bounds a worker's arrays.
SLICE = 1 << 19


def _shape_classes() -> np.ndarray:
    """Letters by case, digits, and every other byte as itself; bytes of longer characters count as lower-case letters."""
    classes = np.arange(256, dtype=np.uint8)
    classes[ord("a"):ord("z") + 1] = ord("a")
    classes[0x80:] = ord("a")
    classes[ord("A"):ord("Z") + 1] = ord("A")
    classes[ord("0"):ord("9") + 1] = ord("0")
    return classes


class Featurizer:
    """Distinct n-gram features of each row: words, one and two word shapes, one to three steps of the repetition pattern."""

    def __init__(self):
        self.powers, self.folded, self.plain, self.classes = Powers(), byte_values(True), byte_values(False), _shape_classes()

    def slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, feature) of a slice, sorted, without repeats."""
        rows = len(offsets) - 1
        starts, ends, first = words(data, offsets)
        if not len(starts):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        row = np.repeat(np.arange(rows), np.diff(first))
        word = segment_hashes(data, starts, ends, self.folded, self.powers)
        # shapes: runs of letters or digits shrink to one byte
        shape = self.classes[data]
        kept = np.ones(len(data), bool)
        alike = np.isin(shape, np.frombuffer(b"aA0", np.uint8))
        kept[1:] = (shape[1:] != shape[:-1]) | ~alike[1:]
        kept[starts] = True
        at = np.r_[0, np.cumsum(kept)]
        form = segment_hashes(shape[kept], at[starts], at[ends], self.plain, self.powers)
        back = np.zeros(len(word), np.uint64)
        for k in range(BACK, 0, -1):
            same = np.zeros(len(word), bool)
            same[k:] = (word[k:] == word[:-k]) & (row[k:] == row[:-k])
            back[same] = k
        keys = [self._key(row, word, 1)]
        for kind, unit, longest in ((2, form, 2), (4, mixed(back + np.uint64(77)), 3)):
            gram = unit
            for n in range(longest):
                if n:
                    gram = mixed(gram[:-1] * np.uint64(0x9E3779B97F4A7C15) + unit[n:])
                inside = row[:len(gram)] == row[n:]
                keys.append(self._key(row[:len(gram)][inside], gram[inside], kind + n))
        key = np.unique(np.concatenate(keys))
        return key >> BITS, key & (FEATURES - 1)

    @staticmethod
    def _key(row: np.ndarray, gram: np.ndarray, kind: int) -> np.ndarray:
        feature = mixed(gram + np.uint64(kind * 0x1000003)) >> np.uint64(64 - BITS)
        return row << BITS | feature.astype(np.int64)

    def batches(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        for first, end, data, offsets in slices(texts, SLICE):
            yield first, end, *self.slice(data, offsets)


@dataclass(frozen=True)
class Model:
    """Weight of each feature, and the line from margin to log-odds."""
    weights: np.ndarray
    bias: float
    slope: float
    offset: float


def log_count_ratios(pos: np.ndarray, neg: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    p, q = pos + alpha, neg + alpha
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_coordinate_descent(rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, cost: float, epochs: int,
                            seed: int) -> tuple[np.ndarray, float]:
    """Linear hinge-loss model over indicator rows scaled per feature and to unit length, with a bias feature.

    One pass visits all rows in random order and moves each row's dual variable to its optimum in [0, C]; the rarer class
    costs as much in sum as the other.
    """
    w, bias = np.zeros(len(scale)), 0.0
    values = [scale[r] for r in rows]
    norms = [max(float(np.sqrt(v @ v)), 1e-12) for v in values]
    values = [v / n for v, n in zip(values, norms, strict=True)]
    y = np.where(labels > 0, 1.0, -1.0)
    counts = {1.0: max(1, (y > 0).sum()), -1.0: max(1, (y < 0).sum())}
    most = [cost * len(y) / (2 * counts[k]) for k in y.tolist()]
    dual = np.zeros(len(y))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)).tolist():
            r, v = rows[i], values[i]
            gradient = y[i] * (w[r] @ v + bias) - 1
            new = min(max(dual[i] - gradient / 2.0, 0.0), most[i])  # the row and the bias have length 1 each
            step = (new - dual[i]) * y[i]
            if step:
                w[r] += step * v
                bias += step
                dual[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, bias


def margins(rows: list[np.ndarray], weights: np.ndarray, ratios: np.ndarray, bias: float) -> np.ndarray:
    return np.array([bias + (weights[r] @ ratios[r]) / max(np.sqrt(ratios[r] @ ratios[r]), 1e-12) for r in rows])


def sigmoid_line(margin: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through held-back margins, by Newton steps with smoothed targets."""
    n1, n0 = (labels > 0).sum(), (labels <= 0).sum()
    target = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - target) * margin).sum() + 1e-3 * a, (p - target).sum()])
        v = p * (1 - p)
        h = np.array([[(v * margin * margin).sum() + 1e-3, (v * margin).sum()], [(v * margin).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(max(a, 1e-3)), float(b)


def fit(rows: list[np.ndarray], labels: np.ndarray, pos: np.ndarray, neg: np.ndarray, cost: float = 1.0, epochs: int = 20,
        seed: int = 1) -> tuple[Model, np.ndarray]:
    """Model over sampled rows with the ratios of all rows. A single class, or none, gives a constant score."""
    ratios = log_count_ratios(pos, neg)
    if len(set((labels > 0).tolist())) < 2:
        always = 8.0 if len(labels) and labels[0] > 0 else -8.0 if len(labels) else 0.0
        return Model(np.zeros(FEATURES), 0.0, 1.0, always), ratios
    back = np.arange(len(labels)) % 4 == 0
    if len(set((labels[~back] > 0).tolist())) < 2:
        back[:] = False
    train = np.flatnonzero(~back)
    w, bias = dual_coordinate_descent([rows[i] for i in train], labels[train], ratios, cost, epochs, seed)
    test = np.flatnonzero(back) if back.any() else train
    slope, offset = sigmoid_line(margins([rows[i] for i in test], w, ratios, bias), labels[test])
    w, bias = dual_coordinate_descent(rows, labels, ratios, cost, epochs, seed)
    return Model(w, bias, slope, offset), ratios


LEARNED = "kind int, part int, label int, pos binary, neg binary"


def learn(docs: DataFrame, labels: DataFrame, label: str, train: Callable[[Column], Column],
          most_rows: int = 8000) -> tuple[Model, np.ndarray]:
    """Fit on labelled rows where ``train`` holds (a condition on the id).

    Class counts of all features cover every labelled row. The hinge-loss model is fitted on at most about ``most_rows`` of
    them, taken by a hash of doc_id. Both come out of one pass over the labelled texts; counts are summed in blocks of
    features, so that neither their number nor the sample's size grows with the data. Rows without a label, or with a null
    doc_id, are not learned from; contradicting labels of one document all count.
    """
    known = labels.select(F.col("doc_id").alias("of"), F.col(f"`{label}`").cast("int").alias("label")).where(
        F.col("of").isNotNull() & F.col("label").isNotNull() & train(F.col("of")))
    n = known.count()
    share = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 20)) < int((1 << 20) * min(1.0, most_rows / max(1, n)))
    texts = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text")).where(
        train(F.col("doc_id")))
    rows = texts.join(known.hint("shuffle_hash"), F.col("doc_id") == F.col("of")).select("label", "text", share.alias("taken"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, counts = Featurizer(), np.zeros((2, FEATURES), np.int32)
        for batch in batches:
            label, taken = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "taken"))
            kept: list[tuple[int, bytes]] = []
            for first, end, row, feature in features.batches(batch.column("text")):
                good = label[first:end][row] > 0
                counts[1] += np.bincount(feature[good], minlength=FEATURES).astype(np.int32)
                counts[0] += np.bincount(feature[~good], minlength=FEATURES).astype(np.int32)
                at = np.searchsorted(row, np.arange(end - first + 1))
                kept += [(int(label[first + k]), feature[at[k]:at[k + 1]].astype("<u4").tobytes())
                         for k in np.flatnonzero(taken[first:end]).tolist()]
            yield out(0, [0] * len(kept), [x[0] for x in kept], [x[1] for x in kept], [None] * len(kept))
        blocks = counts.reshape(2, BLOCKS, -1).astype("<i8")
        yield out(1, range(BLOCKS), [0] * BLOCKS, [b.tobytes() for b in blocks[1]], [b.tobytes() for b in blocks[0]])

    def out(kind: int, part, label, pos, neg) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([kind] * len(pos), pa.int32()), pa.array(list(part), pa.int32()), pa.array(label, pa.int32()),
            pa.array(pos, pa.binary()), pa.array(neg, pa.binary())], names=["kind", "part", "label", "pos", "neg"])

    learned = checkpointed(rows.mapInArrow(run, LEARNED))

    def add(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, FEATURES // BLOCKS), np.int64)
        for batch in parts:
            for k, name in enumerate(("neg", "pos")):
                for value in batch.column(name):
                    total[k] += np.frombuffer(value.as_py(), "<i8")
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total[1].tobytes()], pa.binary()),
                                          pa.array([total[0].tobytes()], pa.binary())], names=["part", "pos", "neg"])

    sums = sorted(learned.where("kind = 1").select("part", "pos", "neg").groupBy("part").applyInArrow(
        add, "part int, pos binary, neg binary").collect())
    pos, neg = (np.concatenate([np.frombuffer(r[k], np.int64) for r in sums]) if sums else np.zeros(FEATURES, np.int64)
                for k in (1, 2))
    sample = sorted(learned.where("kind = 0").select("pos", "label").collect())  # in an order that no task decides
    return fit([np.frombuffer(r[0], "<u4").astype(np.int64) for r in sample], np.array([r[1] for r in sample]), pos, neg)


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: the CRC of the id as text leaves no rest modulo 5."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def _mapped(docs: DataFrame, schema, model: Model, ratios: np.ndarray,
            rows: Callable[[pa.RecordBatch, np.ndarray], pa.RecordBatch]) -> DataFrame:
    """Map runs of rows with the scores of their texts."""
    scaled = docs.sparkSession.sparkContext.broadcast((
        (model.weights * ratios).astype(np.float64), ratios ** 2, model.bias, model.slope, model.offset))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Featurizer()
        weights, squares, bias, slope, offset = scaled.value
        for batch in batches:
            for first, end, row, feature in features.batches(batch.column("text")):
                total = np.bincount(row, weights[feature], end - first)
                norm = np.sqrt(np.bincount(row, squares[feature], end - first))
                log_odds = slope * (bias + total / np.maximum(norm, 1e-12)) + offset
                yield rows(batch.slice(first, end - first), 1 / (1 + np.exp(-np.clip(log_odds, -30, 30))))

    return docs.mapInArrow(run, schema)


def scored(docs: DataFrame, model: Model, ratios: np.ndarray) -> DataFrame:
    """(doc_id, score) of each row, from its whole text alone; null and empty texts have the bias's score."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _mapped(plain, "doc_id long, score double", model, ratios, lambda batch, score: pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"]))


def accepted(docs: DataFrame, model: Model, ratios: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score reaches the threshold, with all their columns; no exchange."""
    return _mapped(docs, docs.schema, model, ratios, lambda batch, score: batch.filter(pa.array(score >= threshold)))
