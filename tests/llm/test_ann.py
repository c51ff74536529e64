import numpy as np

from pyspark.sql import functions as F

from tidelake.llm import ann


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, id string, v string, cell string, block string")


def extended(rows):
    return [(i, v, "x", "x", "x", "x") for i, v in rows]


def exact(rows, queries, k):
    own = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    ids = np.array(sorted(own))
    x = np.stack([own[i] for i in ids.tolist()])
    out = {}
    for q in queries:
        score = (x * own[q]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.neighbour, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_and_order(spark):
    rng = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(1500, 16)).astype(np.float32))]
    rows += [(2000 + i, rows[7][1]) for i in range(400)]  # one common vector
    want = exact(rows, [i for i, _ in rows if i % 20 == 0], 20)
    got = found(ann.nearest(table(spark, extended(rows)), F.col("id") % 20 == 0, share=0.6, centers=8, bundle=256, block=16))
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({s for _, s in got[q]} & {s for _, s in want[q]}) / len({s for _, s in want[q]}) for q in want)
    assert hits / len(want) >= 0.9
    whole = found(ann.nearest(table(spark, extended(rows)), F.col("id") % 20 == 0, share=1.0, centers=8, bundle=256, block=16))
    assert {q: [i for i, _ in v] for q, v in whole.items()} == {q: [i for i, _ in v] for q, v in want.items()}


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (20, None), (40, [0.0, 0.0]), (60, [float("nan"), 1.0]), (80, [float("inf"), 1.0]), (100, [None, 1.0]),
            (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (4, [])]
    got = found(ann.nearest(table(spark, extended(rows)), F.col("id") % 20 == 0))
    assert got == {0: [(1, 1.0), (2, 1.0)]}


def test_empty_table(spark):
    assert ann.nearest(table(spark, []), F.lit(True)).count() == 0
    assert ann.nearest(table(spark, extended([(0, None)])), F.lit(True)).count() == 0


def test_traversal_is_in_order():
    rng = np.random.default_rng(3)
    books = ann.Codebooks(rng.normal(size=(7, 3)), rng.normal(size=(5, 4)))
    counts, q = rng.integers(0, 3, books.cells), rng.normal(size=7)
    cost = [-(books.first @ q[:3])[c // 5] - (books.second @ q[3:])[c % 5] for c in range(books.cells)]
    cells = books.traverse(q, counts, int(counts.sum()))
    assert sorted(cells) == np.flatnonzero(counts).tolist()
    assert [cost[c] for c in cells] == sorted(cost[c] for c in cells)
    some = books.traverse(q, counts, 5)
    assert some == cells[:len(some)] and counts[some].sum() >= 5 > counts[some[:-1]].sum()
