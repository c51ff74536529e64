import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.tables import awkward, documents, prose
from tidelake.llm import ranked_search


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(rows, items, most=10):
    held = [(doc, Counter(terms(text))) for doc, text in rows]
    held = [(doc, c, c.total()) for doc, c in held if c]
    number, length = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c, n in held:
            m = 100 - 90 + (90 * n * number) // length
            score = sum(math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
                        for t in set(terms(text)) if t in c)
            if score > 0:
                scores.append((-score, doc is None, doc))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, k + 1, doc, -s) for k, (s, _, doc) in enumerate(scores[:most])]
    return sorted(out, key=repr)


def tables(seed):
    rng = random.Random(seed)
    rows = [(k, prose(rng, rng.choice([1, 3, 30, 200]), 120)) for k in range(300)]
    rows += [(1000 + k, rows[5][1]) for k in range(15)] + [(d and 5000 + d, t) for d, t in awkward()]
    items = [(k, prose(rng, n, 140)) for k, n in enumerate([1, 2, 5, 20, 60])]
    items += [(10, None), (11, ""), (12, "unheard of"), (13, "Word, WORD é 中文"), (14, rows[5][1]), (14, rows[5][1]), (None, "one two")]
    return rows, items


def found(spark, rows, items, parts=3):
    frame = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int")
    out = ranked_search.ranked(spark, documents(spark, rows).repartition(parts), frame)
    return sorted(map(tuple, out.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.mark.parametrize("seed, postings, batch, block", [(1, 1 << 21, 512, 1 << 18), (2, 300, 2, 1 << 18), (3, 900, 7, 20)])
def test_equals_brute_force(spark, monkeypatch, seed, postings, batch, block):
    monkeypatch.setattr(ranked_search, "SHARD_POSTINGS", postings)
    monkeypatch.setattr(ranked_search, "BATCH", batch)
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", block)
    rows, items = tables(seed)
    assert found(spark, rows, items) == brute_force(rows, items)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "one")]) == [] and found(spark, [(1, "one")], []) == [] and found(spark, [(1, None)], [(1, "a")]) == []


def test_treap_holds_the_grid():
    rng = np.random.default_rng(1)
    for rows, columns in ((1, 1), (5, 300), (400, 9)):
        grid = np.where(rng.random((rows, columns)) < 0.2, rng.integers(1, 50, (rows, columns)), 0)
        grid[0, 0] = 7
        at = np.nonzero(grid)
        tree = ranked_search.Treap.build(at[0], at[1], grid[at])
        tree = ranked_search.Treap.restored(tree.height, tree.quarters, tree.differences())
        wanted = np.unique(rng.integers(0, rows, 6))
        weights = rng.integers(1, 5, len(wanted))
        scores = (grid[wanted] * weights[:, None]).sum(0)
        order = sorted((-int(s), c) for c, s in enumerate(scores) if s)[:10]
        assert [(-s, c) for s, c in tree.best(wanted, weights, 10, 0)] == order
