import random

import numpy as np
import pytest

from tests.llm.tables import awkward, documents, edited, prose
from tests.llm.test_ngram_join import brute_force, corpus
from tidelake.llm import near_dedup, ngram_join


@pytest.mark.parametrize("width, percent, seed, block", [(3, 85, 1, 1024), (5, 80, 2, 3)])
def test_equals_brute_force(spark, monkeypatch, width, percent, seed, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)  # keys of many texts span several blocks
    monkeypatch.setattr(ngram_join, "BLOCK_TOKENS", 300)
    rows = corpus(seed) + [(d and 1000 + d, t) for d, t in awkward()]
    found = near_dedup.classes(documents(spark, rows).repartition(5), width, percent)
    got = [tuple(r) for r in found.collect()]
    assert sorted((r[:3] for r in got), key=repr) == brute_force(rows, width, percent)
    assert all(kept == (doc == component) for doc, _, component, kept in got)


def test_chains_of_copies_stay_connected(spark, monkeypatch):
    """A text drifts word by word: neighbours link, far ones share no key's least text."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rng = random.Random(9)
    rows, text = [], prose(rng, 150)
    for k in range(120):
        rows.append((k, text))
        text = edited(rng, text, 2)
    found = near_dedup.classes(documents(spark, rows).repartition(4), 3, 85)
    assert sorted((tuple(r)[:3] for r in found.collect()), key=repr) == brute_force(rows, 3, 85)


def test_pairs_within_the_distance_share_a_key():
    plan, rng = near_dedup.Plan.of(85), np.random.default_rng(3)
    for _ in range(2000):
        one = rng.integers(0, 1 << 16, (1, plan.places), dtype=np.uint16)
        two = one.copy()
        at = rng.permutation(plan.places)[:int(rng.integers(0, plan.distance + 1))]
        two[0, at] += 1
        assert (near_dedup.chunk_keys(one) == near_dedup.chunk_keys(two)).any()


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(4)
    x = np.unique(rng.integers(0, 2**63, 4000, dtype=np.uint64))
    y = np.concatenate([x[:3000], np.unique(rng.integers(0, 2**63, 1000, dtype=np.uint64))])
    found = near_dedup.signatures([x, y, x[:0]], 400)
    assert abs((found[0] == found[1]).mean() - 0.6) < 0.09
    assert not found[2].any()


def test_empty_table(spark):
    assert near_dedup.classes(documents(spark, []), 3, 85).count() == 0
