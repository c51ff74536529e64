import random
import re

import pytest

from tests.llm.tables import awkward, documents, edited, prose
from tidelake.llm import ngram_join


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def brute_force(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((d, len(s), d if not s else least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))),
                  key=repr)


def corpus(seed):
    rng = random.Random(seed)
    rows, passage = [], prose(rng, 60)
    for family in range(6):
        base = prose(rng, rng.choice([8, 20, 60, 150]))
        rows += [edited(rng, base, rng.randrange(4)) for _ in range(rng.choice([1, 3, 25]))]
        rows += [base.upper()] * 2
    rows += [f"{passage} {prose(rng, n)}" for n in (2, 4, 6, 8, 9, 10, 12, 20, 60)] * 3
    rows += ["same " * n for n in range(1, 12)] + [prose(rng, n, 5) for n in range(1, 30)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("width, percent, seed", [(4, 85, 1), (5, 80, 2), (2, 60, 3)])
def test_equals_brute_force(spark, monkeypatch, width, percent, seed):
    monkeypatch.setattr(ngram_join, "LEAST_FREQUENT", 4)  # families of near copies are frequent here
    monkeypatch.setattr(ngram_join, "BLOCK_TOKENS", 300)  # and span several blocks
    rows = corpus(seed) + [(d and 1000 + d, t) for d, t in awkward()]
    found = ngram_join.classes(documents(spark, rows).repartition(5), width, percent)
    assert sorted(map(tuple, found.select("doc_id", "n_shingles", "component_id").collect()), key=repr) == brute_force(
        rows, width, percent)


def test_empty_table(spark):
    assert ngram_join.classes(documents(spark, []), 4, 85).count() == 0
    assert ngram_join.links(documents(spark, []), 4, 85).count() == 0


def test_all_links_between_different_texts(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LEAST_FREQUENT", 4)
    monkeypatch.setattr(ngram_join, "BLOCK_TOKENS", 300)
    rows = corpus(4) + [(d and 1000 + d, t) for d, t in awkward()]
    least = {}
    for doc, text in rows:
        words = tuple(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        if words:
            least[words] = min(x for x in (least.get(words), doc) if x is not None) if doc is not None else least.get(words)
    sets = [(doc, shingles(" ".join(words), 2)) for words, doc in least.items()]
    expected = set()
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if 100 * len(x & y) >= 60 * len(x | y):
                (low, p), (high, q) = sorted([(a, x), (b, y)], key=lambda e: e[0])
                expected.add((low, high, len(x & y), len(p), len(q)))
    found = [tuple(r) for r in ngram_join.links(documents(spark, rows).repartition(3), 2, 60).collect()]
    assert len(found) == len(set(found)) and set(found) == expected and len(expected) > 40


def test_candidates_of_a_shared_passage_grow_with_its_texts(spark):
    """Rare lists are short at every size: texts that share a passage only never give pairs in proportion to their square."""
    rng, passage = random.Random(6), " ".join(f"shared{i}" for i in range(40))
    per_text = []
    for n in (60, 600, 6000):
        rows = [(i, f"{passage} " + " ".join(f"w{rng.randrange(1 << 40)}" for _ in range(40))) for i in range(n)]
        docs = documents(spark, rows).repartition(4)
        mask = ngram_join.frequent_tokens(docs, 4, 77 * n)
        found = ngram_join.candidates(docs, 4, ngram_join.Bound(85), mask, 77 * n)
        per_text.append(found.distinct().count() / n)
    assert max(per_text) <= ngram_join.LEAST_FREQUENT / 2


def test_frequent_tokens_of_a_wider_count(spark, monkeypatch):
    """Slots grow with the corpus, limits do not: the same tokens are frequent, whatever the total says."""
    rows = [(i, f"common words of many texts and {i} own{i} only{i} here{i}") for i in range(100)]
    docs = documents(spark, rows).repartition(3)
    masks = [ngram_join.frequent_tokens(docs, 4, total) for total in (800, 1 << 45)]
    assert (masks[0] == masks[1]).all()
    import numpy as np
    assert int(np.bitwise_count(masks[0]).sum()) == 3  # the windows that all texts share


def test_prefix_finds_every_linked_pair():
    """Any two linked sets have a signature in common, whichever tokens are frequent."""
    import numpy as np
    rng, bound = np.random.default_rng(5), ngram_join.Bound(85)
    for _ in range(3000):
        n = int(rng.integers(1, 60))
        x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        drop, add = int(rng.integers(0, 4)), int(rng.integers(0, 5))
        y = np.unique(np.concatenate([rng.permutation(x)[drop:], rng.integers(0, 2**63, add, dtype=np.uint64)]))
        common = len(np.intersect1d(x, y))
        if not len(y) or not bound.linked(len(x), len(y), common):
            continue
        often = rng.random() * 1.2
        found = []
        for own in (x, y):
            rare = (own * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) / 2**24 >= often
            found.append({(k, int(s)) for k, some in ngram_join.signatures(own, rare, bound) for s in some})
        assert found[0] & found[1]
