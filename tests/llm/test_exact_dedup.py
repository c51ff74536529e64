import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.tables import awkward, documents
from tidelake.llm import exact_dedup


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]+", "", text or "")


def decide(spark, rows, past):
    stored = exact_dedup.digested(documents(spark, rows).repartition(3))
    out = exact_dedup.deduplicated(stored, past)
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("sha")).collect()


@pytest.mark.parametrize("past", [exact_dedup.earlier_half, lambda: F.lit(True), lambda: F.lit(False)])
def test_equals_brute_force(spark, past):
    rows = awkward() + [(100 + i, "copy of  a\ttext" if i % 3 else f"text {i % 7}") for i in range(60)] + [(50, "copyofatext   ")]
    groups = {}
    for doc, text in rows:
        groups.setdefault(normalised(text), []).append((-len(text or ""), doc is None, doc or 0))
    found = decide(spark, rows, past())
    assert len(found) == len(rows)
    for doc, text in rows:
        own = normalised(text)
        best = min(groups[own])
        mine = [r for r in found if r.doc_id == doc and r.sha == hashlib.sha256(own.encode()).hexdigest()]
        assert {(r.keep_id, r.group_size) for r in mine} == {(None if best[1] else best[2], len(groups[own]))}
    kept = [r for r in found if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)


def test_empty_table(spark):
    assert decide(spark, [], F.lit(True)) == []


def test_perfect_hash_is_minimal_and_bytes_tell_strangers():
    keys = np.random.default_rng(1).integers(0, 2**63, (5000, 4), dtype=np.uint64)
    hashed = exact_dedup.PerfectHash.load(*exact_dedup.PerfectHash.build(keys).dump())
    slots = hashed.lookup(keys)
    assert sorted(slots) == list(range(5000)) and hashed.slots == 5000
    table = np.empty_like(keys)
    table[slots] = keys
    strangers = np.random.default_rng(2).integers(0, 2**63, (5000, 4), dtype=np.uint64)
    at = hashed.lookup(strangers)
    assert not ((at >= 0) & (table[at] == strangers).all(axis=1)).any()
    with pytest.raises(ValueError):
        exact_dedup.PerfectHash.build(np.repeat(keys[:1], 2, axis=0))
