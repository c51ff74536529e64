import random
import tracemalloc
import zlib
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.tables import awkward, documents, prose
from tidelake.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def rows_of(n):
    rng = random.Random(3)
    return awkward() + [(100 + i, prose(rng, rng.choice([1, 5, 20, 50, 100]))) for i in range(n)]


@pytest.mark.parametrize("length, units", [(2048, 50_000), (128, 40)])
def test_pieces_and_sequences(spark, length, units):
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    rows = rows_of(300)
    pieces = packing.token_pieces(documents(spark, rows).repartition(4), PATH, length)
    out = packing.packed(pieces, length, slack=2, units_per_task=units).collect()
    want = defaultdict(int)
    for doc, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        head = len(ids) % length or length
        edges = [0, *range(head, len(ids) + 1, length)]
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            want[(doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    found = defaultdict(int)
    for r in out:
        found[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)] += 1
    assert found == want
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for offset, size in sorted(items):
            assert offset == at
            at += size
        assert at <= length
    least = -(-sum(r.length for r in out) // length)
    assert len(bins) <= 1.06 * least + 1


def test_added_tokens_have_their_own_ids(spark):
    """The library in its default setting, on texts that hold the file's added token literally."""
    token = "<|endoftext|>"
    texts = [f"a{token}b", token, token * 3, f"é  {token}  it's\n{token}", f"x {token[:-1]}", f"{token[1:]} 'll", "plain", "", None,
             f"<{token}>", f"word {token} " * 3000]
    rows = [(k, t) for k, t in enumerate(texts)]
    library = Tokenizer.from_file(PATH)
    found = packing.token_pieces(documents(spark, rows).coalesce(1), PATH, 1 << 20).collect()
    want = [(k, np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")) for k, t in rows]
    assert 50256 in want[0][1]
    assert sorted((r.doc_id, r.length, r.ids_crc32) for r in found) == [(k, len(x), zlib.crc32(x.tobytes())) for k, x in want]


def test_best_fit_takes_the_tightest_room():
    bins, offsets = packing.best_fit(np.array([60, 50, 40, 30, 10]), 100)
    assert bins.tolist() == [0, 1, 0, 1, 1] and offsets.tolist() == [0, 0, 60, 50, 80]


def test_empty_table(spark):
    assert packing.packed(packing.token_pieces(documents(spark, []), PATH)).count() == 0


def test_pieces_that_never_fit_end(spark):
    """Units that no two fit together do not travel up the tree."""
    pieces = spark.range(500).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "1100L AS length", "0L AS ids_crc32")
    out = packing.packed(pieces, units_per_task=50)
    assert out.select("sequence_id").distinct().count() == out.count() == 500


def test_memory_of_a_task_does_not_grow_with_its_batch(spark):
    class Docs:  # gives the function that tasks run
        sparkSession = SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda x: SimpleNamespace(value=x)))
        select = lambda self, *columns: self
        mapInArrow = lambda self, run, schema: run

    rng = random.Random(5)
    words = [prose(rng, 1) for _ in range(2000)]
    texts = [" ".join(rng.choices(words, k=200)) for _ in range(5000)]
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts)})
    run = packing.token_pieces(Docs(), PATH)
    assert batch.nbytes > 3 << 20
    tracemalloc.start()
    assert sum(b.num_rows for b in run(iter([batch]))) >= len(texts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 90 << 20
