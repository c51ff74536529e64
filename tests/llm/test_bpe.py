import base64
import hashlib
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tests.llm.tables import awkward, documents
from tidelake.llm import bpe
from tidelake.llm.textbytes import slices

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ALPHABET = ["'", "s", "t", "re", "ve", "ll", "d", "m", " ", "  ", "\n", "\t", "\r\n", "a", "É", "1", "٣", "!", "...", "\u00a0", "　", "😀",
            "\x1c", "\x85", "_", "<|endoftext|>", "中文", "'S", "x" * 40, "\u200b", "word", "The", "123"]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(1)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(40))) for _ in range(1500)] + [
        t or "" for _, t in awkward()] + ["a" * 5000, "ab" * 3000, " " * 3000, "!?" * 700, "0123456789" * 50, "'s's''s 's\n's"]


def encode(merges, rows):
    encoder, out = bpe.Encoder(merges), []
    for _, _, data, offsets in slices(pa.array(rows), 4000):
        ids, at = encoder.encode(data, offsets)
        out += [ids[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    return encoder, out


def test_equals_tiktoken_and_decodes(library):
    rows = texts()
    encoder, found = encode(bpe.read_ranks(RANKS), rows)
    assert [x.tolist() for x in found] == [library.encode_ordinary(t) for t in rows]
    assert [encoder.decode(x).decode() for x in found] == rows


def test_long_pieces_of_varied_letters(library):
    """Pieces of random letters and signs, one of a hundred thousand."""
    rng = random.Random(3)
    rows = ["".join(rng.choices(letters, k=n)) for letters in ("abcdefghijklmnopqrstuvwxyz", "aab", "!#$%&()*+,-./", "eéßтест中")
            for n in (65, 66, 200, 3000)] + ["".join(rng.choices("etaoinshrdlu", k=100_000))]
    encoder = bpe.Encoder(bpe.read_ranks(RANKS))
    want = [library.encode_ordinary(t) for t in rows]
    assert [encoder.long_piece(encoder.merges.bytes_ids[np.frombuffer(t.encode(), np.uint8)]).tolist() for t in rows] == want
    encoder.final[:] = False  # one merge at a time, as a vocabulary in any order needs
    assert [encoder.long_piece(encoder.merges.bytes_ids[np.frombuffer(t.encode(), np.uint8)]).tolist() for t in rows[:16]] == want[:16]


def test_equals_tokenizers():
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    rows = texts()
    _, found = encode(bpe.read_merges(public_tokenizers.path("byte_bpe_50k.json")), rows)
    assert [x.tolist() for x in found] == [e.ids for e in library.encode_batch(rows, add_special_tokens=False)]


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    rows = texts()[:300]
    _, found = encode(bpe.read_ranks(RANKS), rows)
    assert [x.tolist() for x in found] == [library.encode_ordinary(t) for t in rows]


def test_round_trip(spark, library):
    rows = awkward()
    found = bpe.round_trip(documents(spark, rows), bpe.read_ranks(RANKS)).collect()
    want = []
    for doc, text in rows:
        ids = np.array(library.encode_ordinary(text or ""), "<u4")
        want.append((doc, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    assert bpe.round_trip(documents(spark, []), bpe.read_ranks(RANKS)).count() == 0
