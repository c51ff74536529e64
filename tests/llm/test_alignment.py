import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.tables import awkward, documents, prose
from tidelake.llm import alignment, bpe

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def ranges(tokens):
    at, out = 0, []
    for t in tokens:
        out.append((at, at + len(t)))
        at += len(t)
    return out


def plain_tokens(text, a, b, letters):
    """Ids and byte ranges of both sides by the libraries; None where the bytes do not agree."""
    ids = a.encode(" " + text, add_special_tokens=False).ids
    left = [bytes(letters[c] for c in a.id_to_token(k)) for k in ids]
    pieces = b.encode(text)
    right = [bytes([int(p[3:5], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode() for k, p in
             ((k, b.id_to_piece(k)) for k in pieces)]
    if b"".join(left) != (" " + text).encode() or b"".join(right) != (" " + text).encode():
        return None
    return ids, pieces, ranges(left), ranges(right)


def brute_force(rows):
    a, b, letters = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), bpe.byte_letters()
    a.encode_special_tokens = True
    held, counts = [], Counter()
    for doc, text in rows:
        tokens = plain_tokens(text, a, b, letters) if text else None
        links, groups = [], []
        if tokens:
            ids, pieces, left, right = tokens
            links = [(i, j) for i, (p, q) in enumerate(left) for j, (r, s) in enumerate(right) if p < s and r < q] if len(ids) < 3000 else None
            if links is None:  # long texts: only neighbours can overlap
                links, low = [], 0
                for i, (p, q) in enumerate(left):
                    while right[low][1] <= p:
                        low += 1
                    j = low
                    while j < len(right) and right[j][0] < q:
                        links.append((i, j))
                        j += 1
            ends = sorted({q for _, q in left} & {s for _, s in right})
            groups, p, r = [], 0, 0
            for end in ends:
                p2 = next(k for k in range(p, len(left)) if left[k][1] == end) + 1
                r2 = next(k for k in range(r, len(right)) if right[k][1] == end) + 1
                groups.append((ids[p:p2], pieces[r:r2]))
                p, r = p2, r2
            counts.update((ids[i], pieces[j]) for i, j in links)
        held.append((doc, tokens, links, groups))
    top = defaultdict(int)
    for (_, j), n in counts.items():
        top[j] = max(top[j], n)
    out = []
    for doc, tokens, links, groups in held:
        if not tokens:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        ids, pieces = tokens[:2]
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        of = [counts[ids[i], pieces[j]] for i, j in links]
        best = sum(n == top[pieces[j]] for n, (_, j) in zip(of, links, strict=True))
        out.append((doc, len(ids), len(pieces), len(groups), len(links), best, sum(of), hashlib.sha256(shown.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


def texts(seed):
    rng = random.Random(seed)
    rows = [(100 + k, prose(rng, rng.choice([1, 5, 80]))) for k in range(25)]
    odd = ["<|endoftext|> a<s>b</s> <unk> <0x41>", "  two  spaces ", "▁ mark", "ﬁne ﬀ Å", "\n\n\ttabs\r\n", "naïve café 中文字 😀😀 éé",
           "don't we'll I'M 12345 3.14", "a" * 3000, "ab" * 700, "​﻿"]
    return rows + [(200 + k, t) for k, t in enumerate(odd)] + [(300, rows[0][1]), (300, rows[0][1])]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_LINKS", 500)
    rows = texts(1) + awkward()
    found = alignment.counted(documents(spark, rows).repartition(4), A, B).select(*COLUMNS)
    assert sorted(map(tuple, found.collect()), key=repr) == brute_force(rows)


def test_short_lanes_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(alignment, "LANE", 3)
    rows = texts(2)
    found = alignment.counted(documents(spark, rows).repartition(2), A, B).select(*COLUMNS)
    assert sorted(map(tuple, found.collect()), key=repr) == brute_force(rows)


def test_links_and_cuts_of_each_text(spark):
    rows = [r for r in texts(3) if r[0] != 300]
    a, b, letters = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), bpe.byte_letters()
    a.encode_special_tokens = True
    found = {r["doc_id"]: r for r in alignment.alignments(documents(spark, rows), A, B).collect()}
    for doc, text in rows:
        tokens, row = plain_tokens(text, a, b, letters), found[doc]
        if tokens is None:
            assert row["a_ids"] == row["link_a"] == row["cut_b"] == []
            continue
        ids, pieces, left, right = tokens
        assert (row["a_ids"], row["b_ids"]) == (ids, pieces)
        for i, j in zip(row["link_a"], row["link_b"], strict=True):
            assert left[i][0] < right[j][1] and right[j][0] < left[i][1]
        for p, q in zip(row["cut_a"], row["cut_b"], strict=True):
            assert left[p - 1][1] == right[q - 1][1]
        assert (row["cut_a"][-1], row["cut_b"][-1]) == (len(ids), len(pieces))


def test_empty_table(spark):
    assert alignment.counted(documents(spark, []), A, B).count() == 0
    assert alignment.alignments(documents(spark, []), A, B).count() == 0
