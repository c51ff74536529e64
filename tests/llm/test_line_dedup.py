import hashlib
import itertools
import random
import re

import pytest

from tests.llm.tables import awkward, documents
from tidelake.llm import line_dedup


def line_hash(line):
    return int(hashlib.md5(line.encode()).hexdigest()[:15], 16)


def brute_force(rows, k, window, long=line_dedup.LONG):
    """Straight from the definition, over distinct (doc_id, text) rows: every maximal common run of two places, one by one."""
    def me(doc, text):
        own = hashlib.md5(text.encode()).hexdigest()
        return hashlib.md5(("|".join(([str(doc)] if doc is not None else []) + [own])).encode()).digest()

    docs, chosen = {}, {}
    for doc, text in set(rows):
        if text is None:
            continue
        lines = [(at, line_hash(x.strip(" \t\r")), len(re.findall(line_dedup.WORD, x))) for at, x in enumerate(text.split("\n"))
                 if x.strip(" \t\r")]
        name = (doc is None, doc or 0, me(doc, text))
        docs[name] = lines
        grams = [tuple(h for _, h, _ in lines[i:i + k]) for i in range(len(lines) - k + 1)]
        chosen[name] = {-min((grams[i], -i) for i in range(s, min(s + window, len(grams))))[1]
                        for s in range(max(1, len(grams) - window + 1))} if grams else set()
    dead = {name: set() for name in docs}
    for name, own in docs.items():
        for other, theirs in docs.items():
            for shift in range(1 if other == name else 1 - len(theirs), len(own)) if other <= name else ():
                same = [0 <= i - shift < len(theirs) and theirs[i - shift][1] == own[i][1] for i in range(len(own))]
                for equal, run in itertools.groupby(range(len(own)), lambda i: same[i]):
                    run = list(run)
                    shared = any(i in chosen[name] and i - shift in chosen[other] for i in run[:len(run) - k + 1])
                    if equal and (shared or sum(own[i][2] for i in run) >= long or len(own) == len(theirs) == 1):
                        dead[name] |= {own[i][0] for i in run}
    out = []
    for doc, text in rows:
        if text is None:
            out.append((doc, 0, 0, None))
            continue
        lines, gone = text.split("\n"), dead[(doc is None, doc or 0, me(doc, text))]
        out.append((doc, len(lines), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    shared = [[f"shared {p} {i}" for i in range(rng.randrange(1, 9))] for p in range(6)]
    wordy = [" ".join(f"w{p}{i}" for i in range(n)) for p, n in enumerate((49, 50, 60, 48))]
    rows = []
    for doc in range(120):
        lines = []
        for _ in range(rng.randrange(6)):
            part = rng.choice(shared)
            cut = rng.randrange(len(part))
            lines += rng.choice([part, part[cut:], part[:cut + 1], [wordy[cut % 4]], [wordy[cut % 4], "short"], [f"own {doc} {rng.randrange(50)}"], ["", "  "], ["license line"]])
        rows.append((doc, "\n".join(f" {x}" if rng.random() < 0.2 else x for x in lines)))
    return rows + [(300 + i, "license line\nsecond line\nthird line") for i in range(60)] + [(400, "again\n" * 40), (401, "one\ntwo\n" * 9), (402, wordy[2]), (403, f" {wordy[2]}"), (404, "only"), (405, "only\n\n")] + awkward()


@pytest.mark.parametrize("k, window", [(2, 2), (1, 1), (3, 4)])
def test_equals_brute_force(spark, k, window):
    rows = corpus(k)
    found = line_dedup.deduplicated(documents(spark, rows).repartition(4), k, window).collect()
    assert sorted(map(tuple, found), key=repr) == brute_force(rows, k, window)


def test_runs_that_winnowing_guarantees_go(spark):
    """A run of window + k - 1 lines that an earlier document holds loses its lines, and the first copy stays whole."""
    run = [f"line {i}" for i in range(3)]
    rows = [(1, "\n".join(["a", *run, "b"])), (2, "\n".join(["c", "d", *run])), (3, "\n".join([*run, "e"]))]
    texts = {r.doc_id: r.text for r in line_dedup.deduplicated(documents(spark, rows)).collect()}
    assert texts == {1: rows[0][1], 2: "c\nd", 3: "e"}


def test_long_passages_go_whatever_their_lines(spark):
    """Over 50 words in one line or in two go, beside unlike lines and in documents of one line; the first copy stays."""
    one, two = " ".join(f"a{i}" for i in range(51)), [" ".join(f"{c}{i}" for i in range(26)) for c in "bc"]
    rows = [(1, "\n".join(["x", one, "y", *two, "z"])), (2, one), (3, "\n".join([*two, "q"])), (4, "\n".join(["r", one, "s"])), (5, "t"), (6, "t")]
    texts = {r.doc_id: r.text for r in line_dedup.deduplicated(documents(spark, rows)).collect()}
    assert texts == {1: rows[0][1], 2: "", 3: "q", 4: "r\ns", 5: "t", 6: ""}


def test_many_equal_lines_cost_rows_in_proportion(spark):
    text = "again\n" * 50_000 + "one\ntwo\n" * 5_000
    [row] = line_dedup.deduplicated(documents(spark, [(1, text)])).collect()
    assert (row.n_lines, row.n_deleted, row.text) == (60_001, 59_997, "again\none\ntwo\n")
    plain = documents(spark, [(1, "again\n" * 1000), (2, "again\n" * 1000)])
    assert line_dedup.fingerprints(line_dedup.sequences(plain), 2, 2, 50).count() <= 2 * 1000


def test_empty_table_and_native_plan(spark):
    out = line_dedup.deduplicated(documents(spark, []))
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
