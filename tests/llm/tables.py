"""Small tables with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing column names."""

from __future__ import annotations

import random

CLASHING = "key of row n size digest blob path spans a b of_key short text_sha256 count me at unit item fill".split()


def documents(spark, rows):
    """(doc_id, text) rows with extra columns that have the operators' internal names."""
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(*row, *["x"] * len(CLASHING)) for row in rows], schema)


def awkward() -> list[tuple]:
    return [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "ONE "), (6, "two words"), (6, "two words"), (None, "two words"),
            (None, None), (7, "é à ü ß 中文 😀 'quoted' it's"), (8, "word " * 30_000), (9, "x" * 20_000), (10, "a\x00b\x1c\x85c")]


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(rng: random.Random, text: str, changes: int) -> str:
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
    return " ".join(words)
