"""Small tables with the odd cases every operator has to take."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "row long, key string, length int, set_id int, task string"
)


def documents(spark, rows):
    """Documents from ``(doc_id, text)`` pairs, with further columns whose names operators use themselves."""
    full = [
        (i, t, "en", None, None if t is None else len(t), 1, "k", 2, None, "t") for i, t in rows
    ]
    return spark.createDataFrame(full, SCHEMA)


def words(seed: int, n: int, kinds: int = 400) -> list[str]:
    pick = random.Random(seed)
    return [f"w{pick.randrange(kinds)}x" for _ in range(n)]


def odd_rows():
    long = " ".join(words(1, 6000, 3000))
    return [
        (None, "no id here but some words to read"),
        (None, None),
        (10**9, None),
        (10**9 + 1, ""),
        (10**9 + 2, " \t\n "),
        (10**9 + 3, long),
        (10**9 + 4, "twice the same row of words"),
        (10**9 + 4, "twice the same row of words"),
        (10**9 + 5, "Ünïcode wörds — ñ  two  blanks\x0b\x0cand more"),
    ]
