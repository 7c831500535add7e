from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from saleswh.llm import near_duplicates as near
from saleswh.llm import repeated_bytes as rep
from saleswh.llm.components import connected_components
from tests.llm.fixtures import documents, odd_rows, words


def _shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def _copies():
    """Exact copies, near copies of several strengths, and a family of mutually weaker copies."""
    pick = random.Random(4)
    rows = odd_rows()
    at = 1
    for base in range(6):
        text = words(base, 60, 10**6)
        for edits in (0, 0, 1, 1, 2, 2, 3, 4, 6):
            copy = list(text)
            for _ in range(edits):
                copy[pick.randrange(60)] = f"e{pick.random()}"
            rows.append((at * 3, " ".join(copy).upper() if at % 4 == 0 else "  ".join(copy)))
            at += 1
    rows += [(7000 + i, " ".join(words(900 + i, 30, 10**6))) for i in range(20)]
    return rows


@pytest.mark.parametrize("crowded", [64, 2])
def test_groups_equal_brute_force(spark, monkeypatch, crowded):
    monkeypatch.setattr(near, "MOST_IN_BUCKET", crowded)
    rows = _copies()
    sets = [_shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                root[find(a)] = find(b)
    want = []
    for i, (doc, _) in enumerate(rows):
        group = [doc] if not sets[i] else [d for j, (d, _) in enumerate(rows) if sets[j] and find(j) == find(i)]
        smallest = min((d for d in group if d is not None), default=None)
        want.append((doc, len(sets[i]), smallest, None if smallest is None else doc == smallest))
    docs = documents(spark, rows)
    found = [tuple(r) for r in near.near_duplicate_groups(docs).collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    left = near.one_of_each_group(docs)
    assert left.schema == docs.schema
    groups = {find(i): [] for i in range(len(rows)) if sets[i]}
    for i, (doc, _) in enumerate(rows):
        if sets[i]:
            groups[find(i)].append(doc)
    stay = [d for i, (d, _) in enumerate(rows) if not sets[i]]
    stay += [min(ids, key=lambda d: (d is None, d or 0)) for ids in groups.values()]
    assert sorted(r.doc_id or -1 for r in left.collect()) == sorted(d or -1 for d in stay)


def test_rows_without_id_and_repeated_rows_leave_one(spark):
    """Each group leaves one row, whatever its ids; a column may have any name."""
    text = " ".join(words(1, 40, 10**6))
    other = [" ".join(words(10 + i, 40, 10**6)) for i in range(300)]
    rows = [(None, t) for t in other for _ in range(2)] + [(None, text)] * 400
    rows += [(1, text + " more"), (1, text + " more"), (2, text), (3, "few words"), (3, "few words"), (None, ""), (None, "")]
    full = [(i, t, 7, "x") for i, t in rows]
    docs = spark.createDataFrame(full, "doc_id long, text string, _id int, fate string").repartition(5)
    left = near.one_of_each_group(docs)
    assert left.columns == docs.columns
    found = left.collect()
    assert sorted((r.doc_id or 0, r.text) for r in found) == sorted(
        [(0, t) for t in other] + [(1, text + " more"), (3, "few words"), (0, ""), (0, "")]
    )
    assert {(r["_id"], r["fate"]) for r in found} == {(7, "x")}


def test_no_documents_no_groups(spark):
    assert near.near_duplicate_groups(documents(spark, [])).count() == 0
    assert rep.without_repeats(documents(spark, [])).count() == 0


def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200)]
    links += [(5, 5), (None, 3), (300, 301)]
    found = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200, 202: 200, 300: 300, 301: 300}
    assert {r.node: r.component for r in found} == want and len(found) == len(want)


@pytest.mark.parametrize("most", [256, 1])
def test_removed_bytes_equal_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(rep, "MOST_CONTENTS", most)
    pick = random.Random(8)
    passage = " ".join(words(50, 50, 10**6))
    rows = odd_rows() + [
        (1, "a" * 700), (2, "ab" * 130), (3, "a" * 199), (4, "é" * 150 + "x" + "é" * 150),
        (5, " ".join(words(60, 200, 10**6))), (6, " ".join(words(60, 200, 10**6))),
        (7, (" ".join(words(61, 30, 10**6)) + "\n") * 3), (8, passage), (9, passage[:250]),
    ]
    rows += [(20 + i, f"{' '.join(words(70 + i, 9, 10**6))} {passage[pick.randrange(20):]} {i}") for i in range(12)]
    data = [(t or "").encode() for _, t in rows]
    counts: dict[bytes, int] = {}
    for d in data:
        for i in range(len(d) - 199):
            counts[d[i : i + 200]] = counts.get(d[i : i + 200], 0) + 1
    want = []
    for (doc, _), d in zip(rows, data, strict=True):
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - 199):
            if counts[d[i : i + 200]] > 1:
                gone[i : i + 200] = True
        rest = bytes(np.frombuffer(d, np.uint8)[~gone[:-1]])
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        want.append((doc, len(d), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest(), rest))
    found = [(*tuple(r)[:5], bytes(r.kept_data)) for r in rep.without_repeats(documents(spark, rows)).collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)
