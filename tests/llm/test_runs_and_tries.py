"""Periodic runs, exact groups and prefix tries against plain versions."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from saleswh.llm import exact_dedup, periodic_runs, prefix_trie

from . import fixtures

BLANKS = " \t\n\x0b\x0c\r"


def _plain_runs(words):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _plain_row(doc_id, text):
    words = (text or "").encode().split()
    words = [w.decode() for w in words]
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = _plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    return (
        doc_id, len(runs), *best, None if not runs else 1000 * best[1] // best[2],
        _sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), _sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def _periodic_texts():
    pick = random.Random(5)
    rows = fixtures.odd_rows()
    rows += [(i, " ".join(pick.choices("abc", k=pick.randrange(120)))) for i in range(120)]
    rows += [(200 + i, " ".join(pick.choices("ab", k=i)) + " x y z" * (i % 9)) for i in range(60)]
    rows += [(300, "a " * 50), (301, "a b " * 30 + "a c " * 30), (302, "a a a a a"), (303, "a a a a a a"), (304, "a b a b a b a b")]
    rows += [(305, "\t".join(["x y z"] * 4 + ["q"] * 7)), (306, ("a a b " * 4 + "c ") * 5)]
    rows += [(400 + i, " ".join(fixtures.words(i, 300, 30))) for i in range(60)]
    return rows


def test_runs_of_random_words_are_all_found():
    pick = np.random.default_rng(3)
    for trial in range(60):
        texts = [pick.integers(0, 2 + trial % 3, pick.integers(0, 90)) for _ in range(5)]
        texts = [np.concatenate([t, np.tile(t[: 1 + trial % 4], trial % 7)]) for t in texts]
        document = np.repeat(np.arange(5), [len(t) for t in texts])
        start, length, period = periodic_runs.runs_in(np.concatenate(texts), document)
        edges = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        found = [
            [(s - edges[i], n, q) for s, n, q in zip(start, length, period, strict=True) if edges[i] <= s < edges[i + 1]]
            for i in range(5)
        ]
        assert found == [_plain_runs(t.tolist()) for t in texts]


def test_run_digests(spark):
    rows = _periodic_texts()
    found = periodic_runs.run_digests(fixtures.documents(spark, rows))
    assert found.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    ]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(repr(_plain_row(*row)) for row in rows)
    assert periodic_runs.run_digests(fixtures.documents(spark, [])).count() == 0


def test_collapsed_texts_and_spans(spark):
    found = periodic_runs.collapse_runs(fixtures.documents(spark, [(1, "so  la la la la la la\tend"), (2, None)])).collect()
    by_id = {r.doc_id: r for r in found}
    assert by_id[1].collapsed == "so la end" and [tuple(r) for r in by_id[1].runs] == [(1, 6, 1)]
    assert by_id[2].collapsed == "" and by_id[2].runs == [] and by_id[2].strongest is None


def test_a_long_periodic_text_takes_little_time():
    words = np.tile(np.arange(3), 100_000)
    start, length, period = periodic_runs.runs_in(words, np.zeros(len(words), np.int64))
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [300_000], [3])


def _plain_groups(rows):
    bare = ["".join(c for c in text or "" if c not in BLANKS) for _, text in rows]
    out = []
    for (doc_id, _), own in zip(rows, bare, strict=True):
        same = [r for r, b in zip(rows, bare, strict=True) if b == own]
        keep = min(same, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        out.append((doc_id, keep[0], len(same), _sha(own)))
    return out


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_exact_groups(spark, partitions):
    pick = random.Random(9)
    rows = fixtures.odd_rows() + [(None, "no id here  but some words to read"), (-5, "twice the same row of words")]
    rows += [(i, pick.choice(["a b", "ab", " a\tb ", "A b", "c", "hot text"] + ["hot text"] * 6)) for i in range(300)]
    rows += [(1000 + i, f"own {i}") for i in range(100)]
    documents = fixtures.documents(spark, rows).repartition(partitions)
    found = exact_dedup.exact_groups(documents).collect()
    assert sorted(repr((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in found) == sorted(
        map(repr, _plain_groups(rows))
    )
    # One row of each group stays, and it is the one named.
    stay = [r for r in found if r.kept]
    assert len(stay) == len({r.text_sha256 for r in found}) and all(r.doc_id == r.keep_id for r in stay)
    assert exact_dedup.exact_groups(fixtures.documents(spark, [])).count() == 0


def test_exact_groups_equal_their_sql(spark):
    sf = "/root/testdata/sf0.01"
    found = exact_dedup.exact_groups(spark.read.parquet(f"{sf}/documents.parquet"))
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    wanted = duckdb.sql(exact_dedup.GROUPS_SQL)
    assert found.columns == wanted.columns
    assert sorted(map(tuple, found.collect())) == sorted(wanted.fetchall())


def _plain_nodes(rows, order):
    turns: dict = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, *order(role or "", text or "")))
    own = {c: [t[3:] for t in sorted(found)] for c, found in turns.items()}
    rebuilt = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - c % 20, [])[:h] + t[h:]
    members: dict = {}
    for c, t in rebuilt.items():
        for d in range(len(t) + 1):
            members.setdefault(tuple(t[:d]), []).append(c)
    below: dict = {}
    for node in members:
        if node:
            below.setdefault(node[:-1], []).append(node)

    def subtree(node):
        yield node
        for child in below.get(node, []):
            yield from subtree(child)

    out = []
    for node, convs in members.items():
        whole = list(subtree(node))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(below.get(node, [])),
            sum(n not in below for n in whole),
            sum((len(members[n]) - 1) * (len(n[-1][1].encode().split()) if n else 0) for n in whole),
            _sha(",".join(map(str, sorted(c for c in convs if len(rebuilt[c]) == len(node))))),
        ))
    return out


def _by_digest(role, text):
    return (hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest(), role, text)


def _conversations():
    pick = random.Random(11)
    rows = [(c, t, pick.choice(["user", "assistant"]), pick.choice(["hi", "hi you", "a b c", "", " "])) for c in range(130)
            for t in range(pick.randrange(7))]
    rows += [(c, t, "user", "the same words") for c in range(200, 240) for t in range(c % 5)]
    rows += [(300, t, "user", f"long {t}") for t in range(90)] + [(301, t, "user", f"long {t}") for t in range(88)]
    rows += [(500, None, "user", "null turn"), (500, 1, None, None), (500, 1, "user", "tie"), (500, 1, "user", "tie")]
    rows += [(None, 1, "user", "nobody"), (-7, 0, "user", "minus"), (-20, 0, "user", "minus twenty")]
    rows += [(10**12 + i, 0, "user", "alone") for i in range(45)]
    pick.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("trie_turns", [1, 150, 10**6])
def test_prefix_nodes(spark, monkeypatch, trie_turns):
    monkeypatch.setattr(prefix_trie, "TRIE_TURNS", trie_turns)
    rows = [r for r in _conversations() if r[0] is None or r[0] >= 0]
    table = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA + ", depth int, s1 long, conv string")
    found = prefix_trie.prefix_nodes(table)
    assert found.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    ]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, _plain_nodes(rows, _by_digest)))


def test_prefix_nodes_of_nothing(spark):
    assert prefix_trie.prefix_nodes(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie.prefix_nodes(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0
    # One turn that its head drops, and no conversation to take one from: only the root is left.
    c = next(c for c in range(1, 100) if c % 20 and prefix_trie.head_turns(c))
    found = prefix_trie.prefix_nodes(spark.createDataFrame([(c, 1, "a", "b")], SCHEMA)).collect()
    assert [tuple(r) for r in found] == [(c, 0, None, 1, 0, 1, 0, _sha(str(c)))]


def test_fat_binary_search_finds_where_a_sequence_leaves():
    pick = random.Random(2)
    sequences = [[0]]
    for _ in range(400):
        base = pick.choice(sequences)
        cut = pick.randrange(len(base))
        sequences.append(base[: cut + 1] + [pick.randrange(1, 9) for _ in range(pick.randrange(40))])
    signed = [[hash(tuple(s[: i + 1])) for i in range(len(s))] for s in sequences]
    trie = prefix_trie.ZFastTrie(lambda example: signed[example])
    for example, own in enumerate(signed):
        known = {x for s in signed[:example] for x in s} | {own[0]}
        agreed = max(i for i, x in enumerate(own) if x in known)
        node, length = trie.exit_node(own)
        assert length == agreed and trie.start[node] < max(length, 1) and length <= trie.extent[node]
        trie.insert(example)
    assert len(trie.handles) == len(trie.extent) - 1
