from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from saleswh.llm import packing, token_counts, token_files
from saleswh.llm.encoding import ChunkEncoder
from tests.llm.fixtures import documents, odd_rows, words

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
BYTE, WORD = public.path("byte_bpe_50k.json"), public.path("word_bpe_49k.json")

ODD = [
    "", "a  b", " x", "x ", "a\n b", "a <|endoftext|> b", "x<|endoftext|>y z", "é a", "\0 a b\0", "I'LL don't 's",
    "a  b", "q\n", "\nq w", None, "Ab, cd. ef,. g", "x.\nY z.\n\nW", "１２ ３", "ß Ñu ÿ, ÇA.",
]


def encoded(path, texts):
    tokenizer = tokenizers.Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_chunks_have_the_ids_of_whole_texts(path):
    texts = ODD + [" ".join(words(i, 40)) + ".\n" + " ".join(words(i + 1, 9)) for i in range(20)] + ODD
    for known in (10**6, 5):
        encoder = ChunkEncoder(path, known)
        for _ in range(2):
            found = []
            for ids, edges in encoder.encode(pa.array(texts), block_bytes=200, chunks=30):
                found += [ids[a:b].tolist() for a, b in zip(edges[:-1], edges[1:], strict=True)]
            assert found == encoded(path, texts)
            assert encoder.count(pa.array(texts)).tolist() == [len(x) for x in found]


def test_a_full_memory_keeps_what_was_met_again():
    encoder = ChunkEncoder(BYTE, 100)
    often = [f"often{i}" for i in range(20)]
    most = 0
    for turn in range(30):
        text = " ".join(["x", *often, *(f"once{turn}n{i}" for i in range(30))])
        ((ids, _),) = encoder.encode(pa.array([text]))
        assert ids.tolist() == encoded(BYTE, [text])[0]
        most = max(most, len(encoder.codes))
        if turn > 1:
            assert set(often) <= set(encoder.codes)
    assert most <= 200


def _rows():
    return odd_rows() + [(i, " ".join(words(i, 1 + i * 37 % 300))) for i in range(150)]


def test_pieces_are_whole_and_sequences_are_gapless(spark):
    rows = _rows()
    found = packing.pack(documents(spark, rows), BYTE, capacity=128).collect()
    want = []
    for (doc, _), ids in zip(rows, encoded(BYTE, [t for _, t in rows]), strict=True):
        ids = ids + [0]
        first = len(ids) % 128 or 128
        for piece, start in enumerate([0, *range(first, len(ids), 128)]):
            part = ids[start : first if piece == 0 else start + 128]
            want.append((doc, piece, start, len(part), zlib.crc32(np.array(part, "<u4"))))
    assert sorted(map(repr, want)) == sorted(
        repr((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in found
    )
    sequences: dict[int, list] = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 128
    assert len(sequences) <= 1.01 * sum(r.length for r in found) / 128 + 1


def test_plans_place_every_document_once():
    pick = np.random.default_rng(3)
    for capacity, groups in ((64, 4), (500, 24)):
        counts = {int(i): int(n) for i, n in enumerate(pick.integers(0, 40, capacity + 1)) if i and n}
        for given in (counts, {capacity: 3}, {1: 5}, {capacity // 2 + 1: 7}, {}):
            ranks: dict[int, list[tuple[int, int]]] = {}
            for run, slots in packing.plan_packing(given, capacity, groups=groups):
                assert sum(length for length, _ in slots) <= capacity
                for length, first in slots:
                    ranks.setdefault(length, []).append((first, run))
            for length, n in given.items():
                at = 0
                for first, run in sorted(ranks[length]):
                    assert first == at
                    at += run
                assert at == n


def test_configurations_are_used_where_best_fit_wastes_room():
    """A half, a quarter and a rest fill a sequence, but best fit puts two halves' company apart."""
    sizes = [(1048, 180), (560, 180), (536, 180), (464, 360)]
    counts = {size - k: n // 4 for size, n in sizes for k in range(4)}
    # With few lengths nothing is rounded; with groups of about a hundred documents all are.
    for groups, most in ((24, 275), (9, 285)):
        assert sum(n for n, _ in packing.plan_packing(counts, 2048, groups=groups)) <= most
    pick = np.random.default_rng(6)
    many = dict(zip(*(x.tolist() for x in np.unique(pick.integers(400, 900, 9000), return_counts=True)), strict=True))
    for given in (counts, many):
        shortest = sum(n for n, _ in packing.plan_packing(given, 2048))
        assert shortest <= min(sum(n for n, _ in packing.plan_packing(given, 2048, slack=s)) for s in (64, 2048))
        assert shortest < 1.025 * sum(x * n for x, n in given.items()) / 2048
        placed = {}
        for run, slots in packing.plan_packing(given, 2048):
            assert sum(length for length, _ in slots) <= 2048
            for length, first in slots:
                placed.setdefault(length, []).append((first, run))
        for length, n in given.items():
            ends = [first + run for first, run in sorted(placed[length])]
            assert [first for first, _ in sorted(placed[length])] == [0, *ends[:-1]] and ends[-1] == n


def test_token_files_give_back_what_was_written(spark, tmp_path):
    rows = _rows()
    docs = documents(spark, rows)
    token_files.write_token_files(docs, WORD, str(tmp_path / "t"), 2, 49408, shard_ids=3000)
    shards = spark.read.parquet(str(tmp_path / "t"))
    found = token_files.read_token_files(shards).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, want = 0, []
    for (doc, _), ids in zip(order, encoded(WORD, [t for _, t in order]), strict=True):
        ids = ids + [2]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4"))))
        start += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == want
    row = max(shards.collect(), key=lambda r: r["n_docs"]).asDict()
    whole = token_files.decode_shard(row)
    edges = np.concatenate(([0], np.cumsum(np.frombuffer(row["doc_sizes"], "<i8"))))
    for at in range(row["n_docs"]):
        assert token_files.decode_document(row, at).tolist() == whole[edges[at] : edges[at + 1]].tolist()


def test_grammar_shortens_and_expands():
    ids = np.array([5] * 101 + [7, 5, 5] * 50 + [5] * 3 + [1, 2, 3, 4] * 40)
    symbols, rules = token_files.compress(ids, 10, least=2)
    assert len(symbols) < len(ids) / 4 and token_files.expand(symbols.astype(int), rules, 10).tolist() == ids.tolist()
    for short in ([], [3]):
        symbols, rules = token_files.compress(np.array(short, int), 10)
        assert token_files.expand(symbols.astype(int), rules, 10).tolist() == short


def test_pairs_are_replaced_until_none_pays():
    pick = np.random.default_rng(8)
    phrase = pick.integers(0, 300, 64)
    ids = np.concatenate([np.concatenate([phrase, pick.integers(0, 300, 3)]) for _ in range(200)])
    symbols, rules = token_files.compress(ids, 300)
    size = token_files.sizes_of(rules, 300)
    assert size.max() >= 64 and token_files.expand(symbols.astype(int), rules, 300).tolist() == ids.tolist()
    pairs = (symbols[:-1].astype(np.int64) << 32) | symbols[1:]
    # What is left over are runs of one symbol, counted once for every second place.
    apart = np.unique(pairs[symbols[:-1] != symbols[1:]], return_counts=True)[1]
    assert apart.max() < token_files.LEAST_USES
    marks = token_files.marks_of(symbols, size)
    for start, stop in ((0, 0), (0, 1), (5, 700), (len(ids) - 3, len(ids)), (0, len(ids))):
        found = token_files.expand_range(symbols, rules, 300, start, stop, size[300:], marks)
        assert found.tolist() == ids[start:stop].tolist()


def test_later_rounds_look_only_at_places_that_may_be_frequent(monkeypatch):
    pick = np.random.default_rng(5)
    ids = pick.integers(0, 40_000, 200_000).astype(np.uint32)
    phrase = np.arange(45_000, 45_008, dtype=np.uint32)
    for at in range(0, 199_000, 4000):
        ids[at : at + 8] = phrase
    looked, plain = [], token_files._frequent_pairs
    monkeypatch.setattr(
        token_files, "_frequent_pairs", lambda pair, *rest: looked.append(len(pair)) or plain(pair, *rest)
    )
    symbols, rules = token_files.compress(ids, 49408)
    assert np.array_equal(token_files.expand(symbols.astype(np.int64), rules, 49408), ids)
    assert len(symbols) == 200_000 - 50 * 7
    assert looked[0] == 199_999 and max(looked[1:]) < 10_000


def test_marks_shorten_the_way_to_a_document(monkeypatch):
    monkeypatch.setattr(token_files, "MARK_EVERY", 8)
    ids = np.random.default_rng(4).integers(0, 9, 500)
    symbols, rules = token_files.compress(ids, 10)
    size = token_files.sizes_of(rules, 10)
    marks = token_files.marks_of(symbols, size)
    assert len(marks) == -(-len(symbols) // 8)
    for start in range(0, 500, 7):
        found = token_files.expand_range(symbols, rules, 10, start, min(start + 30, 500), size[10:], marks)
        assert found.tolist() == ids[start : start + 30].tolist()


def test_length_totals(spark):
    rows = _rows()
    sizes = [len(x) + 1 for x in encoded(BYTE, [t for _, t in rows])]
    totals = token_counts.token_counts(documents(spark, rows), BYTE)
    for r in totals.collect():
        assert r.n_docs == sizes.count(r.n_tokens)
        assert r.docs_up_to == sum(s <= r.n_tokens for s in sizes)
        assert r.tokens_up_to == sum(s for s in sizes if s <= r.n_tokens)
        assert r.truncated_tokens == sum(min(s, r.n_tokens) for s in sizes)
        assert (r.total_docs, r.total_tokens) == (len(sizes), sum(sizes))
    assert token_counts.at_limit(totals, 77).first().kept_tokens == sum(min(s, 77) for s in sizes)
    assert token_counts.quantile_length(totals, 0.5).first()[0] == sorted(sizes)[-(-len(sizes) // 2) - 1]


def test_empty_tables(spark):
    none = documents(spark, [])
    assert packing.pack(none, BYTE).count() == 0
    assert token_files.token_round_trip(none, WORD, 2, 49408).count() == 0
    assert token_counts.token_counts(none, BYTE).count() == 0
