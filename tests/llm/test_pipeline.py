from __future__ import annotations

import zlib

import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline
from saleswh.llm import secrets
from tests.llm.fixtures import SCHEMA, odd_rows, words
from tests.llm.test_tokens import BYTE, encoded

pytest.importorskip("public_tokenizers")


def test_every_stage_takes_effect(spark, tmp_path):
    prose = lambda seed: "The sun and the moon are of a kind.\n" + " ".join(["the", *words(seed, 80, 10**6)]) + "."
    passage = " ".join(words(999, 40, 10**6))
    texts = {i: prose(i) for i in range(20)}
    texts |= {30: texts[3], 31: texts[4] + " tail", 40: prose(40) + " " + passage, 41: " | ".join(words(41, 90, 10**6))}
    texts |= {50: prose(50) + " password=abcdefghijkl123", 60: None, 61: "", None: prose(61)}
    rows = [(i, t, "en", "s", None if t is None else len(t), 1, "k", 2, None, "t") for i, t in texts.items()]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, str(tmp_path))
        assert found.columns == docs.columns
        found.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        left[name] = {r.doc_id: r.text for r in docs.collect()}
    assert set(texts) - set(left["quality_rules"]) == {41, 60, 61}
    assert set(left["quality_rules"]) - set(left["near_dedup"]) == {30, 31}
    assert set(left["near_dedup"]) - set(left["decontaminate"]) == {40}
    assert set(left["decontaminate"]) == set(left["secret_scan"])
    assert left["secret_scan"][50] == secrets.redacted(texts[50], secrets.find_spans(texts[50])[1], "[secret]") != texts[50]
    _check_pieces(corpus_pipeline.run(spark, str(tmp_path)).collect(), left["secret_scan"])


def _check_pieces(packed, texts):
    """Every piece of every text, by ids, checksum and place."""
    order = list(texts)
    ids = dict(zip(order, encoded(BYTE, [texts[i] for i in order]), strict=True))
    pieces, sequences = {}, {}
    for r in packed:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for doc_id, found in pieces.items():
        own = np.array([*ids[doc_id], 0], "<u4")
        found.sort(key=lambda r: r.piece)
        assert [r.piece for r in found] == list(range(len(found))) and sum(r.length for r in found) == len(own)
        assert len(found) == -(-len(own) // 2048) and all(r.length == 2048 for r in found[1:])
        at = 0
        for r in found:
            assert r.start == at and r.ids_crc32 == zlib.crc32(own[at : at + r.length].tobytes())
            at += r.length
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def test_an_empty_table_goes_through_all_stages(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, str(tmp_path))
        assert found.columns == docs.columns and found.count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_odd_rows_and_clashing_names_go_through(spark, tmp_path):
    prose = "The sun and the moon are of a kind.\n" + " ".join(["the", *words(3, 3000, 10**6)]) + "."
    rows = [(i, t) for i, t in odd_rows()] + [(1, prose), (1, prose), (2, prose), (None, prose), (None, None)]
    names = ["_id", "_row", "fate", "vote_length", "n_words", "cls", "row", "key", "sets", "spans"]
    full = [(i, t, *range(len(names))) for i, t in rows]
    schema = "doc_id long, text string, " + ", ".join(f"{n} int" for n in names)
    spark.createDataFrame(full, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, None), (None, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, str(tmp_path))
        assert found.columns == docs.columns
        found.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert [(r.doc_id, r.text, r["_id"], r["spans"]) for r in docs.filter("text LIKE 'The sun%'").collect()] == [(1, prose, 0, 9)]
    assert corpus_pipeline.run(spark, str(tmp_path)).filter("doc_id = 1").groupBy().sum("length").first()[0] > 3000


def test_all_operators_are_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
