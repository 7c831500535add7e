"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are compared as word sequences (lower case,
letters and digits). Runs of five words that both share are the seeds. The
shared stretches of a document are then tiled on each item it shares seeds
with: the longest match that is not marked yet is marked on both sides, again
and again, found by running Karp-Rabin hashes of falling length. The share of
an item's words that tiles cover decides; their order does not matter, so
reordered passages count as well.

The benchmark goes to the tasks in blocks of bounded size, each a pass over the
documents; documents are never shuffled.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswh.llm.common import in_slices, per_batch

WORD = re.compile(r"[^\W_]+")
BASE = 0x9E3779B97F4A7C15
PAIRS = "doc_id long, item_id long, n_item_words long, covered_words long, n_tiles long, coverage double"


class _Vocabulary(dict):
    def __missing__(self, word: str) -> int:
        return 0


def word_codes(texts: pa.Array, code: Callable[[str], int]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the words of all texts, a 0 behind each text, and where each text starts.

    Arrow lowers and cuts the texts at blanks; only distinct chunks are searched for words.
    """
    cut = pc.split_pattern(pc.utf8_lower(pc.fill_null(texts, "")), " ")
    edges = cut.offsets.to_numpy().astype(np.int64)
    numbered = cut.flatten().dictionary_encode()
    found = [
        [code(x)] if x.isalnum() else [code(w) for w in WORD.findall(x)]
        for x in numbered.dictionary.to_numpy(zero_copy_only=False)
    ]
    size = np.fromiter(map(len, found), np.int64, len(found))
    flat = np.fromiter((c for chunk in found for c in chunk), np.int64, int(size.sum()))
    start = np.cumsum(size) - size
    chunk = numbered.indices.to_numpy()
    many = size[chunk]
    ends = np.concatenate(([0], np.cumsum(many)))
    at = np.arange(ends[-1]) + np.repeat(start[chunk] - ends[:-1], many)
    bounds = ends[edges - edges[0]]
    return np.insert(flat[at], bounds[1:], 0), bounds + np.arange(len(bounds))


def window_hashes(codes: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows; equal windows have equal hashes."""
    n = len(codes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        mixed = codes.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(31)
        out, have, power = mixed, 1, np.uint64(BASE)
        # Doubling: a window of 2k is one of k and the next one.
        pieces: list[tuple[np.ndarray, int, np.uint64]] = []
        left = length
        while True:
            if left & 1:
                pieces.append((out, have, power))
            left >>= 1
            if not left:
                break
            out = out[:-have] * power + out[have:] if len(out) > have else out[:0]
            power, have = power * power, have * 2
        total, at = np.zeros(n, np.uint64), 0
        for hashed, size, power in reversed(pieces):
            total = total * power + hashed[at : at + n]
            at += size
    return total


def tiles(document: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiling: ``(start in document, start in item, length)``, longest matches first.

    Code 0 never matches. Ties are broken by place in the document, then in the item.
    """
    free_doc, free_item = document != 0, item != 0
    found: list[tuple[int, int, int]] = []
    search = max(least, min(len(document), len(item)))
    while True:
        matches = _matches(document, item, free_doc, free_item, search)
        longest = max((k for k, _, _ in matches), default=0)
        for k, d, i in sorted(matches, key=lambda m: (-m[0], m[1], m[2])):
            if free_doc[d : d + k].all() and free_item[i : i + k].all():
                free_doc[d : d + k] = free_item[i : i + k] = False
                found.append((d, i, k))
        if longest and longest > search:
            continue  # parts of matches that lost to a longer one may be as long still
        if search == least:
            if not matches:
                return found
            continue
        search = max(least, search // 2)


def _matches(
    document: np.ndarray, item: np.ndarray, free_doc: np.ndarray, free_item: np.ndarray, length: int
) -> list[tuple[int, int, int]]:
    """Maximal unmarked matches of ``length`` words or more, each once."""
    d, i = np.where(free_doc, document, 0), np.where(free_item, item, 0)
    own, other = window_hashes(d, length), window_hashes(i, length)
    if not len(own) or not len(other):
        return []
    places: dict[int, list[int]] = defaultdict(list)
    item_free = np.convolve(~free_item, np.ones(length, int), "valid") == 0
    for at in np.flatnonzero(item_free).tolist():
        places[int(other[at])].append(at)
    doc_free = np.convolve(~free_doc, np.ones(length, int), "valid") == 0
    out, reached = [], {}
    for at in np.flatnonzero(doc_free & np.isin(own, other[item_free])).tolist():
        for to in places.get(int(own[at]), ()):
            if reached.get(to - at, -1) > at or (d[at : at + length] != i[to : to + length]).any():
                continue
            k = length
            while at + k < len(d) and to + k < len(i) and d[at + k] and d[at + k] == i[to + k]:
                k += 1
            reached[to - at] = at + k - length + 1
            out.append((k, at, to))
    return out


class _Index:
    """One block of items: their words as codes, and which items hold a seed."""

    def __init__(self, items: list[tuple[int | None, str | None]], seed: int) -> None:
        numbers: dict[str, int] = {}
        codes, starts = word_codes(
            pa.array([text for _, text in items], pa.string()), lambda w: numbers.setdefault(w, len(numbers) + 1)
        )
        self.code = _Vocabulary(numbers).__getitem__
        self.ids = [item_id for item_id, _ in items]
        self.items = [codes[a : b - 1] for a, b in zip(starts[:-1], starts[1:], strict=True)]
        hashes = [np.unique(window_hashes(item, seed)) for item in self.items]
        joined = np.concatenate([np.empty(0, np.uint64), *hashes])
        order = np.argsort(joined, kind="stable")
        self.seeds = joined[order]
        self.holders = np.repeat(np.arange(len(items)), [len(h) for h in hashes])[order]
        self.seed = seed

    def contaminated(self, texts: pa.Array, share: float) -> dict[int, list[tuple[int | None, int, int, int]]]:
        """For each text (by place) that has some: ``(item_id, item words, covered words, tiles)``."""
        if not len(texts) or not len(self.seeds):
            return {}
        codes, starts = word_codes(texts, self.code)
        if len(codes) < self.seed:
            return {}
        known = np.concatenate(([0], np.cumsum(codes != 0)))
        full = np.flatnonzero(known[self.seed :] - known[: -self.seed] == self.seed)
        hashes = window_hashes(codes, self.seed)[full]
        first = np.searchsorted(self.seeds, hashes, side="left")
        last = np.searchsorted(self.seeds, hashes, side="right")
        hit = last > first
        full, first, last = full[hit], first[hit], last[hit]
        doc = np.searchsorted(starts, full, side="right") - 1
        out = {}
        for at in np.unique(doc).tolist():
            own = doc == at if len(doc) < 64 else slice(*np.searchsorted(doc, [at, at + 1]))
            hits = self._tiled(codes[starts[at] : starts[at + 1]], full[own] - starts[at], first[own], last[own], share)
            if hits:
                out[at] = hits
        return out

    def _tiled(
        self, code: np.ndarray, places: np.ndarray, first: np.ndarray, last: np.ndarray, share: float
    ) -> list[tuple[int | None, int, int, int]]:
        near = np.zeros(len(code) + 1, np.int64)
        near[places] += 1
        near[places + self.seed] -= 1
        shared = np.where(np.cumsum(near)[:-1] > 0, code, 0)
        # Stretches without a seed shrink to one word that matches nothing.
        shared = shared[(shared != 0) | (np.append(shared[1:], 0) != 0)]
        ranges = set(zip(first.tolist(), last.tolist(), strict=True))
        out = []
        for holder in sorted({int(h) for a, b in ranges for h in self.holders[a:b]}):
            item = self.items[holder]
            made = tiles(shared, item, self.seed)
            covered = sum(k for _, _, k in made)
            if made and covered >= share * len(item):
                out.append((self.ids[holder], len(item), covered, len(made)))
        return out


@lru_cache(maxsize=1)
def _index(items: tuple[tuple[int | None, str | None], ...], seed: int) -> _Index:
    return _Index(list(items), seed)


def _item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[tuple[tuple[int | None, str | None], ...]]:
    block, held = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        block.append((row[0], row[1]))
        held += len(row[1] or "")
        if held >= block_bytes:
            yield tuple(block)
            block, held = [], 0
    if block:
        yield tuple(block)


def contaminated_pairs(
    documents: DataFrame, benchmark: DataFrame, seed: int = 5, share: float = 0.5, block_bytes: int = 8_000_000
) -> DataFrame:
    """Documents with the items they cover by ``share`` or more, a row per pair.

    Items and documents of fewer than ``seed`` words, null or empty texts match
    nothing. Repeated rows are compared one by one; null ids stay null.
    """
    found = None
    for items in _item_blocks(benchmark, block_bytes):
        sent = documents.sparkSession.sparkContext.broadcast(items)

        def compare(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = _index(sent.value, seed)
            for batch in in_slices(batches):
                rows = [
                    (batch.column(0)[at].as_py(), *hit, hit[2] / hit[1])
                    for at, hits in index.contaminated(batch.column(1), share).items()
                    for hit in hits
                ]
                kinds = [pa.int64()] * 5 + [pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                    names=["doc_id", "item_id", "n_item_words", "covered_words", "n_tiles", "coverage"],
                )

        part = per_batch(documents.select(F.col("doc_id").cast("long"), "text"), compare, PAIRS)
        found = part if found is None else found.unionByName(part)
    return documents.sparkSession.createDataFrame([], PAIRS) if found is None else found


def without_contaminated(
    documents: DataFrame, benchmark: DataFrame, seed: int = 5, share: float = 0.5, block_bytes: int = 8_000_000
) -> DataFrame:
    """``documents`` without the rows that cover an item by ``share`` or more; all columns stay."""
    at = documents.columns.index("text")
    schema = documents.schema
    for items in _item_blocks(benchmark, block_bytes):
        sent = documents.sparkSession.sparkContext.broadcast(items)

        def drop(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = _index(sent.value, seed)
            for batch in in_slices(batches):
                found = index.contaminated(batch.column(at), share)
                yield batch.filter(pa.array([i not in found for i in range(batch.num_rows)], pa.bool_()))

        documents = per_batch(documents, drop, schema)
    return documents
