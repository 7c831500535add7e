"""Periodic runs of words, from enhanced suffix arrays by the branching-tandem test.

A run is a maximal stretch of words with smallest period q. The last square of
a run (q words twice, the next word differs) starts at two suffixes that share
exactly q words, so they lie in different children of the LCP interval of depth
q. Every boundary of an interval is visited with the suffixes of its smaller
side; each asks the inverse array whether the suffix q words further, or q words
back, is on the other side. A square found is turned to the left as long as
the words agree, which gives its run. There are no tree nodes: an interval is
two bounds and a depth.

Documents are rows and stay with their task; many of them share one array, told
apart by their number, so that numpy works on long arrays whatever their size.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswh.llm.common import per_batch

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
#: A run has the same words at a start and a period later, at least so many (6 words of period 1).
LEAST_SHARED = 5
#: Words in one array, and suffixes tested at once; a longer document has an array of its own.
ARRAY_WORDS, TESTED = 250_000, 1_000_000

Rewrite = Callable[[int, int], tuple[int, int] | None]


def classes_by_width(first: np.ndarray) -> list[np.ndarray]:
    """Per power of two, a number per place, equal where so many words are; the last has no two equal numbers.

    ``first`` numbers the words; its last number must occur once. Numbers are in
    order of the words, so the last array is the inverse suffix array.
    """
    levels = [np.unique(first, return_inverse=True)[1]]
    width = 1
    while True:
        own = levels[-1]
        n = len(own)
        behind = np.zeros(n, np.int64)
        behind[: n - width] = own[width:] + 1
        distinct, following = np.unique(own * np.int64(n + 1) + behind, return_inverse=True)
        levels.append(following)
        if len(distinct) == n:
            return levels
        width *= 2


def _shared_after(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Words that the suffixes ``i`` and ``j`` share."""
    shared = np.zeros(len(i), np.int64)
    for r in range(len(levels) - 2, -1, -1):
        shared += (levels[r][i + shared] == levels[r][j + shared]).astype(np.int64) << r
    return shared


def _shared_before(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Words that agree before the places ``i`` and ``j`` (after ``i``)."""
    shared = np.zeros(len(i), np.int64)
    for r in range(len(levels) - 2, -1, -1):
        at = i - shared - (1 << r)
        same = (at >= 0) & (levels[r][np.maximum(at, 0)] == levels[r][np.maximum(at, 0) + j - i])
        shared += same.astype(np.int64) << r
    return shared


def _sides(depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per boundary of depth, the last shallower boundary before it and the next one not deeper after it."""
    n = len(depth)
    values = depth.tolist()
    left, right = [0] * n, [n] * n
    open_: list[int] = [0]
    for k in range(1, n):
        value = values[k]
        while open_ and values[open_[-1]] >= value:
            right[open_.pop()] = k
        left[k] = open_[-1] if open_ else 0
        open_.append(k)
    return np.array(left), np.array(right)


def branching_squares(order: np.ndarray, rank: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of the squares whose next word breaks the period.

    ``depth[k]``: words shared by the suffixes ``order[k - 1]`` and ``order[k]``.
    """
    n = len(order)
    left, right = _sides(depth)
    at = np.flatnonzero(depth > 0)
    before, after = at - left[at], right[at] - at
    use_before = before <= after
    first = np.where(use_before, left[at], at)  # the smaller side
    size = np.where(use_before, before, after)
    low = np.where(use_before, at, left[at])  # the other side
    high = np.where(use_before, right[at], at)
    starts, periods = [], []
    edges = np.concatenate(([0], np.cumsum(size)))
    cut = 0
    while cut < len(at):
        end = max(int(np.searchsorted(edges, edges[cut] + TESTED, "right")) - 1, cut + 1)
        some = slice(cut, end)
        node = np.repeat(np.arange(cut, end), size[some])
        place = order[np.arange(len(node)) - (edges[node] - edges[cut]) + first[node]]
        period = depth[at[node]]
        for other, start in ((place + period, place), (place - period, place - period)):
            inside = (other >= 0) & (other < n)
            found = rank[np.clip(other, 0, n - 1)]
            hit = inside & (found >= low[node]) & (found < high[node])
            starts.append(start[hit])
            periods.append(period[hit])
        cut = end
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(starts), np.concatenate(periods)


def runs_in(words: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of all runs, by start and period.

    ``words`` are numbers and ``document`` the number of each word's document,
    ascending. Starts are places in ``words``; no run crosses documents.
    """
    if not len(words):
        return (np.empty(0, np.int64),) * 3
    # A word of its own behind each document ends all matches.
    n_words = int(words.max()) + 1
    last = np.flatnonzero(np.append(document[1:] != document[:-1], True))
    ends = int(document.max() + 1) * n_words + np.arange(len(last))
    text = np.insert(document.astype(np.int64) * n_words + words, last + 1, ends)
    levels = classes_by_width(text)
    rank = levels[-1]
    order = np.empty(len(text), np.int64)
    order[rank] = np.arange(len(text))
    depth = np.zeros(len(text), np.int64)
    depth[1:] = _shared_after(levels, order[:-1], order[1:])
    start, period = branching_squares(order, rank, depth)
    stop = start + 2 * period
    start = start - _shared_before(levels, start, start + period)
    length = stop - start
    long = length >= np.maximum(LEAST_LENGTH, LEAST_EXPONENT * period)
    start, length, period = start[long], length[long], period[long]
    # A run with period q is found with 2q, 3q ... too, always with the same bounds.
    by_run = np.lexsort((period, length, start))
    start, length, period = start[by_run], length[by_run], period[by_run]
    new = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1]))[: len(start)]
    start, length, period = start[new], length[new], period[new]
    start = start - np.searchsorted(last + np.arange(1, len(last) + 1), start)
    in_order = np.lexsort((period, start))
    return start[in_order], length[in_order], period[in_order]


def _suspects(words: np.ndarray, document: np.ndarray, n_documents: int) -> np.ndarray:
    """Documents that hold some five words twice; no other has a run."""
    n = len(words) - LEAST_SHARED + 1
    suspect = np.zeros(n_documents, bool)
    if n < 2:
        return suspect
    with np.errstate(over="ignore"):
        key = document[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for i in range(LEAST_SHARED):
            key = (key ^ words[i : i + n].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            key ^= key >> np.uint64(31)
    whole = np.flatnonzero(document[:n] == document[LEAST_SHARED - 1 :])
    by_key = whole[np.argsort(key[whole])]
    twice = key[by_key[1:]] == key[by_key[:-1]]
    suspect[document[by_key[1:][twice]]] = True
    return suspect


def _arrays(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Numbers of documents that share an array."""
    total, held = 0, []
    for number, size in enumerate(sizes.tolist()):
        if held and total + size > ARRAY_WORDS:
            yield np.array(held)
            total, held = 0, []
        held.append(number)
        total += size
    if held:
        yield np.array(held)


def _runs_of_texts(texts: pa.Array, changed: list[tuple[int, int] | None]) -> list[list[tuple[int, int, int]]]:
    """Runs of each text, some of whose words were replaced by those of ``changed``: first place and period."""
    cut = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    edges = cut.offsets.to_numpy().astype(np.int64)
    numbered = cut.flatten().dictionary_encode()
    numbers = numbered.indices.to_numpy().astype(np.int64)
    empty = pc.equal(pc.binary_length(numbered.dictionary), 0).to_numpy(zero_copy_only=False)
    real = ~empty[numbers]
    edges = np.concatenate(([0], np.cumsum(real)))[edges - edges[0]]
    numbers = numbers[real]
    for row, change in enumerate(changed):
        if change:
            a, b = int(edges[row]) + change[0], int(edges[row + 1])
            numbers[a:b] = numbers[a + np.arange(b - a) % change[1]]
    sizes = np.diff(edges)
    found: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    document = np.repeat(np.arange(len(sizes)), sizes)
    wanted = np.flatnonzero(_suspects(numbers, document, len(sizes)))
    for group in _arrays(sizes[wanted]):
        rows = wanted[group]
        own = np.repeat(np.arange(len(rows)), sizes[rows])
        first = np.concatenate(([0], np.cumsum(sizes[rows])))
        places = np.arange(len(own)) - first[own] + edges[rows][own]
        for start, length, period in zip(*(x.tolist() for x in runs_in(numbers[places], own)), strict=True):
            row = int(own[start])
            found[rows[row]].append((start - int(first[row]), length, period))
    return found


def strongest(runs: list[tuple[int, int, int]]) -> int | None:
    """Number of the run with the greatest exact length over period; the first of equal ones."""
    if not runs:
        return None
    return max(range(len(runs)), key=lambda i: (Fraction(runs[i][1], runs[i][2]), -i))


def without_later_periods(words: list, runs: list[tuple[int, int, int]]) -> list:
    """``words`` without those that a run holds after its first period."""
    if not runs:
        return words
    stays = np.ones(len(words), bool)
    for start, length, period in runs:
        stays[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(stays).tolist()]


SCHEMA = "doc_id long, runs array<struct<start: long, length: long, period: long>>, strongest int, collapsed string"


def collapse_runs(documents: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """Per row ``doc_id, runs, strongest, collapsed``.

    ``runs`` are by start, then period; ``strongest`` is the number of the run
    with the greatest exponent (null without runs; ties go to the first);
    ``collapsed`` are the words without those that a run holds after its first
    period, joined by one space. ``rewrite(doc_id, n_words)`` may name a first
    word and a period: words from the first on are then replaced by repetitions
    of its period, before anything else; a row without doc_id is not rewritten.

    Null, empty and blank texts have no runs and collapse to nothing. Repeated
    rows and doc_ids are judged row by row; other columns are not read; no rows
    in, none out. A very long text is one array of some 300 bytes a word.
    """

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
        for batch in batches:
            ids = batch.column(0).to_pylist()
            words = [(t or "").encode("utf-8", "surrogatepass").split() for t in batch.column(1).to_pylist()]
            changed = [
                rewrite(i, len(w)) if rewrite and i is not None and w else None for i, w in zip(ids, words, strict=True)
            ]
            runs = _runs_of_texts(batch.column(1), changed)
            collapsed = []
            for own, change, found in zip(words, changed, runs, strict=True):
                if change:
                    a, p = change
                    own = own[:a] + [own[a + k % p] for k in range(len(own) - a)]
                collapsed.append(b" ".join(without_later_periods(own, found)).decode("utf-8", "surrogatepass"))
            offsets = np.concatenate(([0], np.cumsum([len(r) for r in runs], dtype=np.int64)))
            flat = pa.array([dict(zip(("start", "length", "period"), r, strict=True)) for f in runs for r in f], kinds)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat),
                    pa.array([strongest(r) for r in runs], pa.int32()),
                    pa.array(collapsed, pa.string()),
                ],
                names=["doc_id", "runs", "strongest", "collapsed"],
            )

    return per_batch(documents.select(F.col("doc_id").cast("long"), "text"), collapse, SCHEMA)


def repeated_tail(doc_id: int, n_words: int) -> tuple[int, int] | None:
    """The rewriting of the query: every tenth document, by checksum, ends in repetitions."""
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 or not n_words:
        return None
    a = g % n_words
    return a, 1 + (n_words - a) // (3 + g % 8)


def run_digests(documents: DataFrame) -> DataFrame:
    """Per row ``doc_id, n_runs``, the strongest run and digests of all runs and of the collapsed text."""
    found = collapse_runs(documents, repeated_tail)
    best = F.get("runs", F.col("strongest"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * runs[strongest].length div runs[strongest].period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
