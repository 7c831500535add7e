"""Best-fit packing: token pieces into as few sequences as possible, by linear grouping.

Only counts per length reach the planner, at most one per possible length, so
the plan does not grow with the documents. Large lengths are put into groups of
equal cardinality and rounded up to the largest of their group; a linear
program over the few sizes, solved by column generation, gives configurations;
documents of the groups take the places in them; what is left, and all small
ones, go where they fit best. Documents find their places by their rank among
those of equal length, which is counted per task first, so that no task sees
all documents of a common length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleswh.llm.common import kept, per_batch
from saleswh.llm.encoding import encoder

Slot = tuple[int, int]  # a length, and the first of its documents (by rank) that goes here
Run = tuple[int, list[Slot]]  # so many sequences alike, each slot taking the next documents of its length

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task long, local_rank long"


def token_pieces(documents: DataFrame, tokenizer: str, capacity: int, end_id: int = 0) -> DataFrame:
    """The pieces of every document: its ids and the end id, the longer ones cut from the end.

    Null text counts as empty and still has its end id. Rows that share a doc_id
    are packed one by one; a null doc_id stays null.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(capacity + 1, np.int64)
        task = TaskContext.get().partitionId()
        for batch in batches:
            at = 0
            for ids, edges in encoder(tokenizer).encode(batch.column(1)):
                n = len(edges) - 1
                doc = batch.column(0).slice(at, n)
                at += n
                total = np.diff(edges) + 1
                pieces = -(-total // capacity)
                first = total - (pieces - 1) * capacity
                row = np.repeat(np.arange(n), pieces)
                number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = np.where(number == 0, 0, first[row] + (number - 1) * capacity)
                length = np.where(number == 0, first[row], capacity)
                crc = np.empty(len(row), np.int64)
                whole = np.insert(ids, edges[1:], end_id).astype("<u4")
                where = edges[:-1][row] + row + start
                for i, (a, b) in enumerate(zip(where.tolist(), (where + length).tolist(), strict=True)):
                    crc[i] = zlib.crc32(whole[a:b])
                order = np.argsort(length, kind="stable")
                ordered = length[order]
                rank = np.empty(len(row), np.int64)
                rank[order] = np.arange(len(row)) - np.searchsorted(ordered, ordered)
                rank += seen[length]
                np.add.at(seen, length, 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        doc.take(pa.array(row)),
                        pa.array(number, pa.int32()),
                        pa.array(start),
                        pa.array(length),
                        pa.array(crc),
                        pa.array(np.full(len(row), task)),
                        pa.array(rank),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "local_rank"],
                )

    return per_batch(documents.select(F.col("doc_id").cast("long"), "text"), cut, PIECES)


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """Configurations of a few sizes and how often to use each: a linear program, rounded down.

    Column generation: prices of the sizes come from the present basis, and a
    knapsack over the capacity finds the configuration worth more than one bin.
    """
    k = len(sizes)
    size, need = np.array(sizes), np.array(demand, float)
    basis = np.diag((capacity // size).astype(float))
    amount = np.linalg.solve(basis, need)
    for _ in range(60 * k):
        price = np.linalg.solve(basis.T, np.ones(k))
        best = np.zeros(capacity + 1)
        choice = np.full(capacity + 1, -1)
        for c in range(int(size.min()), capacity + 1):
            fits = size <= c
            value = np.where(fits, best[np.maximum(c - size, 0)] + price, -1.0)
            at = int(value.argmax())
            best[c], choice[c] = (value[at], at) if value[at] > best[c - 1] else (best[c - 1], -1)
        if best[capacity] <= 1 + 1e-7:
            break
        column, left = np.zeros(k), capacity
        while left > 0:
            if choice[left] < 0:
                left -= 1
            else:
                column[choice[left]] += 1
                left -= size[choice[left]]
        change = np.linalg.solve(basis, column)
        rising = change > 1e-9
        if not rising.any():
            break
        ratio = np.where(rising, amount / np.where(rising, change, 1), np.inf)
        out = int(ratio.argmin())
        amount = np.maximum(amount - ratio[out] * change, 0)
        amount[out] = ratio[out]
        basis[:, out] = column
    return [([int(x) for x in basis[:, j]], int(amount[j] + 1e-6)) for j in range(k) if amount[j] >= 1 - 1e-6]


class _OpenBins:
    """Runs of equal, partly filled sequences by the room left in them."""

    def __init__(self) -> None:
        self.by_room: dict[int, list[Run]] = {}
        self.rooms: list[int] = []

    def add(self, room: int, count: int, slots: list[Slot]) -> None:
        if room not in self.by_room:
            self.by_room[room] = []
            insort(self.rooms, room)
        self.by_room[room].append((count, slots))

    def tightest(self, length: int) -> tuple[int, int, list[Slot]] | None:
        at = bisect_left(self.rooms, length)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        count, slots = self.by_room[room].pop()
        if not self.by_room[room]:
            del self.by_room[room]
            self.rooms.pop(at)
        return room, count, slots


def _rounded(counts: dict[int, int], groups: int) -> dict[int, list[tuple[int, int]]]:
    """Lengths and numbers of documents by the size they are rounded up to, longest first.

    Up to ``groups`` lengths are sizes of their own; more are put into groups of equal cardinality.
    """
    share = max(1, -(-sum(counts.values()) // groups))
    found: dict[int, list[tuple[int, int]]] = {}
    size, room = 0, 0
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            if not room or len(counts) <= groups:
                size, room = length, share
            part = n if len(counts) <= groups else min(n, room)
            found.setdefault(size, []).append((length, part))
            n -= part
            room -= part
    return found


def _plan(
    counts: dict[int, int],
    rounded: dict[int, list[tuple[int, int]]],
    used: list[tuple[list[int], int]],
    capacity: int,
    slack: int,
) -> list[Run]:
    """A plan that keeps the configurations with at most ``slack`` tokens free once documents are in.

    ``used``: numbers of each size (largest first) of ``rounded``, and how often. Documents of
    the others, and those in none, go where they fit best.
    """
    left = dict(counts)
    given = dict.fromkeys(left, 0)
    bins = _OpenBins()

    def take(length: int, n: int) -> Slot:
        slot = (length, given[length])
        given[length] += n
        left[length] -= n
        return slot

    waiting = {size: [[length, n] for length, n in held] for size, held in rounded.items()}
    few = sorted(rounded, reverse=True)
    for use, times in used:
        places = [few[i] for i, n in enumerate(use) for _ in range(n)]
        while times:
            heads: dict[int, int] = {}
            for place in places:
                heads[place] = heads.get(place, 0) + 1
            if not all(waiting[p] for p in heads):
                break
            run = max(1, min(times, *(waiting[p][0][1] // n for p, n in heads.items())))
            lengths = []
            for place in places:
                if not waiting[place]:
                    break
                lengths.append(waiting[place][0][0])
                waiting[place][0][1] -= run
                if not waiting[place][0][1]:
                    waiting[place].pop(0)
            times -= run
            room = capacity - sum(lengths)
            # Documents of a sequence that keeps too much room stay for the last step.
            if len(lengths) == len(places) and room <= slack:
                bins.add(room, run, [take(length, run) for length in lengths])
    for length in sorted(left, reverse=True):
        while left[length]:
            n = left[length]
            found = bins.tightest(length) or (capacity, n, [])
            room, count, slots = found
            each = min(room // length, n)
            filled = min(count, n // each)
            if filled < count and found[2]:
                # The others stay open; their slots start after the documents of these.
                bins.add(room, count - filled, [(x, first + filled) for x, first in slots])
            placed = [take(length, filled) for _ in range(each)]
            bins.add(room - each * length, filled, slots + placed)
    return [run for room in sorted(bins.by_room) for run in bins.by_room[room]]


def plan_packing(counts: dict[int, int], capacity: int, small: int | None = None, groups: int = 24, slack: int = 1) -> list[Run]:
    """Sequences for ``counts[length]`` documents of each length, as runs of equal sequences.

    ``small``: lengths up to it are placed last (an eighth of the capacity
    unless given); ``groups``: how many sizes the large ones are rounded to;
    ``slack``: tokens that a configuration may leave free once documents are in,
    in the first plan. Plans with twice the slack of the one before follow, up to
    one that keeps every configuration, unless one is as short as can be. The
    shortest is taken, of several the first.
    """
    small = capacity // 8 if small is None else small
    counts = {length: n for length, n in counts.items() if n > 0}
    rounded = _rounded({length: n for length, n in counts.items() if length > small}, groups)
    few = sorted(rounded, reverse=True)
    used = configurations(few, [sum(n for _, n in rounded[s]) for s in few], capacity) if few else []
    least = -(-sum(length * n for length, n in counts.items()) // capacity)
    best, fewest = [], None
    while True:
        plan = _plan(counts, rounded, used, capacity, slack)
        made = sum(count for count, _ in plan)
        if fewest is None or made < fewest:
            best, fewest = plan, made
        if fewest == least or slack >= capacity or not used:
            return best
        slack = min(capacity, max(1, 2 * slack))


def place_pieces(pieces: DataFrame, capacity: int, groups: int = 24) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; it must be stored, as it is read three times."""
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    ranked = per_task.select(
        F.col("length").alias("of_length"),
        F.col("task").alias("of_task"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ranks_before"),
    )
    # At most one row per length up to the capacity.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    key, sequence, offset = [], [], []
    made = 0
    stride = max(counts.values(), default=0) + 1
    for count, slots in plan_packing(counts, capacity, groups=groups):
        at = 0
        for length, first in slots:
            key.append(length * stride + first)
            sequence.append(made)
            offset.append(at)
            at += length
        made += count
    order = np.argsort(np.array(key, np.int64), kind="stable")
    keys = np.array(key, np.int64)[order]
    sequences, offsets = np.array(sequence, np.int64)[order], np.array(offset, np.int64)[order]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("length").to_numpy() * stride + batch.column("rank").to_numpy()
            at = np.searchsorted(keys, own, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequences[at] + own - keys[at]), pa.array(offsets[at])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    numbered = pieces.join(
        ranked, (pieces["length"] == ranked["of_length"]) & (pieces["task"] == ranked["of_task"])
    ).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("local_rank") + F.col("ranks_before")).alias("rank")
    )
    return per_batch(
        numbered,
        place,
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )


def pack(documents: DataFrame, tokenizer: str, capacity: int = 2048, groups: int = 24) -> DataFrame:
    """All documents packed: a row per piece with its sequence and place. No rows in, none out."""
    return place_pieces(kept(token_pieces(documents, tokenizer, capacity)), capacity, groups)
