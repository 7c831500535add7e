"""Suffix arrays by induced sorting, and their permuted longest common prefixes.

Suffixes are S-type if smaller than the next one, else L-type. Substrings from
one leftmost S-type place to the next are sorted by induction, named, and the
string of names is sorted in the same way unless all names differ; the order of
those places then induces that of all suffixes in linear time. With a small
alphabet a bucket is handled as a few arrays; the strings of names, whose
buckets are tiny, are induced place by place.
"""

from __future__ import annotations

import numpy as np

SMALL_ALPHABET = 1024


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next; the last one is not."""
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int64) - text[:-1])
    step[-1] = -1
    at = np.where(step != 0, np.arange(n), n - 1)
    return step[np.minimum.accumulate(at[::-1])[::-1]] > 0


def _grouped(places: np.ndarray, chars: np.ndarray, queues: list[list[np.ndarray]]) -> None:
    """Hands places to the queues of their characters, in order."""
    order = np.argsort(chars, kind="stable")
    places, chars = places[order], chars[order]
    cuts = np.flatnonzero(chars[1:] != chars[:-1]) + 1
    start = 0
    for stop in [*cuts.tolist(), len(chars)]:
        if stop > start:
            queues[int(chars[start])].append(places[start:stop])
        start = stop


#: A wave that has gone on for so many steps and holds few places is followed place by place.
MANY_STEPS, FEW_PLACES = 64, 32


def _follow(
    wave: np.ndarray, c: int, text: np.ndarray, follows: np.ndarray
) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Places of bucket ``c`` that a first wave induces, wave by wave, and those it induces in other buckets.

    The place before each one is induced if it ``follows``. A long run of one
    character is a long chain of small waves.
    """
    done, made = [wave], []
    steps = 0
    while len(wave):
        steps += 1
        if steps > MANY_STEPS and len(wave) <= FEW_PLACES:
            places, elsewhere, places_made = wave.tolist(), [], []
            while places:
                before = [place - 1 for place in places if place and follows[place - 1]]
                elsewhere += [place for place in before if text[place] != c]
                places = [place for place in before if text[place] == c]
                places_made += places
            done.append(np.array(places_made, np.int64))
            made.append(np.array(elsewhere, np.int64))
            break
        before = wave[wave > 0] - 1
        before = before[follows[before]]
        same = text[before] == c
        made.append(before[~same])
        wave = before[same]
        done.append(wave)
    return done, made


def _induce_by_bucket(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, alphabet: int) -> np.ndarray:
    """All suffixes in order, from the leftmost S-type places in order."""
    none = np.empty(0, np.int64)
    lms: list[list[np.ndarray]] = [[] for _ in range(alphabet)]
    _grouped(seeds, text[seeds], lms)
    queues: list[list[np.ndarray]] = [[] for _ in range(alphabet)]
    queues[int(text[-1])].append(np.array([len(text) - 1]))
    larger: list[np.ndarray] = []
    not_smaller = ~smaller
    for c in range(alphabet):
        done, made = _follow(np.concatenate(queues[c]) if queues[c] else none, c, text, not_smaller)
        larger.append(np.concatenate(done))
        made.extend(part - 1 for part in lms[c])
        if made:
            out = np.concatenate(made)
            _grouped(out, text[out], queues)
    queues = [[] for _ in range(alphabet)]
    pieces: list[np.ndarray] = []
    for c in range(alphabet - 1, -1, -1):
        done, made = _follow(np.concatenate(queues[c]) if queues[c] else none, c, text, smaller)
        pieces.extend(done)
        back = larger[c][::-1]
        pieces.append(back)
        before = back[back > 0] - 1
        made.append(before[smaller[before]])
        out = np.concatenate(made)
        if len(out):
            _grouped(out, text[out], queues)
    return np.concatenate(pieces)[::-1]


def _induce_by_place(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, alphabet: int) -> np.ndarray:
    """The same for a large alphabet, one place after the other."""
    n = len(text)
    counts = np.bincount(text, minlength=alphabet)
    ends = np.cumsum(counts)
    # The character before each place, for L-type and for S-type places; -1 where there is none. Place n is no place.
    before = np.concatenate(([-1], text[:-1], [-1]))
    small_before = np.concatenate(([False], smaller[:-1], [False]))
    order = [n] * n
    tail = ends.tolist()
    for place, c in zip(reversed(seeds.tolist()), text[seeds[::-1]].tolist(), strict=True):
        tail[c] -= 1
        order[tail[c]] = place
    head = (ends - counts).tolist()
    c = int(text[-1])
    order[head[c]] = n - 1
    head[c] += 1
    larger_before = np.where(small_before, -1, before).tolist()
    for place in order:
        c = larger_before[place]
        if c >= 0:
            at = head[c]
            order[at] = place - 1
            head[c] = at + 1
    tail = ends.tolist()
    smaller_before = np.where(small_before, before, -1).tolist()
    for place in reversed(order):
        c = smaller_before[place]
        if c >= 0:
            tail[c] = at = tail[c] - 1
            order[at] = place - 1
    return np.array(order, np.int64)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The suffixes of a string of small non-negative numbers in order; a prefix comes before its extension."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    alphabet = int(text.max()) + 1
    induce = _induce_by_bucket if alphabet <= SMALL_ALPHABET else _induce_by_place
    smaller = suffix_types(text)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if not len(leftmost):
        return induce(text, smaller, leftmost, alphabet)
    is_leftmost = np.zeros(n, bool)
    is_leftmost[leftmost] = True
    first = induce(text, smaller, leftmost, alphabet)
    sorted_places = first[is_leftmost[first]]
    names = _named(text, leftmost, sorted_places)
    if names[-1] + 1 < len(leftmost):
        rank = np.empty(n, np.int64)
        rank[sorted_places] = names
        sorted_places = leftmost[suffix_array(rank[leftmost])]
    return induce(text, smaller, sorted_places, alphabet)


def _named(text: np.ndarray, leftmost: np.ndarray, sorted_places: np.ndarray) -> np.ndarray:
    """Names of the substrings in sorted order; equal substrings share one."""
    n = len(text)
    length = np.zeros(n, np.int64)
    length[leftmost[:-1]] = np.diff(leftmost) + 1
    length[leftmost[-1]] = n + 1  # the last one reaches the end and equals none
    a, b = sorted_places[:-1], sorted_places[1:]
    equal = length[a] == length[b]
    open_pairs = np.flatnonzero(equal)
    step = 0
    while len(open_pairs):
        if step > MANY_STEPS and len(open_pairs) <= FEW_PLACES:
            for pair in open_pairs.tolist():
                size = int(length[a[pair]])
                equal[pair] = np.array_equal(text[a[pair] : a[pair] + size], text[b[pair] : b[pair] + size])
            break
        differ = text[a[open_pairs] + step] != text[b[open_pairs] + step]
        equal[open_pairs[differ]] = False
        step += 1
        open_pairs = open_pairs[~differ]
        open_pairs = open_pairs[length[a[open_pairs]] > step]
    return np.concatenate(([0], np.cumsum(~equal)))


def _agreeing(text: np.ndarray, i: int, j: int) -> int:
    """Characters that agree from two places on, none of them 0; compared in pieces of growing size."""
    total, size = 0, 256
    while max(i, j) + total < len(text):
        one, other = text[i + total : i + total + size], text[j + total : j + total + size]
        n = min(len(one), len(other))
        ends = np.flatnonzero((one[:n] != other[:n]) | (one[:n] == 0))
        if len(ends):
            return total + int(ends[0])
        total += n
        size *= 2
    return total


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Per place, how much its suffix shares with the one before it in order; 0 in ``text`` ends every match.

    Only places whose left neighbours differ need comparing; behind them the
    length falls by one from place to place.
    """
    n = len(text)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    left = np.concatenate(([0], text[:-1]))
    left_of_before = np.where(before > 0, text[np.maximum(before - 1, 0)], 0)
    fresh = (left != left_of_before) | (left == 0) | (before < 0)
    places = np.flatnonzero(fresh)
    length = np.zeros(len(places), np.int64)
    active = np.flatnonzero(before[places] >= 0)
    padded = np.append(text, 0)
    step = 0
    while len(active):
        if step > MANY_STEPS and len(active) <= FEW_PLACES:
            for at in active.tolist():
                length[at] = step + _agreeing(text, int(places[at]) + step, int(before[places[at]]) + step)
            break
        i, j = places[active] + step, before[places[active]] + step
        same = (padded[np.minimum(i, n)] == padded[np.minimum(j, n)]) & (padded[np.minimum(i, n)] != 0)
        active = active[same]
        length[active] += 1
        step += 1
    since = np.cumsum(fresh) - 1
    return np.maximum(length[since] - (np.arange(n) - places[since]), 0)


def repeated_windows(text: np.ndarray, size: int) -> np.ndarray:
    """Per place, whether the ``size`` characters from it (none of them 0) also start elsewhere."""
    order = suffix_array(text)
    prefix = common_prefixes(text, order)
    out = prefix >= size
    follows = out[order[1:]]
    out[order[:-1][follows]] = True
    return out
