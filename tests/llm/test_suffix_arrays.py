from __future__ import annotations

import random
import time

import numpy as np
import pytest

from saleswh.llm import suffix_arrays as sa


@pytest.mark.parametrize("small", [1024, 2])
def test_orders_prefixes_and_repeats_equal_brute_force(monkeypatch, small):
    monkeypatch.setattr(sa, "SMALL_ALPHABET", small)
    pick = random.Random(small)
    for _ in range(400):
        kinds = pick.choice([1, 2, 3, 6])
        text = np.array([pick.randint(0, kinds) for _ in range(pick.randint(1, 50))])
        n = len(text)
        order = sorted(range(n), key=lambda i: text[i:].tolist())
        assert sa.suffix_array(text).tolist() == order
        lengths = sa.common_prefixes(text, np.array(order))
        for a, b in zip(order[1:], order[:-1], strict=True):
            k = 0
            while max(a, b) + k < n and text[a + k] == text[b + k] != 0:
                k += 1
            assert lengths[a] == k
        twice = sa.repeated_windows(text, 3)
        windows = [tuple(text[i : i + 3].tolist()) for i in range(n - 2)]
        for i, w in enumerate(windows):
            if 0 not in w:
                assert twice[i] == (windows.count(w) > 1)


def test_long_runs():
    text = np.concatenate([np.ones(5000, int), [2], np.ones(5000, int)])
    assert sa.suffix_array(text)[-1] == 5000


@pytest.mark.parametrize("many", [0, 2])
def test_few_places_are_followed_one_by_one(monkeypatch, many):
    monkeypatch.setattr(sa, "MANY_STEPS", many)
    pick = random.Random(many)
    for _ in range(200):
        unit = [pick.randint(1, 3) for _ in range(pick.randint(1, 4))]
        text = unit * pick.randint(1, 12) + [pick.randint(0, 3) for _ in range(pick.randint(0, 9))]
        text += unit * pick.randint(0, 9)
        order = sorted(range(len(text)), key=lambda i: text[i:])
        array = np.array(text)
        assert sa.suffix_array(array).tolist() == order
        twice = sa.repeated_windows(array, 3)
        windows = [tuple(text[i : i + 3]) for i in range(len(text) - 2)]
        for i, w in enumerate(windows):
            assert 0 in w or twice[i] == (windows.count(w) > 1)


def test_a_long_periodic_text_takes_seconds():
    for unit in ([98], [98, 99], [3, 1, 2]):
        text = np.append(np.tile(unit, 1_000_000 // len(unit)), 0).astype(np.uint8)
        start = time.process_time()
        assert sa.repeated_windows(text, 200).sum() == len(text) - 200
        assert time.process_time() - start < 10
