"""A gated recurrent language model in numpy: class-factored output, truncated backpropagation, Adam.

Inputs are symbols: frequent words and, for all others, the group of their
ending. The output is the class of the next symbol, then the word within its
class; ending groups are classes of their own, so their words need no second
step. States are carried from window to window until a text ends.
"""

from __future__ import annotations

import math

import numpy as np

HIDDEN = 24
CLASS_WORDS = 64
WINDOW = 16
LANES, UPDATES = (8, 256), 256
#: Rows of scores worked on at once, so that they stay in the cache.
BLOCK = 2048
Parameters = dict[str, np.ndarray]


def shapes(symbols: int, classes: int, word_classes: int, hidden: int = HIDDEN) -> dict[str, tuple[int, ...]]:
    return {
        "input": (symbols, 3 * hidden),
        "recurrent": (hidden, 2 * hidden),
        "candidate": (hidden, hidden),
        "class_out": (hidden, classes),
        "class_bias": (classes,),
        "word_out": (word_classes, hidden, CLASS_WORDS),
        "word_bias": (word_classes, CLASS_WORDS),
    }


def first_parameters(class_share: np.ndarray, word_share: np.ndarray, symbols: int, seed: int = 7) -> Parameters:
    """Random weights; biases are the log shares of the corpus, so the start is a class unigram model."""
    random = np.random.default_rng(seed)
    made = {}
    for name, shape in shapes(symbols, len(class_share), len(word_share)).items():
        made[name] = (random.standard_normal(shape) * (0.1 if name == "input" else 0.2)).astype(np.float32)
    made["class_out"] *= 0.1
    made["word_out"] *= 0.1
    made["class_bias"] = np.log(np.maximum(class_share, 1e-12)).astype(np.float32)
    made["word_bias"] = np.where(word_share > 0, np.log(np.maximum(word_share, 1e-12)), -1e4).astype(np.float32)
    return made


def flat(parameters: Parameters) -> np.ndarray:
    return np.concatenate([parameters[name].ravel() for name in sorted(parameters)])


def unflat(values: np.ndarray, like: Parameters) -> Parameters:
    made, at = {}, 0
    for name in sorted(like):
        size = like[name].size
        made[name] = values[at : at + size].reshape(like[name].shape).astype(np.float32)
        at += size
    return made


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def step(p: Parameters, h: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step of the gated unit: the next state, and what its gradient needs."""
    k = h.shape[1]
    x = p["input"][symbol]
    gates = _sigmoid(x[:, : 2 * k] + h @ p["recurrent"])
    update, reset = gates[:, :k], gates[:, k:]
    held = reset * h
    new = np.tanh(x[:, 2 * k :] + held @ p["candidate"])
    return h + update * (new - h), update, reset, held, new


def _is_tame(weights: np.ndarray, bias: np.ndarray) -> bool:
    """Whether no state, between -1 and 1, can bring scores that overflow or that all vanish."""
    return bool(np.abs(weights).sum(axis=0).max() < 60 and -20 < bias.max() < 20)


def _exponentials(x: np.ndarray, target: np.ndarray, tame: bool) -> tuple[np.ndarray, np.ndarray]:
    """``x`` turned into exponentials in place, the scores of the targets, and the sums of the rows."""
    if not tame:
        x -= x.max(axis=1, keepdims=True)
    picked = x[np.arange(len(x)), target]
    np.exp(x, out=x)
    return picked, x @ np.ones(x.shape[1], x.dtype)


def log_likelihood(p: Parameters, states: np.ndarray, classes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Natural log of each symbol's chance given the state before it; ``words`` is -1 for ending groups."""
    out = np.empty(len(states), np.float32)
    tame = _is_tame(p["class_out"], p["class_bias"])
    for at in range(0, len(states), BLOCK):
        part = slice(at, at + BLOCK)
        picked, total = _exponentials(states[part] @ p["class_out"] + p["class_bias"], classes[part], tame)
        out[part] = picked - np.log(total)
    order = np.flatnonzero(words >= 0)
    order = order[np.argsort(classes[order].astype(np.int16), kind="stable")]
    cuts = np.searchsorted(classes[order], np.arange(len(p["word_out"]) + 1))
    for c, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
        tame = _is_tame(p["word_out"][c], p["word_bias"][c])
        for start in range(a, b, BLOCK):
            rows = order[start : min(b, start + BLOCK)]
            picked, total = _exponentials(states[rows] @ p["word_out"][c] + p["word_bias"][c], words[rows], tame)
            out[rows] += picked - np.log(total)
    return out


class Symbols:
    """How symbols are told apart: ``of_class`` and ``in_class`` (-1: the class is all) per symbol."""

    def __init__(self, of_class: np.ndarray, in_class: np.ndarray) -> None:
        self.of_class, self.in_class = of_class, in_class


def score(p: Parameters, known: Symbols, symbols: np.ndarray, edges: np.ndarray, window: int = 32) -> np.ndarray:
    """Natural log likelihood of every text, the state carried over all its windows."""
    length = np.diff(edges)
    order = np.argsort(-length, kind="stable")
    start, length = edges[:-1][order], length[order]
    total = np.zeros(len(order))
    k = p["recurrent"].shape[0]
    h = np.zeros((len(order), k), np.float32)
    at = 0
    while len(length) and length[0] > at:
        lanes = int(np.searchsorted(-length, -at, side="left"))  # texts longer than ``at``
        h = h[:lanes]
        states, targets, owner = [], [], []
        for t in range(at, min(at + window, int(length[0]))):
            n = int(np.searchsorted(-length, -t, side="left"))
            symbol = symbols[start[:n] + t]
            states.append(h[:n])
            targets.append(symbol)
            owner.append(np.arange(n))
            h = step(p, h[:n], symbol)[0] if n == len(h) else np.concatenate([step(p, h[:n], symbol)[0], h[n:]])
        symbol = np.concatenate(targets)
        found = log_likelihood(p, np.concatenate(states), known.of_class[symbol], known.in_class[symbol])
        total[:lanes] += np.bincount(np.concatenate(owner), weights=found, minlength=lanes)
        at += window
    out = np.zeros(len(order))
    out[order] = total
    return out


def gradients(
    p: Parameters, known: Symbols, h: np.ndarray, symbols: np.ndarray, real: np.ndarray, first: np.ndarray
) -> tuple[float, Parameters, np.ndarray, np.ndarray]:
    """Loss and gradients of one window (steps x lanes), the symbols met, and the states behind it.

    ``real``: symbols that count; ``first``: a text starts here, so the state is
    new. The gradient of ``input`` has a row for each symbol met, all others are 0.
    """
    steps, lanes = symbols.shape
    k = h.shape[1]
    g = {name: np.zeros_like(value) for name, value in p.items() if name != "input"}
    before, kept = [], []
    for t in range(steps):
        h = np.where(first[t][:, None], np.float32(0), h)
        before.append(h)
        h, *rest = step(p, h, symbols[t])
        kept.append(rest)
    states = np.concatenate(before)
    flat_symbols, weight = symbols.ravel(), real.ravel().astype(np.float32)
    count = max(float(weight.sum()), 1.0)
    of_class, in_class = known.of_class[flat_symbols], known.in_class[flat_symbols]
    rows = np.arange(len(states))
    d = states @ p["class_out"] + p["class_bias"]
    picked, total = _exponentials(d, of_class, _is_tame(p["class_out"], p["class_bias"]))
    loss = -float(((picked - np.log(total)) * weight).sum())
    share = weight / count
    d *= (share / total)[:, None]
    d[rows, of_class] -= share
    g["class_out"], g["class_bias"] = states.T @ d, d.sum(axis=0)
    d_states = d @ p["class_out"].T
    order = np.flatnonzero((in_class >= 0) & (weight > 0))
    order = order[np.argsort(of_class[order].astype(np.int16), kind="stable")]
    cuts = np.searchsorted(of_class[order], np.arange(len(p["word_out"]) + 1))
    for c in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
        own = order[cuts[c] : cuts[c + 1]]
        own_states, target = states[own], in_class[own]
        d = own_states @ p["word_out"][c] + p["word_bias"][c]
        picked, total = _exponentials(d, target, _is_tame(p["word_out"][c], p["word_bias"][c]))
        loss -= float((picked - np.log(total)).sum())
        d *= (np.float32(1 / count) / total)[:, None]
        d[np.arange(len(own)), target] -= np.float32(1 / count)
        g["word_out"][c], g["word_bias"][c] = own_states.T @ d, d.sum(axis=0)
        d_states[own] += d @ p["word_out"][c].T
    d_states = d_states.reshape(steps, lanes, k)
    d_h = np.zeros((lanes, k), np.float32)
    d_input = np.empty((steps, lanes, 3 * k), d_states.dtype)
    for t in range(steps - 1, -1, -1):
        update, reset, held, new = kept[t]
        old = before[t]
        d_new = d_h * update * (1 - new * new)
        d_update = d_h * (new - old) * update * (1 - update)
        d_held = d_new @ p["candidate"].T
        d_reset = d_held * old * reset * (1 - reset)
        d_gates = np.concatenate([d_update, d_reset], axis=1)
        g["recurrent"] += old.T @ d_gates
        g["candidate"] += held.T @ d_new
        d_input[t] = np.concatenate([d_gates, d_new], axis=1)
        d_h = d_h * (1 - update) + d_gates @ p["recurrent"].T + d_held * reset + d_states[t]
        d_h = np.where(first[t][:, None], np.float32(0), d_h)
    order = np.argsort(flat_symbols, kind="stable")
    found = flat_symbols[order]
    starts = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
    g["input"] = np.add.reduceat(d_input.reshape(-1, 3 * k)[order], starts)
    return loss / count, g, found[starts], h


def train(
    p: Parameters, known: Symbols, symbols: np.ndarray, starts: np.ndarray, lanes: int | None = None, rate: float = 0.01
) -> Parameters:
    """One pass over texts laid out one after the other in ``lanes``; ``starts`` marks first symbols.

    Unless given, lanes are as many as leave about ``UPDATES`` updates, within ``LANES``.
    """
    p = {name: value.copy() for name, value in p.items()}
    if lanes is None:
        lanes = min(max(len(symbols) // (WINDOW * UPDATES), LANES[0]), LANES[1])
    long = -(-len(symbols) // lanes)
    if not long:
        return p
    pad = lanes * long - len(symbols)
    rows = np.append(symbols, np.zeros(pad, symbols.dtype)).reshape(lanes, long).T
    real = np.append(np.ones(len(symbols), bool), np.zeros(pad, bool)).reshape(lanes, long).T
    first = np.append(starts, np.ones(pad, bool)).reshape(lanes, long).T.copy()
    first[0] = True
    mean = {name: np.zeros_like(value) for name, value in p.items()}
    square = {name: np.zeros_like(value) for name, value in p.items()}
    h = np.zeros((lanes, p["recurrent"].shape[0]), np.float32)
    n = 0
    updates = -(-long // WINDOW)
    for at in range(0, long, WINDOW):
        _, g, met, h = gradients(p, known, h, rows[at : at + WINDOW], real[at : at + WINDOW], first[at : at + WINDOW])
        # Plain floats: a numpy scalar of 64 bits would widen every array below.
        size = math.sqrt(sum(float(np.vdot(x, x)) for x in g.values()))
        n += 1
        speed = rate * (1 - 0.9 * n / updates) * math.sqrt(1 - 0.99**n) / (1 - 0.9**n)
        for name, value in g.items():
            # Input rows of symbols that the window does not hold stay as they are, with their means.
            at_rows = met if name == "input" else slice(None)
            value *= min(1.0, 1.0 / (size + 1e-12))
            own_mean, own_square = mean[name][at_rows], square[name][at_rows]
            own_mean *= 0.9
            own_mean += 0.1 * value
            value *= value
            value *= 0.01
            own_square *= 0.99
            own_square += value
            if name == "input":
                mean[name][met], square[name][met] = own_mean, own_square
            np.sqrt(own_square, out=value)
            value += 1e-6
            np.divide(own_mean, value, out=value)
            value *= speed
            p[name][at_rows] -= value
    return p
