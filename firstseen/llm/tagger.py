"""A character tagger: bidirectional LSTM under a linear-chain CRF, in numpy.

Tags are O and, per kind, B and I. A CRF score is the sum of what the LSTM says
of each character and of learnt transitions; transitions that no tagging can hold
are barred. Batches run time step by time step over all windows at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

HIDDEN = 16
BARRED = -1e4
# Characters: each of printable ASCII, then line ends, other white space, other
# letters, all else; 0 pads.
VOCABULARY = 100


def character_ids(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    ids = np.where((codes >= 32) & (codes < 127), codes - 31, 0).astype(np.int64)
    for k in np.flatnonzero(ids == 0).tolist():
        letter = chr(codes[k])
        ids[k] = 96 if letter in "\n\r" else 97 if letter.isspace() else 98 if letter.isalpha() else 99
    return ids


@dataclass(frozen=True)
class Tagger:
    """Weights; their size is fixed."""

    inputs: tuple[np.ndarray, np.ndarray]
    recurrent: tuple[np.ndarray, np.ndarray]
    output: np.ndarray
    bias: np.ndarray
    transitions: np.ndarray

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Best tags of windows: (windows, length) of character ids."""
        states = [_run(x, u, ids.T[::step])[0][::step] for x, u, step in zip(self.inputs, self.recurrent, (1, -1), strict=True)]
        unary = np.concatenate(states, axis=2) @ self.output + self.bias
        return _viterbi(unary, self.transitions)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(inputs: np.ndarray, recurrent: np.ndarray, ids: np.ndarray, keep: bool = False):
    """Hidden states (length, windows, hidden), and what going back needs."""
    length, windows = ids.shape
    size = recurrent.shape[0]
    hidden, cell = np.zeros((windows, size), inputs.dtype), np.zeros((windows, size), inputs.dtype)
    states, kept = np.empty((length, windows, size), inputs.dtype), []
    for t in range(length):
        sums = inputs[ids[t]] + hidden @ recurrent
        gates = _sigmoid(sums[:, : 3 * size])
        fresh = np.tanh(sums[:, 3 * size :])
        before, previous = cell, hidden
        cell = gates[:, size : 2 * size] * cell + gates[:, :size] * fresh
        shown = np.tanh(cell)
        hidden = gates[:, 2 * size :] * shown
        states[t] = hidden
        if keep:
            kept.append((gates, fresh, before, previous, shown))
    return states, kept


def _back(recurrent: np.ndarray, ids: np.ndarray, kept: list, grads: np.ndarray):
    """Gradients of inputs and recurrent weights from those of the states."""
    length, windows = ids.shape
    size = recurrent.shape[0]
    d_inputs, d_recurrent = np.zeros((VOCABULARY, 4 * size)), np.zeros_like(recurrent)
    d_hidden, d_cell = np.zeros((windows, size)), np.zeros((windows, size))
    sums = np.empty((length, windows, 4 * size))
    for t in range(length - 1, -1, -1):
        gates, fresh, before, previous, shown = kept[t]
        into, forget, out = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :]
        d_hidden = d_hidden + grads[t]
        d_cell = d_cell + d_hidden * out * (1 - shown**2)
        d_gates = np.hstack([d_cell * fresh, d_cell * before, d_hidden * shown]) * gates * (1 - gates)
        sums[t] = np.hstack([d_gates, d_cell * into * (1 - fresh**2)])
        d_recurrent += previous.T @ sums[t]
        d_hidden, d_cell = sums[t] @ recurrent.T, d_cell * forget
    one_hot = np.zeros((length * windows, VOCABULARY))
    one_hot[np.arange(length * windows), ids.reshape(-1)] = 1
    d_inputs = one_hot.T @ sums.reshape(length * windows, -1)
    return d_inputs, d_recurrent


def _total(x: np.ndarray, axis: int) -> np.ndarray:
    """log of the sum of exponentials."""
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _chain_gradients(unary: np.ndarray, transitions: np.ndarray, tags: np.ndarray):
    """Mean loss per window, gradients of unary scores and of transitions."""
    length, windows, kinds = unary.shape
    ahead, behind = np.empty_like(unary), np.zeros_like(unary)
    ahead[0] = unary[0]
    for t in range(1, length):
        ahead[t] = unary[t] + _total(ahead[t - 1][:, :, None] + transitions, 1)
    for t in range(length - 2, -1, -1):
        behind[t] = _total((unary[t + 1] + behind[t + 1])[:, None, :] + transitions, 2)
    whole = _total(ahead[-1], 1)
    d_unary = np.exp(ahead + behind - whole[:, None])
    pairs = ahead[:-1, :, :, None] + transitions + (unary[1:] + behind[1:])[:, :, None, :] - whole[:, None, None]
    d_transitions = np.exp(pairs).sum(axis=(0, 1))
    t, w = np.meshgrid(np.arange(length), np.arange(windows), indexing="ij")
    gold = unary[t, w, tags].sum() + transitions[tags[:-1], tags[1:]].sum()
    d_unary[t, w, tags] -= 1
    np.subtract.at(d_transitions, (tags[:-1], tags[1:]), 1)
    return (whole.sum() - gold) / windows, d_unary / windows, d_transitions / windows


def _viterbi(unary: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    length, windows, kinds = unary.shape
    best, came = unary[0], np.empty((length, windows, kinds), np.int8)
    for t in range(1, length):
        scores = best[:, :, None] + transitions
        came[t] = scores.argmax(axis=1)
        best = unary[t] + scores.max(axis=1)
    tags = np.empty((length, windows), np.int64)
    tags[-1] = best.argmax(axis=1)
    rows = np.arange(windows)
    for t in range(length - 1, 0, -1):
        tags[t - 1] = came[t, rows, tags[t]]
    return tags.T


def barred(kinds: int) -> np.ndarray:
    """Where I of a kind would not follow B or I of it."""
    tags = 2 * kinds + 1
    out = np.zeros((tags, tags), bool)
    for kind in range(kinds):
        inside = 2 * kind + 2
        out[:, inside] = True
        out[[inside - 1, inside], inside] = False
    return out


def train(ids: np.ndarray, tags: np.ndarray, kinds: int, updates: int, batch: int, seed: int = 11) -> Tagger:
    """Fit by Adam on windows (n, length). Without any window all tags are O."""
    random = np.random.default_rng(seed)
    n_tags, blocked = 2 * kinds + 1, barred(kinds)
    inputs = [random.normal(0, 0.3, (VOCABULARY, 4 * HIDDEN)) for _ in range(2)]
    for x in inputs:
        x[:, HIDDEN : 2 * HIDDEN] += 1
    weights = [
        *inputs,
        *(random.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN)) for _ in range(2)),
        random.normal(0, 0.3, (2 * HIDDEN, n_tags)),
        np.eye(n_tags)[0] * 2.0,
        np.zeros((n_tags, n_tags)),
    ]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, updates + 1 if len(ids) else 1):
        chosen = random.integers(0, len(ids), batch)
        forward, gold = ids[chosen].T, tags[chosen].T
        backward = forward[::-1]
        left, kept_left = _run(weights[0], weights[2], forward, keep=True)
        right, kept_right = _run(weights[1], weights[3], backward, keep=True)
        both = np.concatenate([left, right[::-1]], axis=2)
        scores = np.where(blocked, BARRED, weights[6])
        _, d_unary, d_transitions = _chain_gradients(both @ weights[4] + weights[5], scores, gold)
        flat = d_unary.reshape(-1, n_tags)
        d_both = d_unary @ weights[4].T
        d_left = _back(weights[2], forward, kept_left, d_both[:, :, :HIDDEN])
        d_right = _back(weights[3], backward, kept_right, d_both[::-1, :, HIDDEN:])
        grads = [
            d_left[0], d_right[0], d_left[1], d_right[1],
            both.reshape(-1, 2 * HIDDEN).T @ flat, flat.sum(axis=0), np.where(blocked, 0, d_transitions),
        ]
        rate = 0.02 * min(1.0, 2 * (1 - (step - 1) / updates))
        norm = max(1.0, np.sqrt(sum((g**2).sum() for g in grads)) / 5)
        for k, grad in enumerate(grads):
            first[k] = 0.9 * first[k] + 0.1 * grad / norm
            second[k] = 0.99 * second[k] + 0.01 * (grad / norm) ** 2
            step_size = rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
            weights[k] = weights[k] - step_size
    single = [w.astype(np.float32) for w in weights]
    final = np.where(blocked, np.float32(BARRED), single[6])
    return Tagger((single[0], single[1]), (single[2], single[3]), single[4], single[5], final)
