"""Linear-chain conditional random field in numpy.

Sequences are packed: the items of all sequences lie in one array, and
``starts``/``lengths`` give each sequence's place. Recursions go over
positions and handle all sequences that are long enough at once, so a
batch costs as many steps as its longest sequence has items.
"""

from __future__ import annotations

import numpy as np


def with_neighbours(x: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Features of each item next to those of the item before and after it (zeros at the ends)."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    if len(x):
        before[1:], after[:-1] = x[:-1], x[1:]
        full = lengths > 0
        before[starts[full]] = 0
        after[starts[full] + lengths[full] - 1] = 0
    return np.concatenate([x, before, after], axis=1)


class _Steps:
    """Indexes of the items at each position, longest sequences first."""

    def __init__(self, starts: np.ndarray, lengths: np.ndarray):
        order = np.argsort(-lengths, kind="stable")
        self.starts, lengths = starts[order], lengths[order]
        self.last = self.starts + lengths - 1
        self.most = int(lengths[0]) if len(lengths) else 0
        # active[t]: number of sequences with more than t items
        self.active = np.searchsorted(-lengths, -np.arange(self.most), side="left")

    def at(self, t: int) -> np.ndarray:
        return self.starts[:self.active[t]] + t


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis)
    return m + np.log(np.exp(x - np.expand_dims(m, axis)).sum(axis=axis))


def forward_backward(score: np.ndarray, move: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """Log marginals of every item, log of the partition per sequence order, and the forward/backward logs."""
    steps = _Steps(starts, lengths)
    alpha, beta = score.copy(), np.zeros_like(score)
    for t in range(1, steps.most):
        i = steps.at(t)
        alpha[i] += _lse(alpha[i - 1][:, :, None] + move, 1)
    for t in range(steps.most - 2, -1, -1):
        i = steps.at(t + 1) - 1
        beta[i] = _lse(move + (score[i + 1] + beta[i + 1])[:, None, :], 2)
    total = _lse(alpha + beta, 1) if len(score) else np.zeros(0)
    return alpha + beta - total[:, None], total, alpha, beta


def viterbi(score: np.ndarray, move: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Labels of the best path of every sequence."""
    steps = _Steps(starts, lengths)
    best, back = score.copy(), np.zeros(score.shape, dtype=np.int8)
    for t in range(1, steps.most):
        i = steps.at(t)
        into = best[i - 1][:, :, None] + move
        back[i] = into.argmax(1)
        best[i] += into.max(1)
    label = np.zeros(len(score), dtype=np.int64)
    if len(score):
        label[steps.last[steps.last >= 0]] = best[steps.last[steps.last >= 0]].argmax(1)
    for t in range(steps.most - 2, -1, -1):
        i = steps.at(t + 1) - 1
        label[i] = back[i + 1, label[i + 1]]
    return label


def train(x: np.ndarray, y: np.ndarray, starts: np.ndarray, lengths: np.ndarray, labels: int,
          penalty: float = 1.0, steps: int = 80) -> tuple[np.ndarray, np.ndarray]:
    """Weights [features, labels] and moves [labels, labels] of the largest penalised likelihood."""
    n, f = x.shape
    full = lengths > 0
    starts, lengths = starts[full], lengths[full]
    inner = np.ones(n, dtype=bool)
    inner[starts] = False
    at = np.flatnonzero(inner)  # items with one before them
    seen = np.zeros((n, labels))
    seen[np.arange(n), y] = 1
    want = x.T @ seen
    want_move = np.zeros((labels, labels))
    np.add.at(want_move, (y[at - 1], y[at]), 1)

    def loss(theta: np.ndarray):
        w, move = theta[:f * labels].reshape(f, labels), theta[f * labels:].reshape(labels, labels)
        score = x @ w
        log_p, total, alpha, beta = forward_backward(score, move, starts, lengths)
        pair = np.exp(alpha[at - 1][:, :, None] + move + (score[at] + beta[at])[:, None, :]
                      - total[at][:, None, None]).sum(0) if len(at) else np.zeros_like(move)
        value = total[starts].sum() - (score * seen).sum() - (want_move * move).sum() + penalty / 2 * theta @ theta
        grad = np.concatenate([(x.T @ np.exp(log_p) - want).ravel(), (pair - want_move).ravel()]) + penalty * theta
        return value, grad

    theta = _lbfgs(loss, np.zeros(f * labels + labels * labels), steps)
    return theta[:f * labels].reshape(f, labels), theta[f * labels:].reshape(labels, labels)


def _lbfgs(loss, theta: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    value, grad = loss(theta)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        q, used = grad.copy(), []
        for s, g in reversed(moves):
            a = s @ q / (s @ g)
            q -= a * g
            used.append(a)
        q *= moves[-1][0] @ moves[-1][1] / (moves[-1][1] @ moves[-1][1]) if moves else 1 / max(1.0, np.abs(grad).sum())
        for (s, g), a in zip(moves, reversed(used)):
            q += s * (a - g @ q / (s @ g))
        slope, size = -(grad @ q), 1.0
        while size > 1e-8:
            new = theta - size * q
            new_value, new_grad = loss(new)
            if new_value <= value + 1e-4 * size * slope:
                break
            size /= 2
        else:
            break
        s, g = new - theta, new_grad - grad
        if s @ g > 1e-12:
            moves = [*moves[-memory + 1:], (s, g)]
        done = value - new_value < 1e-6 * abs(value)
        theta, value, grad = new, new_value, new_grad
        if done:
            break
    return theta
