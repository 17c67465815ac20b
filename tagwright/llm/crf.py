"""Linear-chain conditional random fields with two states, over many chains at once.

A chain is the run of rows ``ptr[i]`` to ``ptr[i + 1]``. All chains take their
step ``t`` together, so that a step costs a few array operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def _steps(ptr: np.ndarray) -> Iterator[np.ndarray]:
    """For t = 0, 1, ...: the rows that are the t-th of their chain."""
    size = np.diff(ptr)
    first = ptr[:-1][np.argsort(-size, kind="stable")]
    alive = len(size) - np.searchsorted(np.sort(size), np.arange(int(size.max(initial=0))), side="right")
    for t, n in enumerate(alive.tolist()):
        yield first[:n] + t


def viterbi(scores: np.ndarray, ptr: np.ndarray, change: float) -> np.ndarray:
    """The best state of each row. ``scores``: one column per state;
    ``change``: the score of two neighbours in different states. Ties: state 1."""
    best, came = scores.astype(float).copy(), np.zeros(scores.shape, np.int8)
    rows = list(_steps(ptr))
    for now in rows[1:]:
        stay, move = best[now - 1], best[now - 1][:, ::-1] + change
        moved = move > stay
        came[now] = moved
        best[now] += np.where(moved, move, stay)
    state = np.zeros(len(scores), np.int8)
    last = ptr[1:][np.diff(ptr) > 0] - 1
    state[last] = best[last, 1] >= best[last, 0]
    for now in reversed(rows[1:]):
        state[now - 1] = state[now] ^ came[now, state[now]]
    return state


def marginals(scores: np.ndarray, ptr: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward: each row's probabilities of both states, the expected
    number of each pair of neighbouring states, and the sum of log Z."""
    scores = scores.astype(float)
    ahead, behind = scores.copy(), np.zeros(scores.shape)
    rows = list(_steps(ptr))
    for now in rows[1:]:
        came = ahead[now - 1]
        for s in (0, 1):
            ahead[now, s] += np.logaddexp(came[:, 0] + pair[0, s], came[:, 1] + pair[1, s])
    for now in reversed(rows[1:]):
        on = behind[now] + scores[now]
        for s in (0, 1):
            behind[now - 1, s] = np.logaddexp(on[:, 0] + pair[s, 0], on[:, 1] + pair[s, 1])
    both = ahead + behind
    log_z = np.logaddexp(both[:, 0], both[:, 1])
    after = np.concatenate(rows[1:]) if len(rows) > 1 else np.zeros(0, np.int64)
    seen = np.array([[
        np.exp(ahead[after - 1, a] + pair[a, b] + scores[after, b] + behind[after, b] - log_z[after]).sum()
        for b in (0, 1)] for a in (0, 1)])
    first = ptr[:-1][np.diff(ptr) > 0]
    return np.exp(both - log_z[:, None]), seen, float(log_z[first].sum())


def fit(
    features: np.ndarray, ptr: np.ndarray, labels: np.ndarray, weight: np.ndarray,
    rounds: int = 200, rate: float = 0.1, penalty: float = 1e-3,
) -> tuple[np.ndarray, np.ndarray]:
    """Maximum penalised likelihood by Adam: weights of state 1 against 0, and pair scores.

    ``labels``: the state of each row; ``weight``: of each chain.
    """
    w, pair = np.zeros(features.shape[1]), np.zeros((2, 2))
    row_weight = np.repeat(weight, np.diff(ptr))
    inside = np.ones(len(labels), bool)
    inside[ptr[:-1][np.diff(ptr) > 0]] = False
    at = np.flatnonzero(inside)
    # chains of equal weight share their pair counts
    groups = [(v, np.flatnonzero(weight == v)) for v in np.unique(weight)]
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[at - 1], labels[at]), row_weight[at])
    moments = [np.zeros(len(w) + 4), np.zeros(len(w) + 4)]
    total = max(1.0, row_weight.sum())
    parts = []
    for v, chains in groups:
        rows = np.concatenate([np.arange(ptr[c], ptr[c + 1]) for c in chains]) if len(chains) else np.zeros(0, int)
        parts.append((v, rows, np.concatenate([[0], np.cumsum(np.diff(ptr)[chains])])))
    for step in range(1, rounds + 1):
        logit = features @ w
        slope, pairs = np.zeros(len(w)), seen.copy()
        for v, rows, own in parts:
            scores = np.stack([np.zeros(len(rows)), logit[rows]], axis=1)
            p, expected, _ = marginals(scores, own, pair)
            slope += v * (features[rows].T @ (labels[rows] - p[:, 1]))
            pairs -= v * expected
        grad = np.concatenate([slope / total - penalty * w, pairs.ravel() / total - penalty * pair.ravel()])
        moments[0] = 0.9 * moments[0] + 0.1 * grad
        moments[1] = 0.999 * moments[1] + 0.001 * grad * grad
        move = rate * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-8)
        w, pair = w + move[:-4], pair + move[-4:].reshape(2, 2)
    return w, pair
