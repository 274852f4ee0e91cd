"""Linear-chain conditional random field in numpy, over many sequences at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Chains:
    """Sequences laid end to end, stepped through together, the longest first.

    Step t touches position t of all sequences that are that long. Work is
    linear in the positions; the number of steps is the longest length.
    """

    lengths: np.ndarray

    def __post_init__(self):
        order = np.argsort(-self.lengths, kind="stable")
        starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]) if len(self.lengths) else np.zeros(0, np.int64)
        self.order, self.starts = order, starts[order]
        steps = int(self.lengths.max(initial=0))
        # Sequences longer than t, for each step t.
        self.alive = len(self.lengths) - np.searchsorted(np.sort(self.lengths), np.arange(steps), side="right")


def forward_backward(
    chains: Chains, scores: np.ndarray, trans: np.ndarray, start: np.ndarray, pairs: bool = False
) -> tuple[np.ndarray, float, np.ndarray]:
    """(marginals by position, log of the partition functions summed, expected transitions).

    ``scores`` holds a row of label scores per position. Messages are scaled at
    every step, so length does not matter. Transitions are only summed if
    ``pairs`` is set.
    """
    peak = scores.max(axis=1, keepdims=True) if len(scores) else scores
    x = np.exp(scores - peak)
    m, first = np.exp(trans), np.exp(start)
    alpha, steps = np.empty_like(x), len(chains.alive)
    log_z, scale = float(peak.sum()), np.empty(len(x), x.dtype)
    a = None
    for t in range(steps):
        at = chains.starts[: chains.alive[t]] + t
        a = x[at] * first if t == 0 else (a[: len(at)] @ m) * x[at]
        total = a.sum(axis=1)
        a /= total[:, None]
        alpha[at], scale[at] = a, total
    log_z += float(np.log(scale).sum())
    out, expected = np.empty_like(x), np.zeros(m.shape)
    b = np.zeros((0, x.shape[1]), x.dtype)
    for t in range(steps - 1, -1, -1):
        at = chains.starts[: chains.alive[t]] + t
        new = np.ones((len(at), x.shape[1]), x.dtype)
        if len(b):
            after = at[: len(b)] + 1
            right = x[after] * b / scale[after][:, None]
            if pairs:
                expected += (alpha[at[: len(b)]].T @ right) * m
            new[: len(b)] = right @ m.T
        b = new
        out[at] = alpha[at] * b
    out /= np.maximum(out.sum(axis=1, keepdims=True), np.finfo(x.dtype).tiny)
    return out, log_z, expected


class Adam:
    """Adam over a list of arrays, ascending."""

    def __init__(self, params: list[np.ndarray], rate: float):
        self.params, self.rate, self.step = params, rate, 0
        self.m = [np.zeros_like(p) for p in params]
        self.v = [np.zeros_like(p) for p in params]

    def ascend(self, gradients: list[np.ndarray]) -> None:
        self.step += 1
        for p, m, v, g in zip(self.params, self.m, self.v, gradients, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p += self.rate * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)
