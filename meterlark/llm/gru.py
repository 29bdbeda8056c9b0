"""A small bidirectional gated recurrent network with attention pooling, in numpy.

Inputs are windows of word numbers. A word's input vector is the sum of its own embedding (when it is known)
and the mean of the embeddings of its known character grams. Sigmoids are written as half tangents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

F32 = np.float32


@dataclass
class WordTable:
    """Words by number: the row of each one's embedding (0: unknown) and, flat, the rows of its grams."""

    word: np.ndarray
    gram: np.ndarray
    owner: np.ndarray

    def inputs(self, p: dict[str, np.ndarray]) -> np.ndarray:
        """One input vector per word, and a last row of zeros for padding."""
        out = np.zeros((len(self.word) + 1, p["word"].shape[1]), dtype=F32)
        out[:-1] = p["word"][self.word]
        if len(self.gram):
            share = self.shares()
            rows = p["gram"][self.gram] * share[:, None]
            first = np.flatnonzero(np.append(True, self.owner[1:] != self.owner[:-1]))
            out[self.owner[first]] += np.add.reduceat(rows, first, axis=0)
        return out

    def shares(self) -> np.ndarray:
        return (1.0 / np.bincount(self.owner, minlength=len(self.word))[self.owner]).astype(F32)


def new_parameters(words: int, grams: int, width: int, hidden: int, seed: int) -> dict[str, np.ndarray]:
    """Row 0 of both embeddings stands for the unknown and stays zero."""
    rng = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(F32)

    p = {
        "word": normal(words, width, scale=0.05), "gram": normal(grams, width, scale=0.05),
        "attend": normal(2 * hidden, hidden, scale=0.3), "query": normal(hidden, scale=0.5),
        "out": normal(2 * hidden, scale=0.3), "bias": np.zeros(1, dtype=F32),
    }
    for side in ("f", "b"):
        p[f"x_{side}"] = normal(width, 3 * hidden, scale=1 / np.sqrt(width))
        p[f"xb_{side}"] = np.zeros(3 * hidden, dtype=F32)
        p[f"h_{side}"] = normal(hidden, 3 * hidden, scale=0.5 / np.sqrt(hidden))
    p["word"][0] = p["gram"][0] = 0
    return p


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _steps(windows: np.ndarray, side: str) -> range:
    n = windows.shape[1]
    return range(n) if side == "f" else range(n - 1, -1, -1)


def _run(p: dict, projected: np.ndarray, windows: np.ndarray, side: str, keep: list | None) -> np.ndarray:
    """Hidden states (steps x windows x hidden) of one direction; padding leaves the state as it is."""
    hidden = p[f"h_{side}"].shape[0]
    pad = len(projected) - 1
    h = np.zeros((len(windows), hidden), dtype=F32)
    out = np.empty((windows.shape[1], len(windows), hidden), dtype=F32)
    for t in _steps(windows, side):
        x, u = projected[windows[:, t]], h @ p[f"h_{side}"]
        gates = _sigmoid(x[:, : 2 * hidden] + u[:, : 2 * hidden])
        r, z = gates[:, :hidden], gates[:, hidden:]
        new = np.tanh(x[:, 2 * hidden :] + r * u[:, 2 * hidden :])
        live = (windows[:, t] != pad)[:, None]
        following = np.where(live, new + z * (h - new), h)
        if keep is not None:
            keep.append((t, h, u, r, z, new, live))
        out[t] = h = following
    return out


def forward(p: dict, table: np.ndarray, windows: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Logits of windows; ``table``: input vectors by word number, the last one for padding."""
    states = []
    for side in ("f", "b"):
        projected = table @ p[f"x_{side}"] + p[f"xb_{side}"]
        tape: list | None = [] if keep is not None else None
        states.append(_run(p, projected, windows, side, tape))
        if keep is not None:
            keep[side] = tape
    h = np.concatenate(states, axis=2)
    hint = np.tanh(h @ p["attend"])
    score = hint @ p["query"]
    live = windows.T != len(table) - 1
    score = np.where(live, score, F32(-30))
    weight = np.exp(score - score.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = (weight[:, :, None] * h).sum(axis=0)
    if keep is not None:
        keep.update(h=h, hint=hint, weight=weight, pooled=pooled)
    return pooled @ p["out"] + p["bias"][0]


def gradients(p: dict, words: WordTable, windows: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the weighted mean cross entropy of windows against 0/1 targets."""
    table, tape = words.inputs(p), {}
    logit = forward(p, table, windows, tape)
    g = {k: np.zeros_like(v) for k, v in p.items()}
    d = ((_sigmoid(logit) - target) * weight / weight.sum()).astype(F32)
    h, hint, a = tape["h"], tape["hint"], tape["weight"]
    g["out"], g["bias"][0] = tape["pooled"].T @ d, d.sum()
    dpooled = d[:, None] * p["out"]
    dh = a[:, :, None] * dpooled
    da = (h * dpooled).sum(axis=2)
    dscore = a * (da - (a * da).sum(axis=0))
    g["query"] = np.tensordot(dscore, hint, axes=([0, 1], [0, 1]))
    dhint = dscore[:, :, None] * p["query"] * (1 - hint * hint)
    g["attend"] = np.tensordot(h, dhint, axes=([0, 1], [0, 1]))
    dh = dh + dhint @ p["attend"].T
    dtable = np.zeros_like(table)
    n = p["h_f"].shape[0]
    for i, side in enumerate(("f", "b")):
        own = dh[:, :, i * n : (i + 1) * n]
        carry = np.zeros((len(windows), n), dtype=F32)
        dx = np.zeros((len(table), 3 * n), dtype=F32)
        for t, before, u, r, z, new, live in reversed(tape[side]):
            total = carry + own[t]
            step = np.where(live, total, F32(0))
            dnew = step * (1 - z) * (1 - new * new)
            dz = step * (before - new) * z * (1 - z)
            dr = dnew * u[:, 2 * n :] * r * (1 - r)
            du = np.concatenate([dr, dz, dnew * r], axis=1)
            np.add.at(dx, windows[:, t], np.concatenate([dr, dz, dnew], axis=1))
            g[f"h_{side}"] += before.T @ du
            carry = total - step + step * z + du @ p[f"h_{side}"].T
        g[f"x_{side}"], g[f"xb_{side}"] = table.T @ dx, dx[:-1].sum(axis=0)
        dtable += dx @ p[f"x_{side}"].T
    np.add.at(g["word"], words.word, dtable[:-1])
    if len(words.gram):
        np.add.at(g["gram"], words.gram, dtable[words.owner] * words.shares()[:, None])
    g["word"][0] = g["gram"][0] = 0
    return g


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float = 0.01):
        self._m = {k: np.zeros_like(v) for k, v in p.items()}
        self._v = {k: np.zeros_like(v) for k, v in p.items()}
        self._rate, self._t = rate, 0

    def step(self, p: dict[str, np.ndarray], g: dict[str, np.ndarray]) -> None:
        self._t += 1
        for k in p:
            self._m[k] += 0.1 * (g[k] - self._m[k])
            self._v[k] += 0.001 * (g[k] * g[k] - self._v[k])
            m, v = self._m[k] / (1 - 0.9**self._t), self._v[k] / (1 - 0.999**self._t)
            p[k] -= (self._rate * m / (np.sqrt(v) + 1e-8)).astype(F32)
