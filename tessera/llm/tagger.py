"""A character tagger in numpy: bidirectional LSTM with CRF transitions, its training and its decoding.

Sequences are rows of character numbers, all of one width, filled up with `PAD`. Both directions run
side by side in one array. Labels are 0 for none, and 2 k + 1 and 2 k + 2 for the first and the
further characters of kind k; transitions and starts that can't be are fixed at `NEVER`.
"""

from __future__ import annotations

import numpy as np

#: Numbers of characters: ASCII as it is, 128 all others, 129 the filling.
OTHER, PAD, SYMBOLS = 128, 129, 130
NEVER = -1e4
#: The learnt arrays: per character and direction the gates' input, the recurrence, the emission, transitions and starts.
Weights = dict[str, np.ndarray]


def symbols(text: str) -> np.ndarray:
    """Numbers of a text's characters, one a code point."""
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), OTHER).astype(np.uint8)


def forbidden(labels: int) -> tuple[np.ndarray, np.ndarray]:
    """(transitions, starts) that can't be: a further character without one of its kind before it."""
    further = np.arange(labels)
    inner = (further > 0) & (further % 2 == 0)
    before = np.ones((labels, labels), bool)
    for b in np.flatnonzero(inner):
        before[[b - 1, b], b] = False
    return before & inner[None, :], inner


def begin(kinds: int, width: int, seed: int = 0, dtype=np.float32) -> Weights:
    """Small random weights; the forget gates begin open."""
    r = np.random.default_rng(seed)
    labels = 2 * kinds + 1
    gates = r.normal(0, 0.1, (2, SYMBOLS, 4 * width))
    gates[:, :, width : 2 * width] += 1.0
    recurrence = r.normal(0, 1 / np.sqrt(width), (2, width, 4 * width)) * 0.5
    out = {"gates": gates, "recurrence": recurrence, "emission": r.normal(0, 0.2, (2, width, labels)), "bias": np.zeros(labels), "moves": np.zeros((labels, labels)), "starts": np.zeros(labels)}
    return {k: v.astype(dtype) for k, v in out.items()}


def _halved(w: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Gate inputs with those of the logistic gates halved, as logistic(x) = (1 + tanh(x / 2)) / 2."""
    width = w["recurrence"].shape[1]
    scale = np.concatenate([np.full(3 * width, 0.5), np.ones(width)]).astype(w["gates"].dtype)
    return w["gates"] * scale, w["recurrence"] * scale


def states(w: Weights, x: np.ndarray, keep: bool = False):
    """(states (steps, 2, rows, width), kept): both directions over x (rows, steps), each in its own order of steps."""
    table, recurrence = _halved(w)
    rows, steps = x.shape
    width = recurrence.shape[1]
    both = np.stack([x, x[:, ::-1]])
    h = np.zeros((2, rows, width), table.dtype)
    c = np.zeros_like(h)
    out = np.empty((steps, 2, rows, width), table.dtype)
    kept = []
    for t in range(steps):
        a = np.matmul(h, recurrence)
        a[0] += table[0, both[0, :, t]]
        a[1] += table[1, both[1, :, t]]
        np.tanh(a, out=a)
        a[:, :, : 3 * width] *= 0.5
        a[:, :, : 3 * width] += 0.5
        i, f, o, g = (a[:, :, k * width : (k + 1) * width] for k in range(4))
        before = c
        c = f * c + i * g
        top = np.tanh(c)
        if keep:
            kept.append((a, before, top, h))
        h = o * top
        out[t] = h
    return out, kept


def emissions(w: Weights, h: np.ndarray) -> np.ndarray:
    """Scores of labels (steps, rows, labels) from both directions' states."""
    return np.matmul(h[:, 0], w["emission"][0]) + np.matmul(h[::-1, 1], w["emission"][1]) + w["bias"]


def moves_of(w: Weights) -> tuple[np.ndarray, np.ndarray]:
    bad, bad_start = forbidden(len(w["bias"]))
    return np.where(bad, NEVER, w["moves"]).astype(np.float64), np.where(bad_start, NEVER, w["starts"]).astype(np.float64)


def _log_product(x: np.ndarray, factors: np.ndarray) -> np.ndarray:
    top = x.max(1, keepdims=True)
    return np.log(np.exp(x - top) @ factors + 1e-300) + top


def chances(w: Weights, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(alpha, beta, log Z, chance of each label at each step) of the CRF over emissions e."""
    moves, starts = moves_of(w)
    factors = np.exp(moves)
    e = e.astype(np.float64)
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = e[0] + starts
    for t in range(1, len(e)):
        alpha[t] = e[t] + _log_product(alpha[t - 1], factors)
    for t in range(len(e) - 2, -1, -1):
        beta[t] = _log_product(e[t + 1] + beta[t + 1], factors.T)
    top = alpha[-1].max(1)
    z = top + np.log(np.exp(alpha[-1] - top[:, None]).sum(1))
    return alpha, beta, z, np.exp(alpha + beta - z[:, None])


def decode(w: Weights, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(likeliest labels (rows, steps), the chance of each of them)."""
    e = emissions(w, states(w, x)[0])
    p = chances(w, e)[3]
    moves, starts = moves_of(w)
    best = e[0] + starts
    back = np.empty(e.shape, np.int8)
    for t in range(1, len(e)):
        scored = best[:, :, None] + moves
        back[t] = scored.argmax(1)
        best = scored.max(1) + e[t]
    steps, rows = e.shape[:2]
    labels = np.empty((steps, rows), np.int64)
    labels[-1] = best.argmax(1)
    every = np.arange(rows)
    for t in range(steps - 1, 0, -1):
        labels[t - 1] = back[t][every, labels[t]]
    return labels.T, np.take_along_axis(p, labels[:, :, None], 2)[:, :, 0].T


def loss_and_slopes(w: Weights, x: np.ndarray, y: np.ndarray) -> tuple[float, Weights]:
    """Mean negative log likelihood of the labels y of x (rows, steps), and its gradient."""
    rows, steps = x.shape
    h, kept = states(w, x, keep=True)
    e = emissions(w, h)
    alpha, beta, z, p = chances(w, e)
    moves, starts = moves_of(w)
    every, path = np.arange(rows), y.T
    score = starts[path[0]] + np.take_along_axis(e, path[:, :, None], 2)[:, :, 0].sum(0) + moves[path[:-1], path[1:]].sum(0)
    loss = float((z - score).mean())

    d_moves, factors = np.zeros_like(moves), np.exp(moves)
    for t in range(1, steps):
        right = e[t] + beta[t]
        a, b = alpha[t - 1].max(1), right.max(1)
        d_moves += (np.exp(alpha[t - 1] - a[:, None]) * np.exp(a + b - z)[:, None]).T @ np.exp(right - b[:, None]) * factors
    np.add.at(d_moves, (path[:-1].ravel(), path[1:].ravel()), -1.0)
    d_starts = p[0].sum(0)
    np.add.at(d_starts, path[0], -1.0)
    bad, bad_start = forbidden(len(starts))
    d_moves[bad], d_starts[bad_start] = 0.0, 0.0

    d_e = p
    np.add.at(d_e, (np.repeat(np.arange(steps), rows), np.tile(every, steps), path.ravel()), -1.0)
    d_e = (d_e / rows).astype(h.dtype)
    labels = d_e.shape[2]
    forward, backward = h[:, 0], h[::-1, 1]
    d_emission = np.stack([s.reshape(-1, s.shape[2]).T @ d_e.reshape(-1, labels) for s in (forward, backward)])
    from_above = np.stack([d_e @ w["emission"][0].T, (d_e @ w["emission"][1].T)[::-1]], 1)

    width = w["recurrence"].shape[1]
    d_h, d_c = np.zeros_like(h[0]), np.zeros_like(h[0])
    d_a = np.empty((steps, 2, rows, 4 * width), h.dtype)
    back = w["recurrence"].transpose(0, 2, 1)
    for t in range(steps - 1, -1, -1):
        a, before, top, _ = kept[t]
        i, f, o, g = (a[:, :, k * width : (k + 1) * width] for k in range(4))
        d_h = d_h + from_above[t]
        d_c = d_c + d_h * o * (1 - top * top)
        d = d_a[t]
        d[:, :, :width] = d_c * g * i * (1 - i)
        d[:, :, width : 2 * width] = d_c * before * f * (1 - f)
        d[:, :, 2 * width : 3 * width] = d_h * top * o * (1 - o)
        d[:, :, 3 * width :] = d_c * i * (1 - g * g)
        d_c = d_c * f
        d_h = np.matmul(d, back)
    d_gates, d_recurrence = np.zeros_like(w["gates"]), np.empty_like(w["recurrence"])
    for k in range(2):
        flat = d_a[:, k].reshape(-1, 4 * width)
        previous = np.stack([one[3][k] for one in kept]).reshape(-1, width)
        d_recurrence[k] = previous.T @ flat
        seen = (x if k == 0 else x[:, ::-1]).T.ravel()
        order = np.argsort(seen, kind="stable")
        starts_of = np.flatnonzero(np.concatenate([[True], seen[order][1:] != seen[order][:-1]]))
        d_gates[k, seen[order][starts_of]] = np.add.reduceat(flat[order], starts_of, 0)
    slopes = {"gates": d_gates, "recurrence": d_recurrence, "emission": d_emission, "bias": d_e.sum((0, 1)), "moves": d_moves / rows, "starts": d_starts / rows}
    return loss, {k: v.astype(w[k].dtype) for k, v in slopes.items()}


def train(x: np.ndarray, y: np.ndarray, kinds: int, width: int = 24, rounds: int = 12, part: int = 100, rate: float = 0.02, seed: int = 0) -> Weights:
    """Weights learnt from labelled rows x, y (rows, steps) by Adam; the same rows give the same weights."""
    w = begin(kinds, width, seed)
    mean, square = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    r, step, last = np.random.default_rng(seed + 1), 0, rounds * -(-len(x) // part)
    for _ in range(rounds):
        order = r.permutation(len(x))
        for k in range(0, len(x), part):
            own = order[k : k + part]
            _, slopes = loss_and_slopes(w, x[own], y[own])
            norm = np.sqrt(sum(float((v.astype(np.float64) ** 2).sum()) for v in slopes.values()))
            step += 1
            now = rate * (1 - (step - 1) / last)
            for name, v in slopes.items():
                v = v * min(1.0, 5.0 / max(norm, 1e-9))
                mean[name] = 0.9 * mean[name] + 0.1 * v
                square[name] = 0.99 * square[name] + 0.01 * v * v
                w[name] -= (now * (mean[name] / (1 - 0.9**step)) / (np.sqrt(square[name] / (1 - 0.99**step)) + 1e-8)).astype(w[name].dtype)
    return w
