"""A gated recurrent layer in numpy, with its gradient through time, and Adam."""

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def step(x: np.ndarray, h: np.ndarray, u: np.ndarray) -> np.ndarray:
    """The next state; x: (batch, 3 hidden) projected inputs for update, reset, new."""
    n = h.shape[1]
    hu = h @ u
    gates = sigmoid(x[:, : 2 * n] + hu[:, : 2 * n])
    new = 2 * sigmoid(2 * (x[:, 2 * n :] + gates[:, n:] * hu[:, 2 * n :])) - 1
    return new + gates[:, :n] * (h - new)


def forward(x: np.ndarray, u: np.ndarray, h: np.ndarray, keep: np.ndarray | None = None) -> tuple[np.ndarray, tuple]:
    """States (time, batch, hidden) of inputs (time, batch, 3 hidden); and what backward needs.

    ``keep`` (time, batch) is 0 where the state before a step is to be forgotten, else 1.
    """
    n = h.shape[1]
    states, gates, news, resets = [], [], [], []
    first = h
    for t, xt in enumerate(x):
        if keep is not None:
            h = h * keep[t][:, None]
        hu = h @ u
        gate = sigmoid(xt[:, : 2 * n] + hu[:, : 2 * n])
        new = 2 * sigmoid(2 * (xt[:, 2 * n :] + gate[:, n:] * hu[:, 2 * n :])) - 1
        h = new + gate[:, :n] * (h - new)
        states.append(h)
        gates.append(gate)
        news.append(new)
        resets.append(hu[:, 2 * n :])
    return np.stack(states), (first, states, gates, news, resets, keep)


def backward(d_states: np.ndarray, u: np.ndarray, kept: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the projected inputs and of ``u``; no gradient enters before the first step."""
    first, states, gates, news, resets, keep = kept
    n = u.shape[0]
    d_x = np.empty((*d_states.shape[:2], 3 * n), d_states.dtype)
    d_u = np.zeros_like(u)
    d_h = np.zeros_like(first)
    for t in range(len(d_states) - 1, -1, -1):
        h = states[t - 1] if t else first
        if keep is not None:
            h = h * keep[t][:, None]
        z, r = gates[t][:, :n], gates[t][:, n:]
        d = d_states[t] + d_h
        d_new = d * (1 - z) * (1 - news[t] ** 2)
        d_z = d * (h - news[t]) * z * (1 - z)
        d_r = d_new * resets[t] * r * (1 - r)
        d_hu = np.concatenate([d_z, d_r, d_new * r], axis=1)
        d_x[t, :, :n], d_x[t, :, n : 2 * n], d_x[t, :, 2 * n :] = d_z, d_r, d_new
        d_u += h.T @ d_hu
        d_h = d * z + d_hu @ u.T
        if keep is not None:
            d_h *= keep[t][:, None]
    return d_x, d_u


def step_lanes(x: np.ndarray, h: np.ndarray, u: np.ndarray) -> np.ndarray:
    """As ``step``, with lanes last; x: (3 hidden, lanes), h: (hidden, lanes), u: transposed."""
    n = len(h)
    hu = u @ h
    gates = x[: 2 * n] + hu[: 2 * n]
    _sigmoid(gates)
    new = gates[n:] * hu[2 * n :]
    new += x[2 * n :]
    np.tanh(new, out=new)
    h = h - new
    h *= gates[:n]
    h += new
    return h


def _sigmoid(x: np.ndarray) -> None:
    """In place."""
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5


def forward_lanes(x: np.ndarray, u: np.ndarray, h: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, tuple]:
    """As ``forward``, with lanes last: x (time, 3 hidden, lanes), h (hidden, lanes), keep (time, lanes)."""
    time, _, lanes = x.shape
    n = len(h)
    u_t = np.ascontiguousarray(u.T)
    states, news, resets, before = (np.empty((time, n, lanes), x.dtype) for _ in range(4))
    gates = np.empty((time, 2 * n, lanes), x.dtype)
    for t in range(time):
        given = np.multiply(h, keep[t], out=before[t])
        hu = u_t @ given
        gate = np.add(x[t, : 2 * n], hu[: 2 * n], out=gates[t])
        _sigmoid(gate)
        resets[t] = hu[2 * n :]
        new = np.multiply(gate[n:], hu[2 * n :], out=news[t])
        new += x[t, 2 * n :]
        np.tanh(new, out=new)
        h = np.subtract(given, new, out=states[t])
        h *= gate[:n]
        h += new
    return states, (before, gates, news, resets, keep)


def backward_lanes(d_states: np.ndarray, u: np.ndarray, kept: tuple) -> tuple[np.ndarray, np.ndarray]:
    """As ``backward``, with lanes last."""
    before, gates, news, resets, keep = kept
    time, n, lanes = d_states.shape
    d_x, d_hu = np.empty((time, 3 * n, lanes), d_states.dtype), np.empty((time, 3 * n, lanes), d_states.dtype)
    d_u, d_h = np.zeros_like(u), np.zeros((n, lanes), d_states.dtype)
    for t in range(time - 1, -1, -1):
        z, r, new, out, hu = gates[t, :n], gates[t, n:], news[t], d_x[t], d_hu[t]
        d = d_states[t] + d_h
        d_z = d * z
        d_new = np.subtract(d, d_z, out=out[2 * n :])
        d_new *= 1 - new * new
        np.multiply(before[t] - new, d_z, out=out[:n])
        out[:n] *= 1 - z
        np.multiply(d_new, resets[t], out=out[n : 2 * n])
        out[n : 2 * n] *= r * (1 - r)
        hu[: 2 * n] = out[: 2 * n]
        np.multiply(d_new, r, out=hu[2 * n :])
        d_u += before[t] @ hu.T
        d_h = u @ hu
        d_h += d_z
        d_h *= keep[t]
    return d_x, d_u


class Adam:
    """Adam; tables named in ``shared`` take plain steps scaled by their largest gradient, so that
    rows of rare words move as little as their small gradients say."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float, shared: frozenset = frozenset()):
        self.weights, self.rate, self.t, self.shared = weights, rate, 0, shared
        self.m = {k: np.zeros_like(w) for k, w in weights.items()}
        self.v = {k: np.zeros_like(w) for k, w in weights.items()}

    def step(self, grads: dict[str, np.ndarray], clip: float = 5.0) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
        scale = min(1.0, clip / max(norm, 1e-12))
        for k, g in grads.items():
            g = g * scale
            if k in self.shared:
                self.weights[k] -= 4 * self.rate * g / max(np.abs(g).max(), 1e-12)
                continue
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            m, v = self.m[k] / (1 - 0.9**self.t), self.v[k] / (1 - 0.999**self.t)
            self.weights[k] -= self.rate * m / (np.sqrt(v) + 1e-8)
