"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Tags are O and, for each kind, B (first character) and I (the others).  The
CRF forbids I after anything but B or I of its kind, and no span may be
without a digit or an ``@``, so a window without either needs no reading.
"""

from __future__ import annotations

import numpy as np

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)
#: Characters of their own; the others are lower, upper, digit, other space, beyond ASCII, other.
SIGNS = "@.-+()_% ,:;=\"'/\n"
CLASSES = len(SIGNS) + 6
NEVER = np.float32(-1e4)

_CLASS = np.full(128, len(SIGNS) + 5, np.int8)
for _c in range(128):
    if chr(_c).isalpha():
        _CLASS[_c] = len(SIGNS) + (0 if chr(_c).islower() else 1)
    elif chr(_c).isdigit():
        _CLASS[_c] = len(SIGNS) + 2
    elif chr(_c).isspace():
        _CLASS[_c] = len(SIGNS) + 3
for _i, _s in enumerate(SIGNS):
    _CLASS[ord(_s)] = _i


def classes(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(code < 128, _CLASS[np.minimum(code, 127)], len(SIGNS) + 4).astype(np.int8)


def _allowed() -> np.ndarray:
    ok = np.ones((TAGS, TAGS), bool)
    for k in range(len(KINDS)):
        b, i = 1 + 2 * k, 2 + 2 * k
        ok[:, i] = False
        ok[[b, i], i] = True
    return ok


ALLOWED = _allowed()
START = np.array([t == 0 or t % 2 == 1 for t in range(TAGS)])


def new_model(hidden: int = 16, embed: int = 8) -> dict:
    rng = np.random.default_rng(11)
    small = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    model = {"E": small(CLASSES, embed) * 2, "O": small(2 * hidden, TAGS), "o": np.zeros(TAGS, np.float32), "T": np.zeros((TAGS, TAGS), np.float32)}
    for d in "fb":
        model["W" + d] = small(embed + hidden, 4 * hidden)
        model["b" + d] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)]).astype(np.float32)
    return model


def _sigmoid(v):
    return 1 / (1 + np.exp(-v))


def _lstm(x: np.ndarray, w: np.ndarray, b: np.ndarray, keep: bool):
    """x[time, row, embed] -> h[time, row, hidden], and what the way back needs."""
    steps, rows, embed = x.shape
    size = w.shape[1] // 4
    h, c = np.zeros((rows, size), np.float32), np.zeros((rows, size), np.float32)
    hs, trail = np.empty((steps, rows, size), np.float32), []
    inner = (x.reshape(-1, embed) @ w[:embed] + b).reshape(steps, rows, -1)
    for t in range(steps):
        a = inner[t] + h @ w[embed:]
        gate, cand = _sigmoid(a[:, : 3 * size]), np.tanh(a[:, 3 * size :])
        i, f, o = gate[:, :size], gate[:, size : 2 * size], gate[:, 2 * size :]
        before = c
        c = f * c + i * cand
        tc = np.tanh(c)
        if keep:
            trail.append((h, before, i, f, o, cand, tc))
        h = o * tc
        hs[t] = h
    return hs, trail


def _lstm_back(x, w, trail, dhs):
    """Gradients (dx, dw, db) from those of the outputs."""
    steps, rows, embed = x.shape
    size = w.shape[1] // 4
    dw, db, dx = np.zeros_like(w), np.zeros(4 * size, np.float32), np.empty_like(x)
    dh, dc = np.zeros((rows, size), np.float32), np.zeros((rows, size), np.float32)
    for t in reversed(range(steps)):
        h, before, i, f, o, cand, tc = trail[t]
        dh = dh + dhs[t]
        dc = dc + dh * o * (1 - tc**2)
        da = np.concatenate([dc * cand * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - cand**2)], axis=1)
        dw[:embed] += x[t].T @ da
        dw[embed:] += h.T @ da
        db += da.sum(axis=0)
        dx[t] = da @ w[:embed].T
        dh, dc = da @ w[embed:].T, dc * f
    return dx, dw, db


def emissions(model: dict, cls: np.ndarray, keep: bool = False):
    """cls[row, time] -> emission[time, row, tag]."""
    x = model["E"][cls.T]
    hf, tf = _lstm(x, model["Wf"], model["bf"], keep)
    hb, tb = _lstm(x[::-1], model["Wb"], model["bb"], keep)
    h = np.concatenate([hf, hb[::-1]], axis=2)
    return h @ model["O"] + model["o"], (x, h, tf, tb)


def _transitions(model: dict) -> np.ndarray:
    return np.where(ALLOWED, model["T"], NEVER)


def _logsum(v: np.ndarray, axis: int) -> np.ndarray:
    top = v.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(v - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(model: dict, em: np.ndarray):
    """(log Z[row], alpha, beta) of the CRF."""
    trans, steps = _transitions(model), len(em)
    alpha, beta = np.empty_like(em), np.zeros_like(em)
    alpha[0] = em[0] + np.where(START, 0, NEVER)
    for t in range(1, steps):
        alpha[t] = em[t] + _logsum(alpha[t - 1][:, :, None] + trans, 1)
    for t in range(steps - 2, -1, -1):
        beta[t] = _logsum(trans + (em[t + 1] + beta[t + 1])[:, None, :], 2)
    return _logsum(alpha[-1], 1), alpha, beta


def gradients(model: dict, cls: np.ndarray, tags: np.ndarray):
    """(mean negative log-likelihood, its gradients) for windows of equal length."""
    em, (x, h, tf, tb) = emissions(model, cls, True)
    steps, rows, _ = em.shape
    z, alpha, beta = marginals(model, em)
    tag, row = tags.T, np.arange(rows)
    trans = _transitions(model)
    gold = sum(em[t, row, tag[t]] for t in range(steps)) + sum(trans[tag[t - 1], tag[t]] for t in range(1, steps))
    dem = np.exp(alpha + beta - z[:, None])
    dtrans = np.zeros_like(trans)
    for t in range(1, steps):
        dtrans += np.exp(alpha[t - 1][:, :, None] + trans + (em[t] + beta[t])[:, None, :] - z[:, None, None]).sum(axis=0)
        np.add.at(dtrans, (tag[t - 1], tag[t]), -1)
    dem[np.arange(steps)[:, None], row[None, :], tag] -= 1
    dem = (dem / rows).astype(np.float32)
    dh = dem @ model["O"].T
    size = model["O"].shape[0] // 2
    dxf, dwf, dbf = _lstm_back(x, model["Wf"], tf, dh[:, :, :size])
    dxb, dwb, dbb = _lstm_back(x[::-1], model["Wb"], tb, dh[::-1, :, size:])
    de = np.zeros_like(model["E"])
    np.add.at(de, cls.T, dxf + dxb[::-1])
    flat = h.reshape(-1, 2 * size)
    return float((z - gold).mean()), {
        "E": de, "O": flat.T @ dem.reshape(-1, TAGS), "o": dem.sum(axis=(0, 1)), "T": np.where(ALLOWED, dtrans / rows, 0).astype(np.float32),
        "Wf": dwf, "bf": dbf, "Wb": dwb, "bb": dbb,
    }


def fit(cls: np.ndarray, tags: np.ndarray, steps: int = 500, batch: int = 64, rate: float = 0.02) -> dict:
    """The model from labelled windows, by Adam in ``steps`` shuffled batches; none give an untrained model that tags nothing."""
    model, rng = new_model(), np.random.default_rng(5)
    if not len(cls):
        model["o"][0] = 50
        return model
    m1, m2 = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    order = np.concatenate([rng.permutation(len(cls)) for _ in range(-(-steps * batch // len(cls)))])
    for step in range(1, steps + 1):
        own = order[(step - 1) * batch : step * batch]
        _, grads = gradients(model, cls[own], tags[own])
        norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
        scale, pace = min(1, 5 / (norm + 1e-9)), rate * (1 - 0.95 * step / steps)
        for k, g in grads.items():
            m1[k] = 0.9 * m1[k] + 0.1 * scale * g
            m2[k] = 0.99 * m2[k] + 0.01 * (scale * g) ** 2
            model[k] = (model[k] - pace * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def decode(model: dict, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(best tags[row, time], their marginal probability) by Viterbi and forward-backward."""
    em, _ = emissions(model, cls)
    trans, steps = _transitions(model), len(em)
    best, back = em[0] + np.where(START, 0, NEVER), np.empty(em.shape, np.int8)
    for t in range(1, steps):
        v = best[:, :, None] + trans
        back[t] = v.argmax(axis=1)
        best = em[t] + v.max(axis=1)
    tags = np.empty((steps, em.shape[1]), np.int8)
    tags[-1] = best.argmax(axis=1)
    row = np.arange(em.shape[1])
    for t in range(steps - 1, 0, -1):
        tags[t - 1] = back[t, row, tags[t]]
    z, alpha, beta = marginals(model, em)
    p = np.exp(np.take_along_axis(alpha + beta, tags[:, :, None].astype(int), 2).squeeze(2) - z)
    return tags.T, p.T
