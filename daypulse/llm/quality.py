"""Quality: attention-based multiple-instance learning over passages.

A document is a bag of passages of ``PASSAGE`` words.  Every passage is
encoded; gated attention, learnt from document labels alone, weighs the
passages, and the weighted representation is scored.  A bad passage in a long
good text can so decide, and the weights say which one it was.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse.llm.common import SPACE, Words, byte_texts, chunks, labelled_sample

PASSAGE = 48
#: Labelled documents of each class that the fit reads at most.
PER_CLASS = 2500

#: Class of each byte: every ASCII sign its own, and lower, upper, digit, space, line end, other control, beyond ASCII.
SIGNS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
KIND = np.full(256, len(SIGNS) + 5, np.int64)
KIND[list(SIGNS)] = np.arange(len(SIGNS))
for _k, _range in enumerate((range(97, 123), range(65, 91), range(48, 58), (32, 9), (10, 13))):
    KIND[list(_range)] = len(SIGNS) + _k
KIND[128:] = len(SIGNS) + 6
KINDS = len(SIGNS) + 7
LAGS = (1, 2, 3)
WIDTH = KINDS + len(LAGS) + 2


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features of each passage, its text); a text without words is one passage of zeros."""
    words = Words(texts, ~SPACE)
    count = np.diff(words.first)
    place = np.arange(len(words.doc)) - words.first[words.doc]
    first = np.flatnonzero(place % PASSAGE == 0)  # of each passage with words
    doc = words.doc[first]
    x = np.zeros((len(first), WIDTH), np.float32)
    if len(first):
        edges = np.append(words.start[first], len(words.buf))
        bag = np.repeat(np.arange(len(first)), np.diff(edges))
        kinds = np.bincount(bag * KINDS + KIND[words.buf[edges[0] :]], minlength=len(first) * KINDS)
        x[:, :KINDS] = np.sqrt(kinds.reshape(-1, KINDS) / np.maximum(np.diff(edges), 1)[:, None])
        h, ends = words.hashes(None)[0], np.append(first[1:], len(place))
        size = ends - first
        for k, lag in enumerate(LAGS):
            same = np.zeros(len(h), np.float32)
            same[lag:] = (h[lag:] == h[:-lag]) & (words.doc[lag:] == words.doc[:-lag])
            x[:, KINDS + k] = np.add.reduceat(same, first) / size
        x[:, KINDS + len(LAGS)] = np.add.reduceat((words.end - words.start).astype(np.float32), first) / size / 10
        x[:, -1] = size / PASSAGE
    empty = np.flatnonzero(count == 0)
    if len(empty):
        x = np.concatenate([x, np.zeros((len(empty), WIDTH), np.float32)])
        doc = np.concatenate([doc, empty])
        order = np.argsort(doc, kind="stable")
        x, doc = x[order], doc[order]
    return x, doc


def _sigmoid(v):
    return 1 / (1 + np.exp(-np.clip(v, -30, 30)))


def forward(model: dict, x: np.ndarray, first: np.ndarray, bag: np.ndarray) -> dict:
    """Activations for passages ``x``; ``first`` passage of each document, document ``bag`` of each passage."""
    h = np.tanh(((x - model["mean"]) / model["std"]) @ model["W"] + model["b"])
    t, s = np.tanh(h @ model["V"]), _sigmoid(h @ model["U"])
    g = (t * s) @ model["w"]
    e = np.exp(g - np.maximum.reduceat(g, first)[bag])
    a = e / np.add.reduceat(e, first)[bag]
    z = np.add.reduceat(a[:, None] * h, first)
    return {"h": h, "t": t, "s": s, "a": a, "z": z, "p": _sigmoid(z @ model["c"] + model["d"])}


def fit(x: np.ndarray, bag: np.ndarray, y: np.ndarray, width: int = 24, rounds: int = 150, rate: float = 0.02) -> dict:
    """The model from passages, the document of each (sorted, none without) and document labels, by Adam."""
    rng = np.random.default_rng(3)
    small = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    model = {
        "W": small(WIDTH, width), "b": np.zeros(width, np.float32), "V": small(width, width), "U": small(width, width),
        "w": small(width), "c": small(width), "d": np.float32(0),
    }
    model["mean"] = x.mean(axis=0) if len(x) else np.zeros(WIDTH, np.float32)
    model["std"] = (x.std(axis=0) if len(x) else np.zeros(WIDTH, np.float32)) + 0.02
    if len(np.unique(y)) < 2:  # nothing to tell apart: the score is the rate (1 without labels)
        rate = float(y.mean()) if len(y) else 1.0
        return model | {"c": model["c"] * 0, "d": np.float32(np.log((rate + 1e-3) / (1 - rate + 1e-3)))}
    first = np.flatnonzero(np.diff(bag, prepend=-1))
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum()).astype(np.float32)
    standard = (x - model["mean"]) / model["std"]
    names = ["W", "b", "V", "U", "w", "c", "d"]
    m1, m2 = ({n: np.zeros_like(model[n]) for n in names} for _ in range(2))
    for step in range(1, rounds + 1):
        f = forward(model, x, first, bag)
        h, t, s, a, z = (f[k] for k in ("h", "t", "s", "a", "z"))
        up = ((f["p"] - y) * weight).astype(np.float32)
        dz = up[:, None] * model["c"]
        da = (h * dz[bag]).sum(axis=1)
        dg = a * (da - np.add.reduceat(a * da, first)[bag])
        gate = dg[:, None] * model["w"]
        dt, ds = gate * s * (1 - t**2), gate * t * s * (1 - s)
        dh = (a[:, None] * dz[bag] + dt @ model["V"].T + ds @ model["U"].T) * (1 - h**2)
        grads = {
            "W": standard.T @ dh + 1e-4 * model["W"], "b": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ ds,
            "w": (t * s).T @ dg, "c": z.T @ up + 1e-4 * model["c"], "d": up.sum(),
        }
        for n in names:
            m1[n] = 0.9 * m1[n] + 0.1 * grads[n]
            m2[n] = 0.99 * m2[n] + 0.01 * grads[n] ** 2
            model[n] = (model[n] - rate * (m1[n] / (1 - 0.9**step)) / (np.sqrt(m2[n] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def scores(texts: list[bytes], model: dict) -> np.ndarray:
    out = np.zeros(len(texts))
    for lo, hi in chunks(texts):
        x, doc = passages(texts[lo:hi])
        out[lo:hi] = forward(model, x, np.flatnonzero(np.diff(doc, prepend=-1)), doc)["p"]
    return out


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> dict:
    """The model from at most ``per_class`` labelled documents of each class (held-out ids left out).

    Tasks turn texts into passage features; all passages of a chosen document
    reach the driver, since any one may be what its label is for.  Null texts
    count as empty and empty ones are a passage of zeros; labels other than 0
    and 1, and those of null or unknown ids, take no part; rows that repeat an
    id each count.  Without labels of both classes the score is their rate.
    """

    def run(batches):
        for b in batches:
            bags = [passages([t])[0].ravel() for t in byte_texts(b.column(0))]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(bags, pa.list_(pa.float32())), b.column(2), b.column(3)], ["y", "x", "doc_id", "own"])

    sample = labelled_sample(docs, labels, label, per_class).select("text", "y", "doc_id", F.xxhash64("text").alias("own"))
    got = sample.mapInArrow(run, "y int, x array<float>, doc_id long, own long").toArrow().sort_by([("doc_id", "ascending"), ("own", "ascending")])
    column = got.column("x").combine_chunks()
    bag = np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy()) // WIDTH)
    return fit(column.values.to_numpy().reshape(-1, WIDTH), bag, got.column("y").to_numpy())


def score(docs: DataFrame, model: dict, threshold: float = 0.3) -> DataFrame:
    """doc_id, score and predicted of every row of ``docs`` (doc_id, text), whole texts.

    Null and empty texts are one passage of zeros.  Repeated rows get equal
    scores; null ids are kept; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            p = scores(byte_texts(b.column(1)), sent.value)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, score double, predicted int")
