"""Toxicity: a sentence classifier with a counterfactual penalty.

A sentence's logit adds up weights of its hashed words and word beginnings; a
document's is the largest of its sentences.  The fit adds to the logistic loss
the squared change of a labelled sentence's score when an identity term in it
is swapped for each other one of its row, sentence by sentence; and, so that
no labelled text has to mention a group, the squared change of the logit when
a term is put into a sentence.  The mention of a group alone then moves no score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse.llm.common import Words, byte_texts, chunks, labelled_sample

BITS = 18
#: A feature without weight.
NOTHING = 3 << BITS
#: Bytes of word beginnings that are features beside the whole word.
BEGINNINGS = (4, 6)
#: Words in a sentence at most; a longer one is cut.
LONGEST = 40
#: Labelled documents of each class that the fit reads at most.
PER_CLASS = 3000

#: Standard errors of a feature's log odds that count as chance.
ERRORS = 2.5

#: Identity terms, swapped within a row.
IDENTITY_TERMS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("women", "men", "girls", "boys", "transgender", "gay", "lesbian", "straight"),
    ("immigrant", "refugee", "foreigner", "citizen"),
    ("frauen", "männer", "muslime", "juden", "christen", "ausländer"),
    ("femmes", "hommes", "musulmans", "juifs", "chrétiens", "immigrés"),
    ("mujeres", "hombres", "musulmanes", "judíos", "cristianos", "inmigrantes"),
)

WORD = np.zeros(256, bool)
WORD[list(b"0123456789abcdefghijklmnopqrstuvwxyz") + list(range(128, 256))] = True
STOP = np.zeros(256, bool)
STOP[list(b".!?\n")] = True


def _features(words: Words) -> np.ndarray:
    """features[word, kind]: the whole word and its beginnings, each in a part of its own."""
    size, kinds = 1 << BITS, (None, *BEGINNINGS)
    cols = [(h & np.uint64(size - 1)).astype(np.int32) + i * size for i, h in enumerate(words.hashes(*kinds))]
    return np.stack(cols, axis=1)


def sentences(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of each word, first word of each sentence, text of each sentence)."""
    words = Words([t.lower() for t in texts], WORD)
    if not len(words.start):
        return np.zeros((0, 3), np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    stops = np.cumsum(STOP[words.buf], dtype=np.int32)[words.start]
    new = np.ones(len(words.start), bool)
    new[1:] = (np.diff(stops) != 0) | (np.diff(words.doc) != 0)
    first = np.flatnonzero(new)
    place = np.arange(len(new)) - np.repeat(first, np.diff(np.append(first, len(new))))
    first = np.flatnonzero(place % LONGEST == 0)
    f = _features(words)
    same = np.zeros(len(f), bool)
    same[1:] = (f[1:] == f[:-1]).all(axis=1)
    f[same] = NOTHING  # a word said again and again counts once
    return f, first, words.doc[first]


def scores(texts: list[bytes], weights: np.ndarray, bias: float) -> np.ndarray:
    """Score of each text: the sigmoid of its largest sentence logit; without words, of the bias."""
    out = np.full(len(texts), bias)
    for lo, hi in chunks(texts):
        f, first, doc = sentences(texts[lo:hi])
        if len(first):
            logit = np.add.reduceat(weights[f].sum(axis=1), first) + bias
            at = np.flatnonzero(np.diff(doc, prepend=-1))
            out[lo + doc[at]] = np.maximum.reduceat(logit, at)
    return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def _term_features() -> tuple[np.ndarray, list[tuple[int, ...]], dict[bytes, int]]:
    names = [t for row in IDENTITY_TERMS for t in row]
    rows, at = [], 0
    for row in IDENTITY_TERMS:
        rows.append(tuple(range(at, at + len(row))))
        at += len(row)
    f, _, _ = sentences([n.encode() for n in names])
    return f, rows, {n.encode(): i for i, n in enumerate(names)}


def swaps(flat: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sentence, term in it, term put in its place) of each counterfactual of the labelled sentences.

    ``flat`` holds the features of all sentences' words, which start at
    ``offs``.  Every mention of a term gives one sentence for each other term
    of its row; terms are numbers of rows of :func:`_term_features`.
    """
    f, rows, _ = _term_features()
    whole = flat[::3]
    by_feature = np.argsort(f[:, 0], kind="stable")
    at = np.minimum(np.searchsorted(f[by_feature, 0], whole), len(f) - 1)
    place = np.flatnonzero(f[by_feature[at], 0] == whole)
    sentence = np.searchsorted(offs // 3, place, "right") - 1
    others = {t: [o for o in row if o != t] for row in rows for t in row}
    found = [(s, t, o) for s, t in zip(sentence.tolist(), by_feature[at[place]].tolist()) for o in others[t]]
    table = np.array(found, np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2]


def fit(bags: list[np.ndarray], doc: np.ndarray, y: np.ndarray, rounds: int = 80, penalty: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights and bias from ``bags`` (features of each sentence), the document of each, and labels."""
    size = NOTHING + 1
    weights, bias = np.zeros(size, np.float32), -2.0
    if not len(bags) or len(np.unique(y)) < 2:
        rate = float(np.mean(y)) if len(y) else 0.0
        return weights, float(np.log((rate + 1e-3) / (1 - rate + 1e-3)))
    flat = np.concatenate(bags)
    lens = np.array([len(b) for b in bags])
    offs = np.cumsum(lens) - lens
    of_doc = np.repeat(doc.astype(np.int32), lens)
    # start from the log odds of documents that hold a feature; what copies repeat (a word
    # after the same word) counts once, and odds within their own error count nothing
    before = np.roll(flat[::3], 1).astype(np.int64)
    before[offs // 3] = size
    fresh = np.zeros(len(before), bool)
    fresh[np.unique(flat[::3] * np.int64(size + 1) + before, return_index=True)[1]] = True
    fresh, before = np.repeat(fresh, 3), None
    seen = np.full((2, size), 0.5, np.float32)
    ends = np.searchsorted(of_doc, np.arange(len(y) + 1))
    for d in range(len(y)):
        own = slice(ends[d], ends[d + 1])
        seen[y[d], np.unique(flat[own][fresh[own]])] += 1
    neg, pos = seen
    n1, n0 = y.sum(), len(y) - y.sum()
    odds = np.log(pos / (n1 + 1)) - np.log(neg / (n0 + 1))
    known = np.sign(odds) * np.maximum(0, np.abs(odds) - ERRORS * np.sqrt(1 / pos + 1 / neg))
    weights = np.clip(known, -1, 4).astype(np.float32)
    weights[NOTHING] = 0
    told = weights != 0
    terms = _term_features()[0]
    said, own, other = swaps(flat, offs)
    weights[np.unique(terms)] = 0  # identity terms start without weight
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    ids = doc[first]
    rate, square = 0.2, np.full(size, 1e-3)
    for _ in range(rounds):
        logit = np.add.reduceat(weights[flat], offs) + bias
        top = np.maximum.reduceat(logit, first)
        hot = np.zeros(len(y))
        hot[ids] = top
        best = np.flatnonzero(logit == hot[doc])
        best = best[np.unique(doc[best], return_index=True)[1]]
        p = 1 / (1 + np.exp(-np.clip(logit[best], -30, 30)))
        side = np.where(y[doc[best]] == 1, 0.5 / n1, 0.5 / n0)
        err = (p - y[doc[best]]) * side
        grad = np.zeros(size)
        for s, e in zip(best.tolist(), err.tolist()):
            np.add.at(grad, bags[s], e)
        # a term put into a sentence: the logit changes by its weights
        put = weights[terms].sum(axis=1)
        np.add.at(grad, terms.ravel(), np.repeat(2 * penalty * put / len(put), 3))
        if len(said):  # a term swapped in a labelled sentence: the score changes from p to q
            swapped = logit[said] + put[other] - put[own]
            p, q = (1 / (1 + np.exp(-np.clip(v, -30, 30))) for v in (logit[said], swapped))
            step, dp, dq = 2 * penalty * (q - p) / len(said), p * (1 - p), q * (1 - q)
            np.add.at(grad, terms[other].ravel(), np.repeat(step * dq, 3))
            np.add.at(grad, terms[own].ravel(), -np.repeat(step * dq, 3))
            whole = np.bincount(said, weights=step * (dq - dp), minlength=len(lens))
            for s in np.flatnonzero(whole).tolist():
                np.add.at(grad, bags[s], whole[s])
        grad = np.where(told, grad, 0) + 1e-5 * weights
        square += grad**2
        weights = (weights - rate * grad / np.sqrt(square)).astype(np.float32)
        bias -= rate * err.sum()
    return weights, float(bias)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> tuple[np.ndarray, float]:
    """The model from at most ``per_class`` labelled documents of each class (held-out ids left out).

    Tasks turn texts into features; all sentences of a chosen document reach
    the driver, whatever its label.  Null texts count as empty, and empty ones
    have no sentence; labels other than 0 and 1, and those of null or unknown
    ids, take no part; rows that repeat an id each count.  Without labels of
    both classes the score is their rate.
    """

    def run(batches):
        for b in batches:
            texts = byte_texts(b.column(0))
            for lo, hi in chunks(texts):
                flat, ends, bags = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)], [0]
                at = 0
                for t in texts[lo:hi]:  # features stay in arrays: as lists they take ten times the memory
                    f, first, _ = sentences([t])
                    flat.append(f.ravel())
                    ends.append(at + np.append(first[1:], len(f))[: len(first)] * 3)
                    at += f.size
                    bags.append(bags[-1] + len(first))
                inner = pa.ListArray.from_arrays(np.concatenate(ends).astype(np.int32), pa.array(np.concatenate(flat), pa.int32()))
                outer = pa.ListArray.from_arrays(np.array(bags, np.int32), inner)
                rest = [b.column(k).slice(lo, hi - lo) for k in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays([rest[0], outer, *rest[1:]], ["y", "bags", "doc_id", "own"])

    sample = labelled_sample(docs, labels, label, per_class).select("text", "y", "doc_id", F.xxhash64("text").alias("own"))
    got = sample.mapInArrow(run, "y int, bags array<array<int>>, doc_id long, own long").toArrow()
    got = got.sort_by([("doc_id", "ascending"), ("own", "ascending")])
    y = got.column("y").to_numpy()
    column = got.column("bags").combine_chunks()
    doc = np.repeat(np.arange(len(y)), np.diff(column.offsets.to_numpy()))
    inner = column.values
    flat, cuts = inner.values.to_numpy(), inner.offsets.to_numpy()
    return fit([flat[a:z] for a, z in zip(cuts[:-1], cuts[1:])], doc, y)


def score(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = 0.5) -> DataFrame:
    """doc_id, score and predicted of every row of ``docs`` (doc_id, text), whole texts.

    Null and empty texts score as the bias alone.  Repeated rows get equal
    scores; null ids are kept; other columns are ignored.  The weights (a
    fixed size) are broadcast.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        weights, bias = sent.value
        for b in batches:
            p = scores(byte_texts(b.column(1)), weights, bias)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, score double, predicted int")


def keep_clean(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score under ``threshold``; no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        weights, bias = sent.value
        for b in batches:
            yield b.filter(pa.array(scores(byte_texts(b.column(at)), weights, bias) < threshold))

    return docs.mapInArrow(run, docs.schema)
