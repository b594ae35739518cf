"""Periodic runs of words by a dictionary of basic factors.

Level k names the factors of 2^k words.  A run of period q, 2^k <= q <
2^(k+1), repeats the factor at its first word q words on, so the occurrences
that follow a factor at distance m = 2^k up to 2m propose its periods.  They
start within m places of each other and so form an arithmetic progression:

* the first of them is proposed;
* of a progression with difference p, the factor lies in a stretch of period p
  and its occurrences in a second one.  A run that begins where the first
  stretch does maps the end of one stretch on that of the other, so the
  distance of the ends is the only other proposal.  (A run that begins later
  maps the place before it on a break, so the second stretch begins there: the
  first proposal.)

A proposal counts only at the place where its period cannot be carried on to
the left; the names, longest first, extend it to the right.  Equal stretches
are one run with the smallest period.  A factor that is unique in its text is
followed no longer, so ordinary prose costs a few levels.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse.llm.common import SPACE, Words, byte_texts, chunks
from daypulse.llm.hashing import word_hashes

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class Factors:
    """Names of the basic factors of several texts; ``first`` holds the texts' bounds in the words."""

    def __init__(self, words: np.ndarray, first: np.ndarray):
        sizes = np.diff(first)
        self.n = len(words)
        self.begin = np.repeat(first[:-1], sizes)
        self.stop = np.repeat(first[1:], sizes)
        self.levels: list[np.ndarray] = []
        self.proposals: list[tuple[np.ndarray, np.ndarray]] = []
        self.stretches: list[tuple[np.ndarray, ...]] = []
        at, name = np.arange(self.n), np.unique(words, return_inverse=True)[1].astype(np.int64)
        while len(at):
            at, name = self._level(at, name)

    def _level(self, at: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Take the factors of the next level in, propose periods, return the next level's factors."""
        m, stride = 1 << len(self.levels), 4 * self.n
        own = np.full(self.n + 1, -1, np.int64)
        own[at] = name
        self.levels.append(own)
        key = name * stride + at
        key.sort()
        x, g = key % stride, key // stride
        near = np.zeros(len(x), bool)  # the next occurrence is in the same text
        near[:-1] = (g[1:] == g[:-1]) & (self.stop[x[1:]] == self.stop[x[:-1]])
        t = np.flatnonzero(near)
        t = t[x[t + 1] - x[t] < 2 * m]
        lo = np.searchsorted(key, key[t] + m)
        hi = np.searchsorted(key, key[t] - x[t] + np.minimum(x[t] + 2 * m, self.stop[x[t]] - m + 1))
        some = hi > lo
        i, lo, many = x[t[some]], lo[some], (hi - lo)[some] > 1
        self._propose(i, x[lo] - i)
        i, lo = i[many], lo[many]
        p = x[lo + 1] - x[lo]
        edge = self._edge(i, p)
        self.stretches.append((i[edge], x[lo][edge], p[edge]))
        again = near.copy()
        again[1:] |= near[:-1]
        seen = np.zeros(self.n + 1, bool)
        seen[x[again]] = True
        at = at[seen[at] & (at + 2 * m <= self.stop[at])]
        at = at[seen[at + m]]
        if not len(at):
            return at, at
        return at, np.unique(own[at] * stride + own[at + m], return_inverse=True)[1].astype(np.int64)

    def _edge(self, i: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether period ``q`` cannot be carried on to the left of place ``i``."""
        return (i == self.begin[i]) | (self.levels[0][i - 1] != self.levels[0][i - 1 + q])

    def _propose(self, i: np.ndarray, q: np.ndarray) -> None:
        edge = self._edge(i, q)
        self.proposals.append((i[edge], q[edge]))

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from place ``i`` on equal those from ``j`` > i on, within the text."""
        i, j, stop, length = i.copy(), j.copy(), self.stop[i], np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            own, m = self.levels[k], 1 << k
            a = own[np.minimum(i, self.n)]
            step = (j + m <= stop) & (a >= 0) & (a == own[np.minimum(j, self.n)])
            for v in (i, j, length):
                v[step] += m
        return length

    def runs(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, period) of every run of at least ``least`` words, by start, then period."""
        for i, x, p in self.stretches:
            q = x + self.common(x, x + p) - i - self.common(i, i + p)
            ok = q > 0
            ok[ok] &= (i[ok] + q[ok]) < self.stop[i[ok]]
            self._propose(i[ok], q[ok])
        start, period = (np.concatenate([c[k] for c in self.proposals] or [np.zeros(0, np.int64)]) for k in (0, 1))
        length = period + self.common(start, start + period)
        keep = length >= np.maximum(least, 2 * period)
        start, length, period = start[keep], length[keep], period[keep]
        order = np.lexsort((period, length, start))
        start, length, period = start[order], length[order], period[order]
        new = np.ones(len(start), bool)
        new[1:] = (np.diff(start) != 0) | (np.diff(length) != 0)
        start, length, period = start[new], length[new], period[new]
        order = np.lexsort((period, start))
        return start[order], length[order], period[order]


def find(texts: list[bytes], least: int) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text's words."""
    words = Words(texts, ~SPACE)
    start, length, period = Factors(word_hashes(words), words.first).runs(least)
    bounds = np.searchsorted(start, words.first)
    start = start - words.first[np.searchsorted(words.first, start, "right") - 1]
    rows = list(zip(start.tolist(), length.tolist(), period.tolist()))
    return [rows[a:z] for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def periodic_runs(docs: DataFrame, least: int = 12) -> DataFrame:
    """doc_id, n_words, runs (start, length, period of each, by start, then period) and collapsed text of every row.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored.  Words
    are what ASCII white space parts, numbered from 0.  A run is a stretch of
    at least ``least`` words and two periods, ``period`` being its smallest,
    that no neighbouring word extends.  ``collapsed`` joins with a space the
    words that no run holds after its first period.  Null and empty texts have
    no words, no runs and an empty collapsed text; rows are judged one by one,
    so null or repeated ids and repeated rows make no difference; no rows give
    no rows.  A task holds one text, or about 1 MB of shorter ones, at a time.
    """

    def run(batches):
        for b in batches:
            texts = byte_texts(b.column(1))
            for lo, hi in chunks(texts):
                part = texts[lo:hi]
                found = find(part, least)
                split = [t.split() for t in part]
                lines = [b" ".join(collapse(w, r) if r else w) for w, r in zip(split, found)]
                flat = [r for rows in found for r in rows]
                offsets = np.concatenate(([0], np.cumsum([len(r) for r in found]))).astype(np.int32)
                cells = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
                runs = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(cells, ["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array([len(w) for w in split], pa.int64()), runs, pa.array(lines, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)
