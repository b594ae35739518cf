"""Personal data: fixed patterns, and a character tagger that adds to them.

The base patterns are searched in whole texts.  The tagger (``tagger.py``) is
trained on windows labelled by base spans and by rewritten forms of them; it
reads overlapping windows, of which each character takes the tag from the
window it is most central in, so that the spans of a text are decided once for
the whole text.  A tagged span is added if it crosses no base span and is sure.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse.llm import tagger
from daypulse.llm.tagger import KINDS

#: Length and step of the tagger's windows.
WINDOW, STEP = 64, 32
#: Documents that the fit reads at most, and windows of one of them.
DOCS, WINDOWS = 12_000, 4
#: Smallest mean probability of an added span.
SURE = 0.9

# A match cannot start inside a run of its first characters except right after
# another match, so runs are entered at their start only: linear on any text.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_EMAIL_RUN = re.compile(r"(?<![A-Za-z0-9._%+-])" + _EMAIL.pattern)
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_DIGIT = re.compile(r"[0-9]")


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by the fixed patterns, by kind and start; code points, end exclusive."""
    out: list[tuple[int, int, int]] = []
    pos = 0
    while "@" in text and (m := _EMAIL.match(text, pos) or _EMAIL_RUN.search(text, pos)):
        out.append((0, m.start(), m.end()))
        pos = m.end()
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def _window_starts(text: str) -> list[int]:
    """Starts of the windows that hold a digit or an @; the others hold no span."""
    last = max(0, -(-(len(text) - WINDOW) // STEP))
    own: dict[int, None] = {}
    for m in _MARK.finditer(text):
        for k in range(max(0, (m.start() - WINDOW) // STEP + 1), min(last, m.start() // STEP) + 1):
            own[k] = None
    return [k * STEP for k in own]


def _cells(text: str, start: int) -> np.ndarray:
    return tagger.classes(text[start : start + WINDOW].ljust(WINDOW))


def tagged_spans(texts: list[str], model: dict, batch: int = 2048) -> list[list[tuple[int, int, int, float]]]:
    """(kind, start, end, mean probability) that the tagger finds in each text."""
    places = [(i, s) for i, t in enumerate(texts) for s in _window_starts(t)]
    marks: list[dict[int, tuple[int, float]]] = [{} for _ in texts]
    edge = (WINDOW - STEP) // 2
    for a in range(0, len(places), batch):
        part = places[a : a + batch]
        tags, p = tagger.decode(model, np.stack([_cells(texts[i], s) for i, s in part]))
        for r, c in zip(*np.nonzero(tags)):
            i, s = part[r]
            size = len(texts[i])
            # the middle of the window, and up to the ends of the text
            if (c >= edge or s == 0) and (c < WINDOW - edge or s + WINDOW >= size) and s + c < size:
                marks[i][int(s + c)] = (int(tags[r, c]), float(p[r, c]))
    out = []
    for own in marks:
        spans, run = [], None
        for at in sorted(own):
            tag, p = own[at]
            kind = (tag - 1) // 2
            if run and at == run[2] and kind == run[0] and tag % 2 == 0:
                run[2], run[3] = at + 1, run[3] + p
            else:
                run = [kind, at, at + 1, p]
                spans.append(run)
        out.append([(k, a, z, p / (z - a)) for k, a, z, p in spans])
    return out


def _plausible(kind: int, text: str, a: int, z: int) -> bool:
    """Whether a tagged span is a whole token of its kind's size (a card also by its check digit)."""
    span = text[a:z]
    if span != span.strip() or text[max(0, a - 1) : a].isalnum() or text[z : z + 1].isalnum():
        return False
    digits = "".join(c for c in span if c in "0123456789")
    n = len(digits)
    return ("@" in span[1:-1], span.count(".") == 3 and 4 <= n <= 12, 13 <= n <= 19 and _luhn(digits), 9 <= n <= 15)[kind]


def all_spans(texts: list[str], model: dict) -> list[tuple[list, list]]:
    """(base spans, added spans) of each text."""
    out = []
    for text, tagged in zip(texts, tagged_spans(texts, model)):
        base = base_spans(text)
        added = [
            (k, a, z) for k, a, z, p in tagged
            if p >= SURE and _plausible(k, text, a, z) and not any(a < e and s < z for _, s, e in base)
        ]
        out.append((base, added))
    return out


def written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for k, a, z in sorted(spans))


def _rewrite(kind: int, span: str, turn: int) -> str:
    """Another way to write the same kind of datum."""
    if kind == 3:
        digits = re.sub("[^0-9]", "", span)[-10:]
        a, b, c = digits[:3], digits[3:6], digits[6:]
        return (f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{digits[:1]} {a} {b} {c}")[turn % 4]
    if kind == 2:
        digits = re.sub("[^0-9]", "", span)
        return (" ", "-", ".", "")[turn % 4].join(digits[i : i + 4] for i in range(0, len(digits), 4))
    return span


def labelled_windows(text: str, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """At most ``WINDOWS`` (classes, tags) of one text: around its spans (half of them rewritten), else around digits."""
    rng = np.random.default_rng(seed & 0xFFFFFFFF)
    base = base_spans(text)
    out = []
    for k, a, z in [base[i] for i in rng.permutation(len(base))[: WINDOWS - 1]]:
        turn = int(rng.integers(8))
        own = _rewrite(k, text[a:z], turn) if turn < 4 else text[a:z]
        before = int(rng.integers(0, max(1, WINDOW - len(own))))
        others = [s for s in base if s != (k, a, z) and s[1] < z + WINDOW and s[2] > a - WINDOW]
        if others or len(own) >= WINDOW:
            continue
        head, tail = text[max(0, a - before) : a], text[z : z + WINDOW]
        tags = np.zeros(WINDOW, np.int8)
        tags[len(head) : len(head) + len(own)] = 2 + 2 * k
        tags[len(head)] = 1 + 2 * k
        out.append((tagger.classes((head + own + tail)[:WINDOW].ljust(WINDOW)), tags))
    free = [m.start() for m in _MARK.finditer(text) if not any(a - WINDOW < m.start() < z + WINDOW for _, a, z in base)]
    if free:
        s = max(0, free[int(rng.integers(len(free)))] - int(rng.integers(WINDOW)))
        out.append((_cells(text, s), np.zeros(WINDOW, np.int8)))
    return out


def train(docs: DataFrame, sample: int = DOCS) -> dict:
    """The tagger from at most ``sample`` documents (those with the smallest hash of doc_id), ``WINDOWS`` windows each."""
    ids = docs.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id")

    def run(batches):
        for b in batches:
            cls, tags = [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for c, g in labelled_windows(t or "", int(i)):
                    cls.append(c.tobytes())
                    tags.append(g.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.binary()), pa.array(tags, pa.binary())], ["cls", "tags"])

    got = rows.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "cls binary, tags binary").orderBy("cls", "tags").toArrow()
    grid = lambda name: np.frombuffer(b"".join(got.column(name).to_pylist()), np.int8).reshape(-1, WINDOW)
    return tagger.fit(grid("cls").astype(np.int64), grid("tags").astype(np.int64))


def _spans_of(texts: list[str], model: dict) -> list[tuple[list, list]]:
    """As all_spans; only texts with a digit or an @ are looked at, the others hold no span."""
    out: list[tuple[list, list]] = [([], [])] * len(texts)
    at = [i for i, t in enumerate(texts) if _MARK.search(t)]
    for a in range(0, len(at), 256):
        own = at[a : a + 256]
        for i, found in zip(own, all_spans([texts[i] for i in own], model)):
            out[i] = found
    return out


def find(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, the number of base spans of each kind, their digest and all spans, for every row of ``docs``.

    Null and empty texts have no spans.  Repeated rows give equal results;
    null ids are kept; columns other than doc_id and text are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    counts = [f"n_{k}" for k in KINDS]

    def run(batches):
        for b in batches:
            found = _spans_of([t or "" for t in b.column(1).to_pylist()], sent.value)
            n = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in range(len(KINDS))]
            digest = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found]
            spans = [written([*base, *added]) for base, added in found]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *n, pa.array(digest, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", *counts, "base_sha256", "spans"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in counts) + ", base_sha256 string, spans string")


def masked(text: str, spans: list) -> str:
    """The text with spans replaced by ``[KIND]``; spans that touch become one, named after its first."""
    out, at = [], 0
    for k, a, z in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if a >= at:
            out.append(text[at:a] + f"[{KINDS[k].upper()}]")
        at = max(at, z)
    return "".join(out) + text[at:]


def mask(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs``, with all their columns, personal data in text masked (null text stays null)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            texts = b.column(at).to_pylist()
            found = _spans_of([t or "" for t in texts], sent.value)
            new = [t if t is None else masked(t, [*base, *added]) for t, (base, added) in zip(texts, found)]
            yield b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
