"""Exact substring dedup over word windows by super-k-mer partitioning.

The minimiser of a window is its run of ``m`` words with the smallest hash.
Consecutive windows with the same minimiser form a super-k-mer: one packed
string that goes to the minimiser's bucket, where equal windows meet.

1. Minimisers only are dealt by hash; those that occur once can repeat no window.
2. Super-k-mers of the others are packed and dealt by minimiser; sorted by
   place, a window is a repeat if the same words came before in its bucket.
3. A bucket with very many rows is dealt anew by whole windows.
Repeats that a task already knows are settled there and not sent, so hot
passages shrink to about one row per task before each exchange.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daypulse.llm.common import SPACE, Words, byte_texts, chunks, cut, mix

#: Rows of one minimiser that a task holds before it deals them by window.
CROWD = 200_000
#: Packed strings that a task remembers.
MEMORY = 50_000

#: doc_id and own name a place's document: own tells different texts of one doc_id apart.
ROW = "key long, doc_id long, own long, start int, n int, packed binary"
TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
#: Repeated ids that are broadcast at most; more are joined by a shuffle.
FEW = 1_000_000


def _rows(key, doc, own, start, n, packed):
    cols = [pa.array(c, t) for c, t in zip((key, doc, own, start, n, packed), TYPES)]
    return pa.RecordBatch.from_arrays(cols, ["key", "doc_id", "own", "start", "n", "packed"])


def minimisers(texts: list[bytes], k: int, m: int) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, hash, whether the hash occurs twice in it) of each super-k-mer."""
    words = Words(texts, ~SPACE)
    h, doc = words.hashes(None)[0], words.doc
    count = len(h) - k + 1
    if count < 1:
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(np.uint64), z.astype(bool)
    g = np.zeros(len(h) - m + 1, np.uint64)
    for j in range(m):
        g = g * np.uint64(0xD6E8FEB86659FD93) + h[j : j + len(g)]
    low, span, width = mix(g), 1, k - m + 1
    while span < width:  # running minima of width places by doubling
        step = min(span, width - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    whole = doc[:count] == doc[k - 1 :]  # the window lies in one text
    at = np.flatnonzero(whole)
    if not len(at):
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(np.uint64), z.astype(bool)
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (low[at[1:]] != low[at[:-1]]) | (doc[at[1:]] != doc[at[:-1]])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(at)))
    begin = at[first]
    # a super-k-mer that holds its minimiser twice may repeat a window itself
    span = size + width - 1
    offs = np.cumsum(span) - span
    place = np.arange(int(span.sum())) - np.repeat(offs - begin, span)
    again = np.add.reduceat((mix(g)[place] == np.repeat(low[begin], span)).astype(np.int32), offs) > 1
    return doc[begin], begin - words.first[doc[begin]], size, low[begin], again


def _probe(k: int, m: int):
    """Minimiser rows: key, low (the minimiser where key is not), doc_id, own, place.

    place packs the first window, the number of windows and whether the
    minimiser is sure to repeat (it does within the batch).  Of such rows one
    goes to the minimiser's bucket and the others anywhere.
    """

    def run(batches):
        for b in batches:
            texts = byte_texts(b.column(1))
            ids, owns = b.column(0).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)
            for lo, hi in chunks(texts, 1 << 22):
                parts = [minimisers(texts[a + lo : z + lo], k, m) for a, z in chunks(texts[lo:hi])]
                shift = [a + lo for a, _ in chunks(texts[lo:hi])]
                doc = np.concatenate([p[0] + s for p, s in zip(parts, shift)]).astype(np.int64)
                start, n, low, again = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3, 4))
                if not len(doc):
                    continue
                _, one, back, times = np.unique(low, return_index=True, return_inverse=True, return_counts=True)
                sure = (times[back] > 1) | again
                lead = np.zeros(len(low), bool)
                lead[one] = True
                away = sure & ~lead
                key = np.where(away, mix(low + np.arange(len(low), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)), low)
                place = start.astype(np.int64) << 32 | n.astype(np.int64) << 1 | sure
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key.view(np.int64)), pa.array(low.view(np.int64), mask=~away),
                        pa.array(ids[doc].astype(np.int64)), pa.array(owns[doc].astype(np.int64)), pa.array(place),
                    ],
                    ["key", "low", "doc_id", "own", "place"],
                )

    return run


def _pack(k: int):
    """Packed super-k-mers; one that the task has seen at an earlier place is a settled range."""

    def run(batches):
        seen: dict[bytes, tuple[int, int, int]] = {}
        for b in batches:
            out = ([], [], [], [], [], [])
            for doc, text, own, marks in zip(b.column(0).to_pylist(), byte_texts(b.column(1)), b.column(2).to_pylist(), b.column(3).to_pylist()):
                words = text.split()
                for x in marks:
                    start, n = x["start"], x["n"]
                    packed, here = b" ".join(words[start : start + n + k - 1]), (doc, own, start)
                    at = seen.get(packed)
                    settled = at is not None and at < here
                    if not settled:
                        if len(seen) >= MEMORY:
                            seen.clear()
                        seen[packed] = here
                    for c, v in zip(out, (x["low"], doc, own, start, n, None if settled else packed)):
                        c.append(v)
            # a settled range needs no bucket: any key will do
            key = [p if q is not None else (d * 31 + s) & 0x7FFFFFFF for p, q, d, s in zip(out[0], out[5], out[1], out[3])]
            yield _rows(key, *out[1:])

    return run


def _settle(k: int, split: bool):
    """Rows sorted by key and place: ranges of repeated windows, and single windows of crowded keys."""

    def ranges(rows, seen, emit, often=None):
        """Settle rows in order; ``often``: hashes of the only windows that can repeat."""
        for _, doc, own, start, n, packed in rows:
            words, run = packed.split(b" "), None
            for i in range(len(words) - k + 1):
                window, here = b" ".join(words[i : i + k]), (doc, own, start + i)
                again = (often is None or xxhash.xxh64_intdigest(window) in often) and seen.setdefault(window, here) < here
                if again:
                    run = (run[0] if run else start + i, start + i)
                elif run:
                    emit((0, doc, own, run[0], run[1] - run[0] + 1, None))
                    run = None
            if run:
                emit((0, doc, own, run[0], run[1] - run[0] + 1, None))

    def frequent(rows):
        """Hashes that more than one window of a large group has."""
        hashes = np.array(
            [xxhash.xxh64_intdigest(b" ".join(w[i : i + k])) for r in rows if (w := r[5].split(b" ")) for i in range(len(w) - k + 1)],
            np.uint64,
        )
        found, times = np.unique(hashes, return_counts=True)
        return set(found[times > 1].tolist())

    def scatter(rows, seen, emit):
        for _, doc, own, start, n, packed in rows:
            words = packed.split(b" ")
            for i in range(len(words) - k + 1):
                window, here = b" ".join(words[i : i + k]), (doc, own, start + i)
                at = seen.get(window)
                if at is not None and at < here:
                    emit((0, *here, 1, None))
                    continue
                if len(seen) < MEMORY:
                    seen[window] = here
                emit((xxhash.xxh64_intdigest(window) - (1 << 63), *here, 1, window))

    def run(batches):
        group, key, mode, seen, out = [], None, "hold", {}, []
        emit = out.append

        def flush():
            table = list(zip(*out)) if out else [()] * 6
            spread = [x[0] if x[5] is not None else (x[1] * 31 + x[3]) & 0x7FFFFFFF for x in out]
            out.clear()
            return _rows(spread, *table[1:])

        def close():
            if mode == "hold" and (len(group) > 1 or group and group[0][4] > 1):
                ranges(group, {}, emit, frequent(group) if len(group) > 1000 else None)

        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(6))):
                if row[5] is None:
                    emit(row)
                    continue
                if row[0] != key:
                    close()
                    group, key, mode, seen = [], row[0], "hold", {}
                if mode == "hold":
                    group.append(row)
                    if not split and len(group) == 1 and row[4] == 1:
                        continue
                    if not split or len(group) >= CROWD:
                        if split:
                            mode = "scatter"
                            scatter(group, seen, emit)
                        else:
                            mode = "stream"
                            ranges(group, seen, emit)
                        group = []
                elif mode == "scatter":
                    scatter([row], seen, emit)
                else:
                    ranges([row], seen, emit)
                if len(out) >= 5_000:
                    yield flush()
            yield flush()
        close()
        yield flush()

    return run


def _finish(k: int, with_text: bool):
    def run(batches):
        for b in batches:
            cols = [b.column(0), [], [], [], []]
            for text, spans in zip(byte_texts(b.column(1)), b.column(2).to_pylist()):
                words = kept = text.split()
                if spans:
                    keep = np.ones(len(words), bool)
                    for s in spans:
                        keep[s["start"] : s["start"] + s["n"] + k - 1] = False
                    kept = [words[i] for i in np.flatnonzero(keep)]
                line = b" ".join(kept)
                for c, v in zip(cols[1:], (len(words), len(words) - len(kept), hashlib.sha256(line).hexdigest(), line)):
                    c.append(v)
            types = (None, pa.int64(), pa.int64(), pa.string(), pa.string())
            cols[1:4] = [pa.array(c, t) for c, t in zip(cols[1:4], types[1:4])]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]
            if with_text:
                cols[4] = pa.array([x.decode() for x in cols[4]], pa.string())
            yield pa.RecordBatch.from_arrays(cols if with_text else cols[:4], names if with_text else names[:4])

    return run


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, text and own: 0, or a hash of the text where rows of one doc_id hold different texts.

    The columns are unaliased where no cast is needed, so that both joins read one exchange of the texts.
    """
    have = dict(docs.dtypes)
    want = {"doc_id": "bigint", "text": "string"}
    rows = docs.select(*(F.col(c) if have[c] == t else F.col(c).cast(t).alias(c) for c, t in want.items()))
    own = F.xxhash64("text")
    ids = rows.where("doc_id is not null").select("doc_id", own.alias("own")).groupBy("doc_id")
    repeated = cut(ids.agg(F.min("own").alias("low"), F.max("own").alias("high")).where("low < high").select(F.col("doc_id").alias("again")))
    count = repeated.count()
    if not count:
        return rows.select("doc_id", "text", F.lit(0).cast("long").alias("own"))
    marked = rows.join(F.broadcast(repeated) if count <= FEW else repeated, F.col("doc_id") == F.col("again"), "left")
    return marked.select("doc_id", "text", F.when(F.col("again").isNotNull(), own).otherwise(F.lit(0)).cast("long").alias("own"))


def repeated_windows(texts: DataFrame, k: int = 20, m: int = 7) -> DataFrame:
    """doc_id, own, start, n: runs of ``n`` windows from word ``start`` whose words also start earlier.

    ``texts`` has doc_id, text and own, as :func:`_texts` makes them.
    """
    texts = texts.where("doc_id is not null")
    lows = texts.mapInArrow(_probe(k, m), "key long, low long, doc_id long, own long, place long")
    beside = Window.partitionBy("key").orderBy("doc_id", "own", "place")
    twice = F.lag(F.lit(1)).over(beside).isNotNull() | F.lead(F.lit(1)).over(beside).isNotNull()
    sure = F.col("place").bitwiseAND(F.lit(1)) == 1
    mark = F.struct(
        F.coalesce("low", "key").alias("low"), F.shiftright("place", 32).cast("int").alias("start"),
        F.shiftright(F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)), 1).cast("int").alias("n"),
    )
    marks = lows.withColumn("twice", twice).where(sure | F.col("twice")).select("doc_id", "own", mark.alias("mark"))
    per_doc = marks.groupBy("doc_id", "own").agg(F.collect_set("mark").alias("marks"))
    packed = texts.join(per_doc, ["doc_id", "own"]).select("doc_id", "text", "own", "marks").mapInArrow(_pack(k), ROW)

    def bucketed(df):
        return df.repartition("key").sortWithinPartitions("key", "doc_id", "own", "start")

    first = bucketed(packed).mapInArrow(_settle(k, True), ROW)
    return bucketed(first).mapInArrow(_settle(k, False), ROW).select("doc_id", "own", "start", "n")


def remove_repeats(docs: DataFrame, k: int = 20, m: int = 7, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept_text) of every row of ``docs`` (doc_id, text).

    A word goes if a window of ``k`` consecutive words that covers it also
    starts earlier (in a document with a smaller doc_id, or before it in the
    same document); windows are judged on the whole input.  Words are what
    ASCII white space parts, unchanged.  Null text has no words; texts under
    ``k`` words lose none.  Rows that repeat a doc_id and text count as one
    place and give equal results; rows of one doc_id with different texts are
    documents of their own, in the order of a hash of their texts; rows with a
    null doc_id are returned whole and not compared.  Other columns are ignored.
    """
    own = _texts(docs)
    spans = repeated_windows(own, k, m).groupBy("doc_id", "own").agg(F.collect_set(F.struct("start", "n")).alias("spans"))
    # the named rows are dealt by doc_id and own once, for this join and the one that packs
    named = own.where("doc_id is not null").join(spans, ["doc_id", "own"], "left").select("doc_id", "text", "spans")
    rest = own.where("doc_id is null").select("doc_id", "text", F.lit(None).cast("array<struct<start:int,n:int>>").alias("spans"))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return named.unionByName(rest).mapInArrow(_finish(k, with_text), schema)
