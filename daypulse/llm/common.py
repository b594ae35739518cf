"""Helpers shared by the operators: reading, lineage cuts, sampling, byte-level words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.session import ensure_checkpoint_dir

#: Bytes of text that a task turns into numpy arrays at a time (a longer text is taken alone).
CHUNK = 1 << 20

#: Bytes that part words: space and tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

_rng = np.random.default_rng(20)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The same rows from the shared checkpoint folder (survives lost executors)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def compact(df: DataFrame, rows: int = 20_000) -> DataFrame:
    """:func:`cut` in as many partitions as hold ``rows`` rows each, or fewer if it has fewer.

    A small table in hundreds of partitions costs every later step as many
    tasks and shuffle files, whatever it holds.  No rows move.
    """
    out = cut(df)
    count = out.coalesce(df.sparkSession.sparkContext.defaultParallelism).count()
    return out.coalesce(max(1, -(-count // rows)))


def id_remainder(col):
    """crc32 of the id as text, modulo 5; 0 marks the held-out rows."""
    return F.crc32(col.cast("string").cast("binary")) % 5


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, text, y) of at most ``per_class`` rows of each class, held-out ids left out.

    The rows with the smallest hash of doc_id are taken, so the choice does not
    depend on partitions.  The chosen ids (2 * per_class rows at most) are
    broadcast onto the documents.  A document with both labels counts as 1.
    """
    known = (
        labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("_id").isNotNull() & F.col("y").isin(0, 1) & (id_remainder(F.col("_id")) != 0))
        .groupBy("_id").agg(F.max("y").alias("y"))
    )
    at = known.join(docs.select(F.col("doc_id").alias("_id")).where("_id is not null").distinct(), "_id", "left_semi")
    take = [
        at.where(F.col("y") == c).orderBy(F.xxhash64("_id"), "_id").limit(per_class) for c in (0, 1)
    ]
    chosen = cut(take[0].unionByName(take[1]))
    rows = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    return rows.join(F.broadcast(chosen), "_id").select(
        F.col("_id").alias("doc_id"), F.coalesce("_text", F.lit("")).alias("text"), "y"
    )


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def chunks(texts: list[bytes], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Index ranges of about ``limit`` bytes each, at least one text in each."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


class Words:
    """The words of several texts as arrays: ``start``/``end`` in ``buf``, ``doc`` of each word."""

    def __init__(self, texts: list[bytes], is_word: np.ndarray):
        joined = b"\n".join(texts)
        self.buf = np.frombuffer(joined, np.uint8)
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.begin = np.cumsum(sizes) - sizes
        self.mask = is_word[self.buf]
        edge = np.diff(self.mask.astype(np.int8), prepend=0, append=0)
        self.start = np.flatnonzero(edge == 1)
        self.end = np.flatnonzero(edge == -1)
        self.doc = np.searchsorted(self.begin, self.start, "right") - 1
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1))  # of each text's words

    def hashes(self, *prefixes: int | None) -> list[np.ndarray]:
        """A 64-bit hash of each word, or of its first bytes, for each of ``prefixes``."""
        if not len(self.start):
            return [np.zeros(0, np.uint64) for _ in prefixes]
        lens = self.end - self.start
        offs = np.cumsum(lens) - lens
        pos = np.arange(int(lens.sum()), dtype=np.int32) - np.repeat(offs, lens).astype(np.int32)
        part = _BYTE[self.buf[self.mask]] * _PLACE[pos & 255]
        out = []
        for p in prefixes:
            out.append(mix(np.add.reduceat(part if p is None else np.where(pos < p, part, np.uint64(0)), offs)))
        return out


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit sums."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))
