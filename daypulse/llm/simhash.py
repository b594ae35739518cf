"""SimHash near-dedup with covering locality-sensitive hashing.

Bit i of a 64-bit word belongs to one of 2^(r+1)-1 nonzero vectors of r+1
bits; mask v keeps the bits whose vector has an odd product with v.  Bits that
differ in at most r places span at most r of the r+1 dimensions, so some mask
keeps none of them: every pair within the radius meets in some table.

Inside the tables no pair is formed.  Words x and y differ in at most r bits
exactly if some word z is within ceil(r/2) bits of one and floor(r/2) of the
other, so each word that shares a bucket is sent to the words around it, and
each z holds at most as many different words as a ball of that radius.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse.llm.common import byte_texts, cut
from daypulse.llm.components import connected

SEED = 42
#: Rows that go whose ids are broadcast at most; more are joined by a shuffle.
FEW = 2_000_000


def fingerprint(text: bytes, shingle: int) -> int:
    """64-bit SimHash (as a signed number) of the word shingles of one text."""
    words = text.lower().split()  # bytes: only A-Z change, ASCII white space parts
    if not words:
        return 0
    n = len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    if n <= 1:
        h = [digest(b" ".join(words), SEED)]
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        h = [digest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[shingle - 1 :].tolist())]
    counts = np.zeros(64, np.int64)
    hashes = np.array(h, dtype="<u8")
    for i in range(0, len(hashes), 1 << 14):
        part = hashes[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, own, fp) of every row; null text has no words and so fingerprint 0, ``own`` is a hash of the text."""

    def run(batches):
        for b in batches:
            fps = [fingerprint(t, shingle) for t in byte_texts(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fps, pa.int64())], ["doc_id", "own", "fp"])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text, _own(text)).mapInArrow(run, "doc_id long, own long, fp long")


def _own(text):
    return F.xxhash64(text).alias("own")


def covering_masks(radius: int) -> list[int]:
    """The 2^(radius+1)-1 masks over 64 bits, as signed numbers."""
    m = (1 << (radius + 1)) - 1
    vector = [i % m + 1 for i in range(64)]
    masks = [sum(1 << i for i in range(64) if (vector[i] & v).bit_count() % 2) for v in range(1, m + 1)]
    return [x - (1 << 64) if x >> 63 else x for x in masks]


def _flips(radius: int) -> list[int]:
    masks = [sum(1 << i for i in c) for k in range(radius + 1) for c in combinations(range(64), k)]
    return [x - (1 << 64) if x >> 63 else x for x in masks]


def _longs(values: list[int]):
    return F.from_json(F.lit(str(values)), "array<long>")


def links(words: DataFrame, radius: int = 2) -> DataFrame:
    """(u, v): links that connect the different fingerprints ``fp`` within ``radius`` bits."""
    masks = covering_masks(radius)
    probes = words.select("fp", F.posexplode(_longs(masks)).alias("t", "m")).select(
        "fp", "t", F.col("fp").bitwiseAND(F.col("m")).alias("key")
    )
    crowded = probes.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1").select("t", "key")
    met = cut(probes.join(crowded, ["t", "key"], "left_semi").select("fp").distinct())
    far = met.select("fp", F.explode(_longs(_flips((radius + 1) // 2))).alias("x"))
    around = far.select("fp", F.col("fp").bitwiseXOR(F.col("x")).alias("z"), F.bit_count("x").alias("d"))
    near = F.min(F.when(F.col("d") <= radius // 2, F.col("fp")))
    # at most a ball of different words around each z, so the list is bounded
    balls = around.groupBy("z").agg(near.alias("u"), F.collect_set("fp").alias("vs")).where("u is not null and size(vs) > 1")
    return balls.select("u", F.explode("vs").alias("v")).where("u <> v").distinct()


def _groups(fps: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root): the smallest fingerprint that each one reaches by links of at most ``max_bits`` bits."""
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be 0 to 3")
    words = cut(fps.select("fp").distinct())
    if not max_bits:
        return words.select("fp", F.col("fp").alias("root"))
    linked = connected(links(words, max_bits)).select(F.col("node").alias("fp"), "root")
    return cut(words.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored.  Rows
    link if their fingerprints differ in at most ``max_bits`` (0 to 3) bits;
    component_id is the smallest doc_id reachable.  Null and empty texts have
    fingerprint zero and link like any other; rows with a null doc_id join
    groups without naming them (a group of only such rows has a null
    component_id).  Repeated rows come back repeated; no rows give no rows.
    """
    fps = cut(fingerprints(docs, shingle))
    groups = _groups(fps, max_bits)
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    best = groups.join(least, "fp").groupBy("root").agg(F.min("least").alias("component_id"))
    # both sides of the last join come straight from an exchange, so Spark can split a hot fingerprint
    names = cut(groups.join(best, "root").select("fp", "component_id"))
    return fps.join(names, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of ``docs`` of each group of near copies, with all its columns.

    Rows are judged one by one, by their own text: the row with the smallest
    doc_id stays (null ids last; of rows with equal ids that of the smallest
    hash of its text; of equal rows any one).  Groups are those of
    :func:`near_duplicates`; no rows give no rows.  The rows that go are
    counted first: up to ``FEW`` are broadcast, and no text is shuffled.
    """
    fps = cut(fingerprints(docs, shingle))
    groups = _groups(fps, max_bits)
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "own")
    # equal rows are one row here, and so is a hot fingerprint in each task
    rows = fps.groupBy("fp", "doc_id", "own").agg(F.count("*").alias("times"))
    firsts = groups.join(fps.groupBy("fp").agg(F.min(place).alias("first")), "fp").groupBy("root").agg(F.min("first").alias("first"))
    named = cut(groups.join(firsts, "root").select("fp", "first"))
    stays = (F.col("doc_id").eqNullSafe(F.col("first.doc_id"))) & (F.col("own") == F.col("first.own"))
    judged = cut(rows.join(named, "fp").where(~stays | (F.col("times") > 1)).select("doc_id", "own", stays.alias("stays")))
    found = {r["stays"]: r["n"] for r in judged.groupBy("stays").agg(F.count("*").alias("n")).collect()}  # two rows
    few = F.broadcast if sum(found.values()) <= FEW else (lambda df: df)
    ids = judged.select(F.col("doc_id").alias("_doc_id"), F.col("own").alias("_own"), "stays")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_doc_id")) & (_own(F.col("text").cast("string")) == F.col("_own"))
    out = docs.join(few(ids), same, "left_anti") if found else docs
    if found.get(True):  # rows that are repeated as they are
        again = docs.join(few(ids.where("stays")), same, "left_semi")
        out = out.unionByName(again.dropDuplicates(["doc_id", "text"]))
    return out
