"""Near-duplicates by HyperMinHash: compressed one-permutation registers, bands, corrected estimates, exact checks.

A document is the set of its word shingles.  One hash deals a shingle to one of
:data:`REGISTERS` buckets; a bucket keeps of its smallest hash the number of
leading zeros (6 bits) and the 10 bits after the first one.  Empty buckets take
the register of the first filled bucket in an order of their own, so that
registers of two sets agree about as often as the sets do, however small.

Candidates agree in a whole band of :data:`BAND` registers (a pair at the
threshold of 0.8 is missed with probability 2e-9).  The share of equal
registers, less the collisions that two different minima of such sets cause,
estimates the similarity; pairs :data:`MARGIN` or more below the threshold
(2e-7 of those at it) go, and those whose sizes rule it out.  The others are
checked on the full sets.

Documents with equal sets are one node, and within a bucket no pairs are
formed: all are compared with one of them.  Buckets that still hold several
components afterwards are taken together by their largest component.  There the nodes outside it are compared with those of
other components in blocks of bounded size, estimates first, then full sets;
only links leave a block, one for a node and component at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse.llm.common import SPACE, Words, byte_texts, chunks, compact, cut, mix
from daypulse.llm.components import connected
from daypulse.llm.hashing import word_hashes

#: Buckets of a sketch (the first 8 bits of a hash), registers of a band, bits of a register's mantissa.
REGISTERS, BAND, MANTISSA = 256, 5, 10
#: How far below the threshold an estimate rules a pair out.
MARGIN = 0.15
#: Rows of a block on each side.
OUTSIDE, INSIDE = 64, 1024
#: Rows with registers or sets in a partition of a kept table.
WIDE = 2_000
#: Nodes whose ids are broadcast to fetch their texts; beyond it the join shuffles.
FETCH = 1_000_000

_BITS = REGISTERS.bit_length() - 1
_ORDER = np.random.default_rng(11).permuted(np.tile(np.arange(REGISTERS), (REGISTERS, 1)), axis=1)
_FOLD = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; with fewer words the whole sequence is one shingle."""
    words = Words([t.lower() for t in texts], ~SPACE)  # bytes: only A-Z change
    h = word_hashes(words)
    g = np.zeros(max(0, len(h) - size + 1), np.uint64)
    for j in range(size):
        g = g * _FOLD + h[j : j + len(g)]
    g = mix(g)
    out = []
    for a, z in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if z - a >= size:
            out.append(np.unique(g[a : z - size + 1]))
        elif z > a:
            own = xxhash.xxh64_intdigest(h[a:z].tobytes(), size)
            out.append(np.array([own], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One row of registers per set (rows of empty sets are zero)."""
    low = np.full(len(sets) * REGISTERS, ~np.uint64(0))
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    u = np.concatenate([*sets, np.zeros(0, np.uint64)])
    np.minimum.at(low, owner * REGISTERS + (u >> np.uint64(64 - _BITS)).astype(np.int64), u << np.uint64(_BITS))
    filled = low != ~np.uint64(0)
    zeros = np.minimum(64 - np.frexp(low.astype(np.float64))[1], 62).astype(np.uint64)
    rest = (low << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    out = ((zeros << np.uint64(MANTISSA)) | rest).astype(np.uint16)
    empty = np.flatnonzero(~filled & np.repeat([len(s) > 0 for s in sets], REGISTERS))
    for k in range(REGISTERS):
        if not len(empty):
            break
        source = empty // REGISTERS * REGISTERS + _ORDER[empty % REGISTERS, k]
        ok = filled[source]
        out[empty[ok]] = out[source[ok]]
        empty = empty[~ok]
    return out.reshape(-1, REGISTERS)


def collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Chance that different minima of sets of ``n`` and ``m`` shingles give equal registers.

    Within a count of leading zeros all mantissas are equally wide, so the
    chance is that width times the integral of the product of both densities.
    """
    a, b = n[:, None] / REGISTERS, m[:, None] / REGISTERS
    top = 0.5 ** np.arange(64 - _BITS)[None, :]
    level = np.exp(-(a + b) * top / 2) - np.exp(-(a + b) * top)
    return (a * b / (a + b) * level * top / 2).sum(axis=1) / 2**MANTISSA


def estimate(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarity of sets from their registers, corrected for collisions."""
    c = collisions(n, m)
    return ((x == y).mean(axis=1) - c) / (1 - c)


def _registers(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _sketch(size: int):
    def run(batches):
        for b in batches:
            texts = byte_texts(b.column(1))
            for lo, hi in chunks(texts):
                sets = shingle_sets(texts[lo:hi], size)
                regs = sketches(sets)
                cells = [
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([r.tobytes() for r in regs], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), *cells], ["doc_id", "n", "key", "regs"])

    return run


def _sets(size: int):
    """key and shingles of each text."""

    def run(batches):
        for b in batches:
            texts = byte_texts(b.column(0))
            for lo, hi in chunks(texts):
                sets = shingle_sets(texts[lo:hi], size)
                offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(sets).view(np.int64)))
                keys = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([keys, lists], ["key", "shingles"])

    return run


def _bands(batches):
    """bucket, node: a hash of each band of registers and its place."""
    count = REGISTERS // BAND
    salt = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for b in batches:
        regs = _registers(b.column(1))[:, : count * BAND].reshape(-1, count, BAND).astype(np.uint64)
        h = np.tile(salt, (len(regs), 1))
        for j in range(BAND):
            h = mix(h * _FOLD + regs[:, :, j])
        node = np.repeat(b.column(0).to_numpy(), count)
        yield pa.RecordBatch.from_arrays([pa.array(h.reshape(-1).view(np.int64)), pa.array(node)], ["bucket", "node"])


def _may_link(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of ``n`` and ``m`` shingles with these registers may reach ``percent``."""
    return (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (estimate(x, y, n, m) > percent / 100 - MARGIN)


def _likely(percent: int):
    def run(batches):
        for b in batches:
            a, c, n, m = (b.column(k).to_numpy() for k in (0, 1, 2, 3))
            keep = np.zeros(len(a), bool)
            for lo in range(0, len(a), 4096):
                s = slice(lo, lo + 4096)
                x, y = (_registers(b.column(k).slice(lo, 4096)) for k in (4, 5))
                keep[s] = _may_link(x, y, n[s], m[s], percent)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(c[keep])], ["a", "b"])

    return run


def _block(percent: int):
    """Links of a block's outsiders with its members of other components: one for an outsider and component at most."""

    def run(block: pa.Table) -> pa.Table:
        node, comp, n = (block.column(c).to_numpy() for c in ("node", "comp", "n"))
        regs = _registers(block.column("regs"))
        lists = block.column("shingles").combine_chunks()
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        flat, ends = lists.flatten().to_numpy(), np.concatenate(([0], np.cumsum(n)))
        outside = block.column("outside").to_numpy(zero_copy_only=False)
        inside = np.flatnonzero(~outside)
        pairs = [np.zeros((0, 2), np.int64)]
        for i in np.flatnonzero(outside).tolist():
            other = inside[comp[inside] != comp[i]]
            other = other[_may_link(regs[other], regs[i][None, :], n[other], np.full(len(other), n[i]), percent)]
            if not len(other):
                continue
            own = np.sort(flat[ends[i] : ends[i + 1]])
            theirs = np.concatenate([flat[ends[k] : ends[k + 1]] for k in other.tolist()])
            at = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
            common = np.add.reduceat((own[at] == theirs).astype(np.int64), np.cumsum(n[other]) - n[other])
            near = other[100 * common >= percent * (n[other] + n[i] - common)]
            near = near[np.unique(comp[near], return_index=True)[1]]
            pairs.append(np.column_stack((np.full(len(near), node[i]), node[near])))
        found = np.concatenate(pairs)
        return pa.table({"u": pa.array(found[:, 0]), "v": pa.array(found[:, 1])})

    return run


class _Search:
    """Fetches and tests what one call has to compare."""

    def __init__(self, texts: DataFrame, sets: DataFrame, size: int, percent: int):
        self.texts, self.sets, self.size, self.percent = texts, sets, size, percent
        self.links: DataFrame | None = None

    def verify(self, pairs: DataFrame) -> None:
        """Keep the links among ``pairs`` (a < b): likely ones by estimate, then by their full sets."""
        side = {c: self.sets.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("regs").alias(f"r{c}")) for c in "ab"}
        rows = compact(pairs.distinct()).join(side["b"], "b").join(side["a"], "a").select("a", "b", "na", "nb", "ra", "rb")
        new = compact(rows.mapInArrow(_likely(self.percent), "a long, b long"))
        ends = new.select(F.col("a").alias("node")).unionByName(new.select(F.col("b").alias("node")))
        full = self.full(ends.distinct())
        side = {c: full.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}")) for c in "ab"}
        common = F.size(F.array_intersect("sa", "sb"))
        union = F.size("sa") + F.size("sb") - common
        linked = new.join(side["b"], "b").join(side["a"], "a").where(common.cast("long") * 100 >= union.cast("long") * self.percent)
        self.add(linked.select(F.col("b").alias("u"), F.col("a").alias("v")))

    def add(self, links: DataFrame) -> None:
        self.links = compact(links if self.links is None else self.links.unionByName(links))

    def full(self, nodes: DataFrame) -> DataFrame:
        """node, shingles of ``nodes``, from the texts of their first documents."""
        asked = compact(nodes.join(self.sets, "node").select("node", "key", "least"))
        count = asked.count()
        few = (lambda df: F.broadcast(df)) if count <= FETCH else (lambda df: df)
        ids = few(asked.select(F.col("least").alias("_least")).distinct())
        rows = self.texts.join(ids, F.col("doc_id").eqNullSafe(F.col("_least")), "left_semi").select("text")
        sets = rows.mapInArrow(_sets(self.size), "key binary, shingles array<long>")
        full = sets.join(few(asked.select("node", "key")), "key").select("node", "shingles").dropDuplicates(["node"])
        return compact(full, WIDE)

    def components(self) -> DataFrame:
        return compact(connected(self.links, compact).select("node", F.col("root").alias("comp")))


def _pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))


def links(texts: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """(node, comp) of the linked nodes of ``sets`` (node, n, key, regs, least)."""
    search = _Search(texts, sets, size, percent)
    probes = cut(sets.select("node", "regs").mapInArrow(_bands, "bucket long, node long"))
    leads = probes.groupBy("bucket").agg(F.min("node").alias("lead"), F.count("*").alias("size")).where("size > 1")
    met = compact(probes.join(leads, "bucket"))
    search.verify(_pairs(met, "lead", "node"))
    crowd = met.where("size > 2").select("bucket", "node")  # a bucket of two is settled
    comps = search.components()
    named = compact(crowd.join(comps, "node", "left").select("bucket", "node", F.coalesce("comp", "node").alias("comp")))
    mixed = named.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high")
    # both sides come straight from an exchange, so Spark can split a hot bucket
    crowd = compact(named.join(compact(mixed.select("bucket")), "bucket"))
    if crowd.isEmpty():
        return comps
    # the rest, by the largest component of the bucket: two nodes that share a bucket share its main one
    heads = crowd.groupBy("bucket", "comp").agg(F.count("*").alias("c"))
    mains = compact(heads.groupBy("bucket").agg(F.max_by("comp", F.struct("c", "comp")).alias("main")))
    members = compact(crowd.join(mains, "bucket").select("main", "node", "comp").distinct())
    shape = members.groupBy("main").agg(
        F.ceil(F.count("*") / INSIDE).alias("ins"), F.ceil(F.count_if(F.col("comp") != F.col("main")) / OUTSIDE).alias("outs")
    )
    full = search.full(members.select("node").distinct())
    rows = members.join(compact(shape.where("outs > 0")), "main").join(full, "node").join(sets.select("node", "n", "regs"), "node")
    rows = compact(rows, WIDE)
    h = F.xxhash64("node")
    every = F.explode(F.sequence(F.lit(0), F.col("outs") - 1))
    columns = ("node", "comp", "n", "regs", "shingles")
    inside = rows.select("main", F.pmod(h, "ins").alias("i"), every.alias("j"), F.lit(False).alias("outside"), *columns)
    every = F.explode(F.sequence(F.lit(0), F.col("ins") - 1))
    outside = rows.where("comp <> main").select("main", every.alias("i"), F.pmod(h, "outs").alias("j"), F.lit(True).alias("outside"), *columns)
    search.add(inside.unionByName(outside).groupBy("main", "i", "j").applyInArrow(_block(percent), "u long, v long"))
    return search.components()


def near_duplicates(docs: DataFrame, shingle: int = 2, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored.  Texts
    are lower-cased (A-Z) and parted at ASCII white space; a set holds the
    distinct shingles of ``shingle`` words, or the whole sequence where there
    are fewer.  Rows link if their sets' intersection is at least ``percent``
    per cent of the union; component_id is the smallest doc_id reachable, kept
    whether it is the row's own.  Null texts and texts without words have no
    shingles and link with nothing.  Rows with a null doc_id join groups
    without naming them (a group of only such rows has a null component_id);
    their kept is null.  Repeated rows come back repeated; no rows give no rows.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = cut(own.mapInArrow(_sketch(shingle), "doc_id long, n long, key binary, regs binary"))
    sets = rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("regs").alias("regs"))
    sets = compact(sets.select(F.monotonically_increasing_id().alias("node"), "key", "least", "n", "regs"), WIDE)
    comps = links(own, sets, shingle, percent)
    named = comps.join(sets.select("node", "key", "least"), "node")
    best = named.groupBy("comp").agg(F.min("least").alias("best"))
    moved = compact(named.join(best, "comp").select("key", "best", F.lit(True).alias("met")))
    names = compact(
        sets.select("key", "least").join(moved, "key", "left").select("key", F.expr("if(met, best, least)").alias("component_id"))
    )
    linked = rows.where("n > 0").select("doc_id", "n", "key").join(names, "key").select("doc_id", "n", "component_id")
    alone = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept")
    )
