"""Approximate nearest neighbours by inner product with an inverted multi-index.

The two halves of a vector are quantised apart, so a cell is a pair of
centroids.  For each query a heap walks the pairs from the nearest on, by the
sum of the two halves' distances, until the cells hold a set share of all
vectors; the entries of the cells are reranked by the exact inner product.

Equal vectors are one entry with its smallest ids, so a vector that fills a
third of the table costs one entry and one query.  Entries and queries meet in
blocks of bounded size.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daypulse.llm.common import cut

#: Entries and queries that meet in one block at most, about.
ENTRIES, QUERIES = 8192, 2048
#: Groups of first-half centroids that blocks are made of.
GROUPS = 8
#: Entries that a query reads at least; a share of a small table would be too few.
LEAST = 4096


def kmeans(points: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """At most ``k`` centroids of the points."""
    rng = np.random.default_rng(7)
    centres = points[rng.permutation(len(points))[:k]].copy()
    for _ in range(rounds):
        own = nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        n = np.bincount(own, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)


def walk(a: np.ndarray, b: np.ndarray, counts: np.ndarray, want: float) -> list[tuple[int, int]]:
    """Centroid pairs by falling a[i] + b[j] until their cells hold ``want`` entries."""
    ia, ib = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
    sa, sb = a[ia].tolist(), b[ib].tolist()
    ia, ib = ia.tolist(), ib.tolist()
    heap, out, have = [(-(sa[0] + sb[0]), 0, 0)], [], 0
    while heap and have < want:
        _, i, j = heapq.heappop(heap)
        n = counts[ia[i], ib[j]]
        if n:
            out.append((ia[i], ib[j]))
            have += n
        if j + 1 < len(sb):
            heapq.heappush(heap, (-(sa[i] + sb[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(sa):
            heapq.heappush(heap, (-(sa[i + 1] + sb[0]), i + 1, 0))
    return out


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def usable(vectors: DataFrame) -> DataFrame:
    """Distinct (vec_id, v) of the rows that take part; v is the vector in double precision.

    Left out: null ids, and vectors that are null, empty, zero, hold null or
    non-finite components, or are not of the commonest length (the shorter on a tie).
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where(
        "vec_id is not null and size(v) > 0 and forall(v, x -> x is not null and abs(x) < double('infinity'))"
        " and exists(v, x -> x <> 0)"
    )
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == F.lit(common["n"] if common else 0)).distinct()


def search(
    vectors: DataFrame, every: int = 20, k: int = 20, centroids: int = 64, share: float = 0.47, sample: int = 20_000
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row whose vec_id ``every`` divides.

    ``vectors`` needs ``vec_id`` and ``embedding``; other columns are ignored,
    and :func:`usable` says which rows take part.  Nearness is the largest
    inner product in double precision, ties to the smaller vec_id; a row is
    not its own candidate, and repeated rows count once.  The centroids are
    fitted on at most ``sample`` vectors; every vector is indexed.  ``share``
    is the part of the entries that a query reads.  No rows give no rows.
    """
    spark = vectors.sparkSession
    rows = cut(usable(vectors))
    first = Window.partitionBy("v").orderBy("vec_id")
    entries = cut(
        rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))  # k + 1 ids at most
        .select(F.monotonically_increasing_id().alias("entry"), "v", "ids")
    )
    fit = entries.orderBy(F.xxhash64("entry"), "entry").limit(sample).select("v").toArrow()
    out = "query_id long, rank int, vec_id long, score double"
    if not fit.num_rows:
        return spark.createDataFrame([], out)
    points = _matrix(fit.column("v"))
    half = max(1, points.shape[1] // 2)
    left, right = kmeans(points[:, :half], centroids), kmeans(points[:, half:], centroids)
    wide = len(right)

    def assign(batches):
        for b in batches:
            x = _matrix(b.column(1))
            cell = nearest(x[:, :half], left) * wide + nearest(x[:, half:], right)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32))], [*b.schema.names, "cell"])

    index = cut(entries.mapInArrow(assign, "entry long, v array<double>, ids array<long>, cell int"))
    per_cell = np.zeros((len(left), wide), np.int64)
    for r in index.groupBy("cell").count().collect():  # one row per cell at most
        per_cell[r["cell"] // wide, r["cell"] % wide] = r["count"]
    total = int(per_cell.sum())
    want = min(total, max(share * total, LEAST, 4 * (k + 1)))
    per_group = np.zeros(GROUPS, np.int64)
    np.add.at(per_group, np.arange(len(left)) % GROUPS, per_cell.sum(axis=1))
    pieces = [int(max(1, -(-n // ENTRIES))) for n in per_group]

    asked = cut(
        rows.where(F.col("vec_id") % every == 0).join(index.select("v", "entry"), "v").select(F.col("vec_id").alias("query_id"), "entry")
    )
    different = asked.select("entry").distinct()
    shelves = max(1, -(-different.count() // QUERIES))

    def visit(batches):
        for b in batches:
            x = _matrix(b.column(1))
            a, c = x[:, :half] @ left.T, x[:, half:] @ right.T
            cols = [[], [], [], []]
            for i, entry in enumerate(b.column(0).to_pylist()):
                cells = np.array(walk(a[i], c[i], per_cell, want), np.int32).reshape(-1, 2)
                group = cells[:, 0] % GROUPS
                for g in np.unique(group).tolist():
                    own = cells[group == g]
                    for p in range(pieces[g]):
                        for col, v in zip(cols, (entry, g, p, (own[:, 0] * wide + own[:, 1]).tolist())):
                            col.append(v)
            at = pa.array(np.searchsorted(b.column(0).to_numpy(), cols[0])) if cols[0] else pa.array([], pa.int64())
            types = (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32()))
            arrays = [pa.array(col, t) for col, t in zip(cols, types)]
            yield pa.RecordBatch.from_arrays([*arrays, b.column(1).take(at)], ["entry", "g", "p", "cells", "v"])

    piece = F.element_at(F.lit(pieces), (F.floor(F.col("cell") / wide) % GROUPS + 1).cast("int"))
    spread = F.explode(F.sequence(F.lit(0), F.lit(shelves - 1))) if shelves > 1 else F.lit(0)
    shelf_rows = index.select(
        (F.floor(F.col("cell") / wide) % GROUPS).cast("int").alias("g"), F.pmod(F.xxhash64("entry"), piece).cast("int").alias("p"),
        spread.alias("s"), "v", "ids", "cell",
    )
    # each batch of queries is sorted by entry, so that a visit finds its vector again
    visits = index.join(different, "entry").select("entry", "v").sortWithinPartitions("entry").mapInArrow(
        visit, "entry long, g int, p int, cells array<int>, v array<double>"
    ).withColumn("s", F.pmod(F.xxhash64("entry"), F.lit(shelves)).cast("int"))

    def rerank(entries: pa.Table, queries: pa.Table) -> pa.Table:
        cols = [[], [], []]
        if entries.num_rows and queries.num_rows:
            x, q = _matrix(entries.column("v")), _matrix(queries.column("v"))
            cell = entries.column("cell").to_numpy()
            ids = entries.column("ids").to_pylist()
            scores = q @ x.T
            seen = np.zeros(len(left) * wide, bool)
            for i, (entry, cells) in enumerate(zip(queries.column("entry").to_pylist(), queries.column("cells").to_pylist())):
                seen[:] = False
                seen[cells] = True
                at = np.flatnonzero(seen[cell])
                if len(at) > k + 1:
                    s = scores[i, at]
                    low = np.partition(s, len(s) - k - 1)[len(s) - k - 1]
                    at = at[s >= low - 1e-9 * (1 + abs(low))]  # and what rounding may have put below
                for j, exact in zip(at.tolist(), (x[at] * q[i]).sum(axis=1).tolist()):
                    for c, v in zip(cols, (entry, exact, ids[j])):
                        c.append(v)
        types = (pa.int64(), pa.float64(), pa.list_(pa.int64()))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["entry", "score", "ids"])

    keys = ("g", "p", "s")
    found = shelf_rows.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInArrow(rerank, "entry long, score double, ids array<long>")
    best = Window.partitionBy("entry").orderBy(F.desc("score"), "vec_id")
    top = (
        found.select("entry", "score", F.explode("ids").alias("vec_id"))
        .withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r")
    )
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asked.join(top, "entry").where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
