"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse.llm.common import cut


def connected(links: DataFrame, keep: Callable[[DataFrame], DataFrame] = cut) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v): root is the smallest node reachable.

    Each round hangs every larger neighbour on a node's smallest neighbour
    (large star), then every smaller neighbour and the node itself (small
    star).  The links end as stars after few rounds, whatever the diameter;
    no group is gathered, only minima are, and each round is cut from its
    lineage in the shared checkpoint folder by ``keep``.  An empty table gives
    no rows.
    """
    star = keep(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = _mark(star)
    while mark[0]:
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        )
        star = keep(small)
        last, mark = mark, _mark(star)
        if mark == last:
            break
    roots = star.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(star.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mark(df: DataFrame) -> tuple:
    r = df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first()
    return tuple(r)
