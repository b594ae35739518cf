"""Continuity of stored offsets (S3, S5): missing ranges, repeated offsets, and their replay.

Offsets of a partition are consecutive, so what an archive lacks shows as gaps
between its offsets.  The offsets are put in order within blocks of ``BLOCK``
offsets, and a block's first one is held against the end of the block before,
so the millions of rows of one partition are sorted in pieces by different
tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1 << 16
MISSING, REPEATED = "missing", "repeated"


def offset_report(lines: DataFrame, block: int = BLOCK) -> DataFrame:
    """(partition, kind, first, last, n) of the ``lines`` (partition, offset).

    ``missing``: offsets first to last, n of them, are absent between the
    smallest and the largest one of the partition.  ``repeated``: the offset
    (first = last) occurs n times.  Rows without an offset are not looked at.
    """
    counts = (lines.filter(F.col("offset").isNotNull()).groupBy("partition", "offset")
              .agg(F.count(F.lit(1)).alias("times")))
    # at most ``block`` entries in a list
    blocks = (counts.groupBy("partition", F.floor(F.col("offset") / block).alias("block"))
              .agg(F.sort_array(F.collect_list(F.struct("offset", "times"))).alias("found")))
    by_block = Window.partitionBy("partition").orderBy("block")  # one row a block
    ends = F.element_at("found", -1)["offset"]
    rows = blocks.withColumn("before", F.lag(ends).over(by_block)).select("partition", "found", "before")
    # the offset ahead of each one: its neighbour in the list, for the first one the end of the block before
    ahead = lambda i: F.when(i == 0, F.col("before")).otherwise(F.get(F.col("found"), i - 1)["offset"])
    pairs = F.transform("found", lambda x, i: F.struct(ahead(i).alias("p"), x["offset"].alias("o"), x["times"].alias("times")))
    kinds = rows.select("partition", F.inline(pairs)).select("partition", F.inline(F.filter(F.array(
        F.struct(F.lit(MISSING).alias("kind"), (F.col("p") + 1).alias("first"), (F.col("o") - 1).alias("last"),
                 (F.col("o") - F.col("p") - 1).alias("n")),
        F.struct(F.lit(REPEATED).alias("kind"), F.col("o").alias("first"), F.col("o").alias("last"),
                 F.when(F.col("times") > 1, F.col("times")).alias("n"))), lambda r: r["n"] > 0)))
    return kinds


def replay(source: DataFrame, report: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``source`` (partition, offset, ...) in the missing ranges of ``report``, and no others.

    Ranges are cut at block borders, so the join is on (partition, block).
    """
    ranges = report.filter(F.col("kind") == MISSING).select(
        F.col("partition").alias("_p"), "first", "last",
        F.explode(F.sequence(F.floor(F.col("first") / block), F.floor(F.col("last") / block))).alias("_b"))
    inside = (F.col("partition") == F.col("_p")) & (F.floor(F.col("offset") / block) == F.col("_b"))
    return source.join(ranges, inside & F.col("offset").between(F.col("first"), F.col("last")), "left_semi")
