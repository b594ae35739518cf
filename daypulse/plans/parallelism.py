"""Spread CPU-heavy row work over the cluster when a scan is under-split.

A parquet file with a single row group is read by a single task, so every
per-row expression before the first exchange (JSON rendering / parsing, wide
projections, partial aggregation) runs on one core.  ``spread`` hash
repartitions such an input by a key -- deterministic, so a retried task
recomputes the same rows -- but only when the scan yields fewer partitions
than the session's parallelism.  On a cluster reading many files the scan
already has thousands of splits and ``spread`` returns the frame unchanged,
adding no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def parallelism(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism


_SPLITS: dict[tuple, int] = {}


def scan_partitions(df: DataFrame) -> int | None:
    """Partitions the (unshuffled) input yields; memoised per resolved plan.

    ``None`` when the session cannot say (e.g. Spark Connect has no RDDs).
    """
    try:
        key = (df.sparkSession.sparkContext.applicationId, df.semanticHash(),
               df.schema.simpleString())
        n = _SPLITS.get(key)
        if n is None:
            n = _SPLITS[key] = df.rdd.getNumPartitions()
        return n
    except Exception:
        return None


def spread(df: DataFrame, *keys: str, min_partitions: int | None = None) -> DataFrame:
    try:
        target = min_partitions or parallelism(df)
    except Exception:
        return df
    n = scan_partitions(df)
    if n is None or n >= target:
        return df
    return df.repartition(target, *keys) if keys else df.repartition(target)
