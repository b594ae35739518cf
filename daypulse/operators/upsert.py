"""Idempotent upsert by key and consumer offsets.

No table format with MERGE is available, so an upsert is a *batch folder*:
the folders ``[dt=D/]batch_id=N`` of micro-batch N are overwritten as a whole
(a replay rewrites the same folders, which makes the write idempotent), and
the read view keeps, per key, the row of the highest (batch_id, tiebreak).

"Last per key" is an aggregate of ``max(struct(batch_id, tiebreak, ...))``
(partial + final; struct buffers plan as sort aggregates).  The map-side
partial step reduces a key updated in a third of all rows before the shuffle,
which a ``row_number`` window would not.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.sources.paths import partition_values, remove


def latest_by_key(df: DataFrame, key: list[str] | str, order: list[str],
                  batch_col: str = "batch_id") -> DataFrame:
    """S6 read view: per key, the row with the greatest (batch_col, *order)."""
    keys = [key] if isinstance(key, str) else list(key)
    ordering = [batch_col] + [c for c in order if c != batch_col]
    rest = [c for c in df.columns if c not in keys and c not in ordering]
    packed = F.struct(*[F.col(c) for c in ordering + rest])
    return (df.groupBy(*keys).agg(F.max(packed).alias("_last"))
            .select(*keys, *[F.col(f"_last.{c}").alias(c) for c in ordering + rest]))


def write_batch(df: DataFrame, table_path: str, batch_id: int,
                partition_by: list[str] | None = None) -> str:
    """S6 write: replace this batch's folders (idempotent on replay).

    Layout ``[<partition_by>=v/...]batch_id=N``: partition columns first, so a
    read restricted on them (e.g. a day) lists only its own batch folders.
    Dynamic overwrite replaces exactly the folders this batch writes.
    """
    cols = list(partition_by or []) + ["batch_id"]
    (df.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*cols).parquet(table_path))
    return table_path


def read_upsert_table(spark: SparkSession, table_path: str, key: list[str] | str,
                      order: list[str], dt: str | None = None) -> DataFrame:
    """Read all batch folders and keep the last row per key.

    With ``dt`` given (and ``dt`` a partition column inside the batch folders),
    partition pruning restricts the scan to that day.
    """
    df = spark.read.option("basePath", table_path).parquet(table_path)
    if dt is not None:
        df = df.filter(F.col("dt") == dt)
    return latest_by_key(df, key, order)


def compact(spark: SparkSession, table_path: str, key: list[str] | str, order: list[str],
            out_path: str, partition_by: list[str] | None = None) -> str:
    """Rewrite the current view as one batch folder elsewhere (periodic compaction)."""
    latest = read_upsert_table(spark, table_path, key, order)
    batch = latest.agg(F.max("batch_id")).first()[0]
    return write_batch(latest.drop("batch_id"), out_path, batch or 0, partition_by)


def compact_in_place(spark: SparkSession, folder: str, key: list[str] | str, order: list[str]) -> None:
    """Merge the ``batch_id=N`` folders of ``folder`` (a table, or one of its partitions) into one.

    The current rows go into a new folder with a negative batch id below all
    others, so rows of later batches still replace them; the folders that were
    read go only after its rows are counted.  While both are there the read
    view gives the same rows (the old ones, which are equal), so a run that
    stops anywhere is simply repeated.  No other writer may touch the folder.
    """
    ids = sorted(int(v) for v in partition_values(spark, folder, "batch_id"))
    if len(ids) < 2:
        return
    target = os.path.join(folder, f"batch_id={min(0, ids[0]) - 1}")
    current = read_upsert_table(spark, folder, key, order).drop("batch_id")
    current.write.mode("overwrite").parquet(target)
    written, expected = spark.read.parquet(target).count(), current.count()
    if written < expected:
        raise RuntimeError(f"merge of {folder}: {written} rows written, {expected} expected")
    for i in ids:
        remove(spark, os.path.join(folder, f"batch_id={i}"))


def latest_offsets(progress: DataFrame) -> DataFrame:
    """S3: per (topic, grp, partition) the until-offset of the newest batch.

    A log with an ``epoch`` column is ordered by (epoch, batch_id): batch ids
    start over with each new checkpoint, epochs do not.  Rows without an epoch
    were written before there were any and come first.
    -> (topic, grp, partition, [epoch,] batch_id, until_offset)
    """
    order = (["epoch"] if "epoch" in progress.columns else []) + ["batch_id"]
    newest = F.max(F.struct(*order, "until_offset")).alias("_last")  # NULL sorts first
    return (progress.groupBy("topic", "grp", "partition").agg(newest)
            .select("topic", "grp", "partition", *[f"_last.{c}" for c in order + ["until_offset"]]))


def starting_offsets_json(offsets: DataFrame) -> DataFrame:
    """Offsets as the Kafka source's ``startingOffsets`` JSON, one row per topic.

    ``{"topic": {"0": 42, "1": 17}}`` -- a bounded object (one entry per
    partition of the topic).
    """
    per_topic = offsets.groupBy("topic").agg(F.map_from_entries(F.array_sort(F.collect_list(
        F.struct(F.col("partition").cast("string"), F.col("until_offset"))))).alias("m"))
    return per_topic.select(F.to_json(F.create_map(F.col("topic"), F.col("m"))).alias("json"))
