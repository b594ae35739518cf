"""Stored hours of the DAU that follow the stream by change rows.

The dedup state tells, for each device it emits, the device's first hour
before the micro-batch (``prev_hr``).  A micro-batch therefore writes only
changes: +1 in the hour of a new device, -1 and +1 where an earlier launch
moved a device to another hour.  At most 24 rows a day and batch go to
``dau_changes/dt=D/batch_id=N``; a replay rewrites the same folder.  The
stored hours are the sum of a day's changes, so a batch costs what the batch
holds, whatever the day already has.

A day that holds rows which the state never saw (late ones, or those of a run
with another checkpoint) is marked under ``_recount`` and recomputed from its
facts instead.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypulse.sources.paths import create_text, partition_values, read_days, remove, visible_names

CHANGE_SCHEMA = T.StructType([
    T.StructField("dt", T.StringType()), T.StructField("hr", T.StringType()),
    T.StructField("delta", T.LongType()), T.StructField("batch_id", T.LongType())])


def hour_changes(firsts: DataFrame) -> DataFrame:
    """(dt, hr, delta) of emitted first launches with ``hr`` and ``prev_hr`` (NULL: a new device).

    A device whose first hour stays gives no rows; hours whose changes cancel out give none.
    """
    moved = firsts.filter(F.col("prev_hr").isNull() | (F.col("prev_hr") != F.col("hr")))
    change = F.array(F.struct(F.col("hr").alias("h"), F.lit(1).cast("bigint").alias("d")),
                     F.struct(F.col("prev_hr").alias("h"), F.lit(-1).cast("bigint").alias("d")))
    rows = moved.select("dt", F.inline(F.filter(change, lambda c: c["h"].isNotNull())))
    return (rows.groupBy("dt", F.col("h").alias("hr")).agg(F.sum("d").alias("delta"))
            .filter(F.col("delta") != 0))


def fold(changes: DataFrame) -> DataFrame:
    """(dt, hr, dau): the hours that a change log adds up to; hours without devices have no row."""
    return (changes.groupBy("dt", "hr").agg(F.sum("delta").alias("dau"))
            .filter(F.col("dau") != 0))


def totals(hours: DataFrame) -> DataFrame:
    """(dt, dau) from the hours: every device of a day is in one of them."""
    return hours.groupBy("dt").agg(F.sum("dau").alias("dau"))


def write_changes(changes: DataFrame, gold_path: str, batch_id: int) -> None:
    """One folder per day and batch, replaced as a whole on replay."""
    (changes.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
     .coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dt", "batch_id").parquet(os.path.join(gold_path, "dau_changes")))


def read_changes(spark: SparkSession, gold_path: str, days: list[str] | None = None) -> DataFrame:
    return read_days(spark, os.path.join(gold_path, "dau_changes"), CHANGE_SCHEMA, days)


def fold_changes(spark: SparkSession, gold_path: str, days: list[str], merge: bool = False) -> None:
    """Replace the stored hours and totals of ``days`` by the sum of their changes."""
    for day in days:
        _finish_pending(spark, _day_folder(gold_path, day))
    hours = fold(read_changes(spark, gold_path, days)).coalesce(1).persist()
    try:
        for frame, name in ((hours, "dau_hour"), (totals(hours), "dau_total")):
            (frame.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("dt").parquet(os.path.join(gold_path, name)))
    finally:
        hours.unpersist()
    if merge:
        for day in days:
            merge_changes(spark, gold_path, day)


def merge_changes(spark: SparkSession, gold_path: str, day: str) -> None:
    """Sum all folders of a day but the last into the first of them.

    The last folder stays: its batch may be replayed.  The sum replaces the
    first folder only after it is written beside it, under a hidden name, and
    the others go afterwards.  A crash in between is finished from the hidden
    folder, which names what it holds, before the changes are read again.
    """
    folder = _day_folder(gold_path, day)
    _finish_pending(spark, folder)
    ids = sorted(int(v) for v in partition_values(spark, folder, "batch_id"))[:-1]
    if len(ids) < 2:
        return
    rows = read_changes(spark, gold_path, [day]).filter(F.col("batch_id").isin(ids))
    hidden = f"_merge-{ids[0]}-{ids[-1]}"
    (rows.groupBy("hr").agg(F.sum("delta").alias("delta")).filter(F.col("delta") != 0)
     .coalesce(1).write.mode("overwrite").parquet(os.path.join(folder, hidden, "rows")))
    create_text(spark, os.path.join(folder, hidden, "whole"), "")
    _finish_merge(spark, folder, hidden)


def _day_folder(gold_path: str, day: str) -> str:
    return os.path.join(gold_path, "dau_changes", f"dt={day}")


def _finish_pending(spark: SparkSession, folder: str) -> None:
    for name in visible_names(spark, folder, hidden=True):
        if name.startswith("_merge-"):
            _finish_merge(spark, folder, name)


def _finish_merge(spark: SparkSession, folder: str, hidden: str) -> None:
    """Put the sum in the place of the folders it was made from; harmless when repeated."""
    path = os.path.join(folder, hidden)
    if "whole" in visible_names(spark, path):
        first, last = (int(x) for x in hidden.removeprefix("_merge-").split("-"))
        rows = spark.read.schema("hr string, delta long").parquet(os.path.join(path, "rows"))
        rows.coalesce(1).write.mode("overwrite").parquet(os.path.join(folder, f"batch_id={first}"))
        for value in partition_values(spark, folder, "batch_id"):
            if first < int(value) <= last:
                remove(spark, os.path.join(folder, f"batch_id={value}"))
        remove(spark, os.path.join(path, "whole"))  # first: a half removed sum must not be used
    remove(spark, path)


def _marks(gold_path: str) -> str:
    return os.path.join(gold_path, "_recount")


def mark_recount(spark: SparkSession, gold_path: str, days: list[str]) -> None:
    """From now on ``days`` are recomputed from their facts."""
    for day in days:
        create_text(spark, os.path.join(_marks(gold_path), f"dt={day}"), "")


def recounted(spark: SparkSession, gold_path: str) -> set[str]:
    return set(partition_values(spark, _marks(gold_path), "dt"))
