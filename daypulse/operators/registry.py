"""Device registry: first day per device, kept incrementally (A6 / A9 at scale).

"New devices of day D" needs every earlier day to know who was seen before.
Answering it from raw history costs a scan of all history per call, which a
dashboard refreshing every few seconds cannot afford.  The registry keeps the
answer as data: one row per device, partitioned by its first day.

Each day D the registry is extended with J2: D's distinct devices ``left_anti``
the registry's earlier partitions.  The result is written as partition
``first_dt=D`` with dynamic overwrite, and the earlier partitions alone are
read (``first_dt < D``), so re-running day D is idempotent.  Days need not come
in order: a late one takes its devices out of the later partitions that hold
them.  "New devices on D" is then a count of one partition.

The daily anti join shuffles both sides on ``mid`` (a day's devices are not
broadcastable at scale).  With billions of registered devices, store the
registry bucketed by ``mid`` as well (``sources.layout.write_bucketed``), so
the registry side is read in place and only the day's devices move.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypulse.session import ensure_checkpoint_dir
from daypulse.sources.paths import partition_values, remove

REGISTRY_SCHEMA = T.StructType([
    T.StructField("mid", T.StringType()),
    T.StructField("first_dt", T.StringType()),
])


def read_registry(spark: SparkSession, registry_path: str) -> DataFrame:
    """All registered devices (mid, first_dt); empty when nothing was written yet.

    Only a registry that is not there counts as empty; one that cannot be read raises.
    """
    if not partition_values(spark, registry_path, "first_dt"):
        return spark.createDataFrame([], REGISTRY_SCHEMA)
    return spark.read.schema(REGISTRY_SCHEMA).parquet(registry_path)


def update_device_registry(spark: SparkSession, day_devices: DataFrame, registry_path: str,
                           day: str, key: str = "mid") -> list[str]:
    """Register the devices of ``day`` not seen on any earlier day; the later partitions rewritten for it.

    ``day_devices`` holds that day's activity (any columns, with ``key``); it is
    reduced to distinct keys before the anti join, and the registry side is
    pruned to the partitions before ``day``.  Days may come in any order and
    again: a device that an earlier day now shows is taken out of its later
    partition, and only partitions that lose a device are rewritten.  The day's
    own partition is written first, so a run that stops in between leaves
    devices in both places and is finished by running it again.
    """
    known = read_registry(spark, registry_path)
    new = (day_devices.select(F.col(key).cast("string").alias("mid")).filter(F.col("mid").isNotNull()).distinct()
           .join(known.filter(F.col("first_dt") < day).select("mid"), "mid", "left_anti")
           .withColumn("first_dt", F.lit(day)))
    # the day's partition keeps what it had: a repeated day may bring only a part of its devices
    own = new.unionByName(known.filter(F.col("first_dt") == day)).distinct()
    _replace_partitions(own, registry_path)
    fresh = read_registry(spark, registry_path)
    here = fresh.filter(F.col("first_dt") == day).select("mid")
    later = fresh.filter(F.col("first_dt") > day)
    touched = sorted(r.first_dt for r in later.join(here, "mid", "left_semi").select("first_dt").distinct().collect())
    if touched:  # calendar days
        rest = later.filter(F.col("first_dt").isin(touched)).join(here, "mid", "left_anti")
        rest = _replace_partitions(rest, registry_path)
        left = {r.first_dt for r in rest.select("first_dt").distinct().collect()}
        for gone in sorted(set(touched) - left):  # an empty partition is not overwritten
            remove(spark, os.path.join(registry_path, f"first_dt={gone}"))
    return touched


def _replace_partitions(rows: DataFrame, registry_path: str) -> DataFrame:
    """Overwrite the partitions that ``rows`` have; they are computed before anything is replaced."""
    ensure_checkpoint_dir(rows.sparkSession)
    fixed = rows.select("mid", "first_dt").checkpoint()
    (fixed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("first_dt").parquet(registry_path))
    return fixed


def new_devices_on(spark: SparkSession, registry_path: str, dates: list[str]) -> DataFrame:
    """(dt, new_mid) for ``dates`` from the registry (partition-pruned count)."""
    reg = read_registry(spark, registry_path).filter(F.col("first_dt").isin(list(dates)))
    return reg.groupBy(F.col("first_dt").alias("dt")).agg(F.count(F.lit(1)).alias("new_mid"))
