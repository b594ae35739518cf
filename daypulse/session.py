"""Spark session helpers.

The library never hard-codes cluster settings: on a cluster the session comes
from ``spark-submit`` and these helpers only fill in what is unset.  Tests and
``bench.py`` build a local session through :func:`local_session`.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every daypulse job relies on.  UTC keeps epoch-millisecond <-> day
# conversions independent of the machine's zone; AQE re-plans joins and
# shuffles from runtime statistics (coalescing tiny partitions, splitting
# skewed ones, turning small shuffled sides into broadcasts).
JOB_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Static settings: only take effect when the session is built (cluster
# submit config or ``local_session``), never set at runtime.
STATIC_DEFAULTS = {
    # Call-site capture for error messages costs several driver round trips per
    # Column function; plans here are built from many small expressions.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(
    app: str = "daypulse",
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    driver_memory: str = "8g",
) -> SparkSession:
    """Local-mode session for tests and benchmarks (UI off, no ports beyond Spark's own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
        # catalog tables of local runs (tests) go to scratch space, not the cwd
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="daypulse-warehouse-"))
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for k, v in {**JOB_DEFAULTS, **STATIC_DEFAULTS}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Settings the results depend on: day / hour strings and epoch milliseconds are
# defined in UTC, so the session zone is pinned whatever the cluster default.
REQUIRED = {"spark.sql.session.timeZone": "UTC"}


_CONFIGURED: set[int] = set()


def apply_job_defaults(spark: SparkSession) -> SparkSession:
    """Pin the required settings; set the other defaults only where unset.

    The defaults are applied once per session; the required settings are
    re-checked on every call (one read) in case the caller changed them.
    """
    for k, v in REQUIRED.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    if id(spark) in _CONFIGURED:
        return spark
    _CONFIGURED.add(id(spark))
    for k, v in JOB_DEFAULTS.items():
        try:
            if spark.conf.get(k, None) is None:
                spark.conf.set(k, v)
        except Exception:  # not modifiable in this session (static / managed)
            pass
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is used as is; if it
    is unset there, this raises.  Only a local-mode session (tests) gets a
    scratch folder under /tmp.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is unset: point it at shared storage "
                         "(stream checkpoints and lineage cuts must survive executor loss)")
    current = tempfile.mkdtemp(prefix="daypulse-ckpt-")  # local runs (tests) only
    spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def checkpoint_subdir(spark: SparkSession, name: str) -> str:
    """A named folder below the shared checkpoint dir (stream checkpoints, tables)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)


def scale_settings(input_bytes: int, total_cores: int,
                   shuffle_fraction: float = 0.1,
                   target_partition_bytes: int = 128 << 20,
                   max_split_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a cluster run (set at submit time).

    * scans: splits of at most ``max_split_bytes`` (``maxPartitionBytes``);
    * shuffles: the largest exchange is estimated as ``shuffle_fraction`` of
      the input (queries here shuffle a few projected columns, mostly after a
      partial aggregate), divided into ``target_partition_bytes`` pieces and
      at least 2 waves of cores, so that every task fits in executor
      memory whatever the number of cores.  AQE then coalesces small partitions to the advisory size
      and splits skewed ones; sort / aggregate spill covers the rest.

    Example: 100 TB on 1000 executors x 8 cores -> 81,920 initial shuffle
    partitions of about 128 MB.
    """
    est = -(-int(input_bytes * shuffle_fraction) // target_partition_bytes)
    shuffle = max(est, 2 * total_cores)
    return {
        "spark.sql.files.maxPartitionBytes": str(max_split_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
