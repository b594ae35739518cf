"""Table sources.

``read_table`` is the one entry point for batch inputs.  Parquet is the tested
format; JDBC (the reference declares ClickHouse / MySQL sources) goes through
Spark's built-in ``jdbc`` reader with partitioned reads, and needs the driver
jar on the cluster's classpath.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Tables of the supplied test data (fixed names).
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(base: str, name: str) -> str:
    return os.path.join(base, f"{name}.parquet")


# Schemas per (application, path, options): parquet footers are read once per
# session, while every read lists the files anew, so appended rows are seen.
# ``forget_tables`` is for tables whose columns changed.
_SCHEMAS: dict[tuple, StructType] = {}


def _session_key(spark: SparkSession):
    try:
        return (spark.sparkContext.applicationId, id(spark))
    except Exception:  # sessions without a local SparkContext (Spark Connect)
        return ("session", id(spark))


def forget_tables() -> None:
    """Drop remembered schemas (call after a table's columns changed)."""
    _SCHEMAS.clear()


def read_table(
    spark: SparkSession,
    name: str,
    base: str | None = None,
    fmt: str = "parquet",
    options: dict | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Read one table.

    * ``fmt='parquet'`` (default): ``base/name.parquet``; filters and column
      selections applied later reach the scan (PushedFilters / ReadSchema).
    * ``fmt='jdbc'``: ``options`` carry url, user, password and, for parallel
      reads at scale, ``partitionColumn/lowerBound/upperBound/numPartitions``.
    * any other Spark format (orc, json, csv, ...): ``options`` passed through.
    """
    options = dict(options or {})
    if fmt == "jdbc":
        options.setdefault("dbtable", name)
        reader = spark.read.format("jdbc").options(**options)
        df = reader.load()
    elif fmt == "parquet":
        if base is None:
            raise ValueError("parquet tables need a base folder")
        key = (_session_key(spark), table_path(base, name), tuple(sorted(options.items())))
        reader = spark.read.options(**options)
        if key in _SCHEMAS:
            reader = reader.schema(_SCHEMAS[key])
        df = reader.parquet(table_path(base, name))
        _SCHEMAS[key] = df.schema
    else:
        path = options.pop("path", None) or table_path(base or ".", name).replace(".parquet", f".{fmt}")
        df = spark.read.format(fmt).options(**options).load(path)
    if columns:
        df = df.select(*columns)
    return df


def jdbc_options(url: str, table: str, partition_column: str | None = None,
                 lower: int | None = None, upper: int | None = None,
                 partitions: int | None = None, **extra) -> dict:
    """Options for a parallel JDBC read (one range query per partition)."""
    opts = {"url": url, "dbtable": table, **extra}
    if partition_column:
        if lower is None or upper is None or partitions is None:
            raise ValueError("partitioned JDBC reads need lower, upper and partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower),
                    upperBound=str(upper), numPartitions=str(partitions))
    return opts


def day_partition(df: DataFrame, dt: str | None, col: str = "dt") -> DataFrame:
    """Restrict to one day partition (pruned when ``col`` is a partition column)."""
    return df if dt is None else df.filter(F.col(col) == F.lit(dt))
