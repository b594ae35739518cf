"""Storage layout for the large joins: bucketed, sorted tables.

At scale the order-detail join ``lineitem ⋈ orders`` is the largest shuffle.
Writing both tables once bucketed by the order key (same bucket count) lets
every later join and per-order aggregate read matching buckets side by side:
the sort-merge join then has no Exchange on either input.  The write is a
one-off ETL step into the session catalog (``saveAsTable`` under the
warehouse / a shared path); queries read the tables with ``spark.table``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daypulse.sources.tables import read_table

# Bucket keys of the detail tables (fixed).
BUCKET_KEYS = {"lineitem": "l_orderkey", "orders": "o_orderkey"}


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int,
                   path: str | None = None) -> None:
    """Write ``df`` as a catalog table bucketed and sorted by ``key``."""
    w = df.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def bucket_detail_tables(spark: SparkSession, base: str, buckets: int, prefix: str = "",
                         path: str | None = None) -> dict[str, str]:
    """Write lineitem and orders bucketed on the order key; returns name -> table."""
    names = {}
    for name, key in BUCKET_KEYS.items():
        table = f"{prefix}{name}"
        target = f"{path}/{table}" if path else None
        write_bucketed(read_table(spark, name, base), table, key, buckets, target)
        names[name] = table
    return names


def catalog_reader(spark: SparkSession, tables: dict[str, str], base: str) -> Callable[[str], DataFrame]:
    """Reader that serves the given names from the catalog and the rest from ``base``."""

    def read(name: str) -> DataFrame:
        if name in tables:
            return spark.table(tables[name])
        return read_table(spark, name, base)

    return read
