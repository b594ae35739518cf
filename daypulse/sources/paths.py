"""Partition folders of stored tables: list, test and remove them on any Hadoop file system."""

from __future__ import annotations

import os

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the folders ``column=value`` directly below ``path`` (none when it is absent)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def visible_names(spark: SparkSession, path: str, hidden: bool = False) -> list[str]:
    """Names directly below ``path`` (none when it is absent), without those Spark's readers skip unless ``hidden``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(p))
    return names if hidden else [n for n in names if not n.startswith(("_", "."))]


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write ``text`` to a new file; False, and nothing written, when there is one."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return False
    try:
        out = fs.create(p, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in str(error.java_exception):  # another writer was faster
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_days(spark: SparkSession, table_path: str, schema: T.StructType,
              days: list[str] | None = None) -> DataFrame:
    """A parquet table partitioned by ``dt`` first; with ``days`` only their folders are listed.

    Days that were never written give no rows.
    """
    reader = spark.read.schema(schema).option("basePath", table_path)
    if days is None:
        return reader.parquet(table_path)
    folders = [os.path.join(table_path, f"dt={d}") for d in sorted(set(days))]
    folders = [f for f in folders if exists(spark, f)]
    if not folders:
        return spark.createDataFrame([], schema)
    return reader.parquet(*folders).filter(F.col("dt").isin(sorted(set(days))))
