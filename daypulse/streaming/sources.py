"""Stream sources.

The production source is Kafka (``subscribe`` one topic, string values,
``startingOffsets`` = latest by default, or an explicit per-partition JSON to
resume).  The Kafka connector jar is not bundled with PySpark, so the source
is injectable: tests and replays read line files with the same column shape
(``value``, ``partition``, ``offset``, ``timestamp``).

Resuming normally needs nothing: the query's checkpoint holds the offsets
and is committed together with the state and the sink (``foreachBatch`` is
idempotent per batch id), so a restart after a lost executor or driver
re-runs only the uncommitted batch.  ``startingOffsets`` matters only for a
brand-new checkpoint (S2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypulse.sources.paths import visible_names

LINE_SCHEMA = T.StructType([
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("value", T.StringType()),
])

# The visible offset log: one row per partition and batch; ``batch_id`` is the stored id.
PROGRESS_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()), T.StructField("grp", T.StringType()),
    T.StructField("partition", T.IntegerType()), T.StructField("epoch", T.LongType()),
    T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType()),
    T.StructField("until_offset", T.LongType())])


def kafka_options(bootstrap: str, topic: str, group: str | None = None,
                  starting_offsets: str | None = None,
                  max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Options of the Kafka source for one topic (S1; S2 via ``starting_offsets``)."""
    opts = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting_offsets or "latest",
        "failOnDataLoss": "true",
    }
    if group:
        opts["kafka.group.id"] = group
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    return opts


def kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Kafka records as (partition, offset, timestamp, value STRING)."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select("partition", "offset", "timestamp",
                      F.col("value").cast("string").alias("value"))


def line_file_stream(spark: SparkSession, path: str, files_per_trigger: int | None = 1,
                     fmt: str = "parquet") -> DataFrame:
    """Replayable stand-in for the bus: files with the Kafka column shape.

    ``fmt='parquet'`` expects LINE_SCHEMA columns; ``fmt='text'`` reads bare
    lines (partition/offset NULL).
    """
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(files_per_trigger))
    if fmt == "text":
        df = reader.text(path)
        return df.select(F.lit(None).cast("int").alias("partition"),
                         F.lit(None).cast("long").alias("offset"),
                         F.current_timestamp().alias("timestamp"), "value")
    return reader.schema(LINE_SCHEMA).format(fmt).load(path)


def source_stream(spark: SparkSession, kind: str = "kafka", **kw) -> DataFrame:
    """Pick the source: ``kind='kafka'`` (options via :func:`kafka_options`) or ``'files'``."""
    if kind == "kafka":
        return kafka_stream(spark, kw["options"])
    if kind == "files":
        return line_file_stream(spark, kw["path"], kw.get("files_per_trigger", 1),
                                kw.get("fmt", "parquet"))
    raise ValueError(f"unknown source kind {kind!r}")


def read_progress(spark: SparkSession, progress_path: str) -> DataFrame:
    """The visible offset log: (topic, grp, partition, epoch, run, batch_id, until_offset)."""
    return spark.read.schema(PROGRESS_SCHEMA).parquet(progress_path)


def stored_offsets(spark: SparkSession, progress_path: str, topic: str,
                   group: str | None = None) -> DataFrame | None:
    """The newest until-offset of each partition of ``topic``; None when nothing was written yet.

    Only a log that does not exist counts as nothing: one that cannot be read raises.
    """
    from daypulse.operators.upsert import latest_offsets

    if not visible_names(spark, progress_path):
        return None
    prog = read_progress(spark, progress_path).filter(F.col("topic") == topic)
    if group is not None:
        prog = prog.filter(F.col("grp") == group)
    return latest_offsets(prog)


def resume_kafka_options(spark: SparkSession, progress_path: str, bootstrap: str, topic: str,
                         group: str | None = None, **kw) -> dict[str, str]:
    """Start from the stored offsets when there are any, else from ``latest``.

    Reads the visible offset log written by the streams, keeps the until-offset
    of the newest (epoch, batch) per partition and renders Kafka's
    ``startingOffsets`` JSON.  Needed only for a new checkpoint; an existing
    checkpoint already knows its offsets.
    """
    from daypulse.operators.upsert import starting_offsets_json

    stored = stored_offsets(spark, progress_path, topic, group)
    row = starting_offsets_json(stored).first() if stored is not None else None  # one row per topic
    return kafka_options(bootstrap, topic, group, starting_offsets=row.json if row else None, **kw)


def resume_lines(spark: SparkSession, lines: DataFrame, progress_path: str, topic: str,
                 group: str | None = None) -> DataFrame:
    """S2 for a replayable source: the lines from the stored offsets on.

    The offsets become a literal map (one entry per partition of the topic);
    a partition without a stored offset is read from its start.
    """
    stored = stored_offsets(spark, progress_path, topic, group)
    until = {r["partition"]: r["until_offset"] for r in stored.collect()} if stored is not None else {}
    if not until:
        return lines
    starts = F.create_map(*[F.lit(x) for pair in sorted(until.items()) for x in pair])
    return lines.filter(F.col("offset") >= F.coalesce(starts[F.col("partition")], F.lit(0)))
