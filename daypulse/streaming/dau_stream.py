"""Streaming jobs: log router and first-launch (DAU) stream.

Two queries, as in the reference's collector -> bus -> DAU job chain:

``run_router_stream``  raw lines -> per micro-batch: lines split by route
                       (start / event / reject), a raw archive partitioned by
                       ingest day, and the committed offsets per partition.
Checkpoints default to a folder below the cluster's shared
``spark.checkpoint.dir`` (never a machine-local temp folder).

``run_dau_stream``     start lines -> parse -> stateful first-launch dedup per
                       (device, event day) -> per micro-batch: upsert of the
                       fact rows, refresh of the day-level gold tables.

Exactly-once: every sink write of micro-batch N overwrites only the folders
of batch N (``batch_id=N``, under ``dt=D`` for the facts; a run with a new
checkpoint has ids of its own, see ``epochs``), so a batch re-run
after a failure (lost executor, driver restart from the checkpoint) rewrites
the same folders; state, offsets and the
batch id commit together in the query checkpoint (unlike the reference, which
inserted into its device set before writing the sink and could lose records).

Dedup flavours
* ``first_arrival`` (T3): the smallest (micro-batch time, offset) per (device,
  day), emitted once, in the micro-batch of the first arrival; a hot device is
  one row a task before the state.
* ``first_event`` (T4): ``groupBy(mid, day).agg(min(struct(ts, offset, ...)))``
  in update mode: a device is re-emitted when an *earlier* launch of the same
  day arrives, so the hour is that of the earliest event (equal to the batch
  ``first_seen``).  The sink upserts on (dt, mid).

Late data (T5): no row is dropped for its time.  Before the state, each row is
classed by its event day against the day on which the broker received it:
``in_time`` rows go through the state; ``late`` rows (more than ``LATE_DAYS``
behind) skip it and are upserted into their own day, where the read view keeps
the earliest launch per (dt, mid); ``future`` rows (more than a day ahead, a
wrong clock) go to a quarantine table and never move the watermark.  Rows
without a broker time count as in time.  The watermark only bounds the state:
at ``STATE_DELAY`` it leaves partitions that are read unevenly five days of
slack beyond ``LATE_DAYS``; a row behind that shows in
``numRowsDroppedByWatermark``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypulse.functions.timeparts import day_of_ms, hour_of_ms, minute_of_ms
from daypulse.operators import metrics
from daypulse.operators.upsert import latest_by_key
from daypulse.session import checkpoint_subdir
from daypulse.sources import applog
from daypulse.sources.paths import partition_values, read_days, remove
from daypulse.streaming.epochs import Run, drop_uncommitted, epoch_of, start_run
from daypulse.streaming.gold import fold_changes, hour_changes, mark_recount, recounted, write_changes
from daypulse.streaming.sources import read_progress  # noqa: F401  (read back what record_offsets wrote)

# Fixed streaming settings.
BATCH_INTERVAL = "5 seconds"          # T1: micro-batch interval
LATE_DAYS = 2                          # T5: days behind the broker's day that go through the state
STATE_DELAY = "7 days"                 # T5: watermark delay on the event day (bounds the state)
MERGE_EVERY = 100                      # S8: batches after which the days in work are merged
GOLD_DAYS = 31                         # T7: days refreshed by one job
FACT_KEY = ["dt", "mid"]
FACT_TABLE_SCHEMA = T.StructType(applog.FACT_SCHEMA.fields + [
    T.StructField("ingest_dt", T.StringType()), T.StructField("batch_id", T.LongType())])
HOURLY_SCHEMA = T.StructType([
    T.StructField("dt", T.StringType()), T.StructField("hr", T.StringType()),
    T.StructField("launches", T.LongType()), T.StructField("late", T.BooleanType()),
    T.StructField("batch_id", T.LongType())])
# Classes of arrival, and the kinds of row a micro-batch hands to its writer.
IN_TIME, LATE, FUTURE = "in_time", "late", "future"
OFFSET = "offset"


# --- stream transformations ----------------------------------------------------

def with_event_day(start: DataFrame, ms_col: str = "ts") -> DataFrame:
    """Event time and its day as TIMESTAMP columns (watermarks need TIMESTAMP, not NTZ)."""
    et = F.timestamp_millis(ms_col)
    return start.withColumn("event_time", et).withColumn("day", F.date_trunc("day", et))


def arrival_class(ms_col: str = "ts", broker_col: str = "timestamp"):
    """T5: ``in_time``, ``late`` or ``future`` by event day against the broker's day."""
    ahead = F.date_diff(F.to_date(F.timestamp_millis(ms_col)), F.to_date(broker_col))
    return (F.when(ahead > 1, F.lit(FUTURE)).when(ahead < -LATE_DAYS, F.lit(LATE))
            .otherwise(F.lit(IN_TIME)))


def late_policy(start: DataFrame, delay: str = STATE_DELAY) -> DataFrame:
    """T5: watermark on the event day; the state of days behind it is released."""
    return with_event_day(start).withWatermark("day", delay)


def dedup_first_arrival(start: DataFrame, delay: str = STATE_DELAY,
                        tiebreak: str = "offset") -> DataFrame:
    """First arrival per (mid, event day) -> fact columns; update mode.

    Arrival order is (micro-batch time, ``tiebreak``).  The smallest arrival is
    an aggregate with a map-side partial step, so a device with a third of a
    micro-batch reaches the state as one row a task; a device is emitted only
    in the micro-batch of its first arrival, whose time the state keeps.
    """
    carry = [c for c in (tiebreak, "ts", "uid", "ar", "ch", "vc") if c in start.columns]
    rows = late_policy(start, delay).withColumn("_now", F.current_timestamp())
    first = F.min(F.struct("_now", *carry)).alias("_f")
    new = rows.groupBy("mid", "day").agg(first).filter(F.col("_f._now") == F.current_timestamp())
    return _fact_columns(new.select("mid", *[F.col(f"_f.{c}").alias(c) for c in carry]))


def dedup_first_event(start: DataFrame, delay: str = STATE_DELAY,
                      tiebreak: str = "offset", track: bool = False) -> DataFrame:
    """T4: earliest event per (mid, event day) -> fact columns; update mode.

    With ``track`` the state also keeps, for each hour of the day, the
    micro-batch time at which the device was first seen in it (a time that a
    replay repeats), and ``prev_hr`` is the device's first hour before this
    micro-batch: NULL for a device that is new on that day.
    """
    carry = [c for c in ("uid", "ar", "ch", "vc") if c in start.columns]
    packed = F.struct(F.col("ts"), F.col(tiebreak), *[F.col(c) for c in carry])
    rows, slots, keep = late_policy(start, delay), [], ()
    if track:
        rows = rows.withColumn("_now", F.current_timestamp()).withColumn("_hr", F.hour("event_time"))
        slots = [F.min(F.when(F.col("_hr") == h, F.col("_now"))).alias(f"_h{h}") for h in range(24)]
    agg = rows.groupBy("mid", "day").agg(F.min(packed).alias("_f"), *slots)
    firsts = agg.select("mid", *[F.col(f"_f.{c}").alias(c) for c in ["ts", tiebreak] + carry],
                        *[f"_h{h}" for h in range(24) if track])
    if track:
        before = F.coalesce(*[F.when(F.col(f"_h{h}") != F.current_timestamp(), F.lit(f"{h:02d}"))
                              for h in range(24)])
        firsts, keep = firsts.withColumn("prev_hr", before), ("prev_hr",)
    return _fact_columns(firsts, keep)


def _fact_columns(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    out = (df.withColumn("dt", day_of_ms("ts")).withColumn("hr", hour_of_ms("ts"))
           .withColumn("mi", minute_of_ms("ts")))
    for c in ("uid", "ar", "ch", "vc"):
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    return out.select(*applog.FACT_COLUMNS, *keep)


def observed(df: DataFrame, name: str) -> DataFrame:
    """Row count of each micro-batch, reported in ``lastProgress['observedMetrics']``."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))


# --- sinks -------------------------------------------------------------------------

def _batch_dir(base: str, batch_id: int) -> str:
    return os.path.join(base, f"batch_id={int(batch_id)}")


def write_routes(routed: DataFrame, lines_path: str, batch_id: int) -> None:
    """S4 sink: lines per route (the two topics plus rejects), ``route=R/batch_id=N``.

    Route-first, so a consumer of one route lists only that route's folders;
    dynamic overwrite replaces exactly this batch's folders (idempotent).
    """
    (routed.select("partition", "offset", "timestamp", "value", "route",
                   F.lit(int(batch_id)).cast("bigint").alias("batch_id"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("route", "batch_id").parquet(lines_path))


def raw_archive(batch: DataFrame, archive_path: str, batch_id: int) -> None:
    """S5 sink: raw lines unchanged as text, ``ingest_dt=D/batch_id=N`` (one tree per day)."""
    (batch.select("value", F.date_format("timestamp", "yyyy-MM-dd").alias("ingest_dt"),
                  F.lit(int(batch_id)).cast("bigint").alias("batch_id"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("ingest_dt", "batch_id").text(archive_path))


def record_offsets(batch: DataFrame, progress_path: str, batch_id: int,
                   topic: str, group: str, run: Run = Run()) -> None:
    """S3 sink: until-offset per partition of this batch (written after the data sinks).

    ``batch_id`` is the stored id (see :mod:`daypulse.streaming.epochs`).
    """
    (batch.groupBy("partition").agg((F.max("offset") + 1).alias("until_offset"))
     .select(F.lit(topic).alias("topic"), F.lit(group).alias("grp"), "partition",
             F.lit(run.epoch).cast("bigint").alias("epoch"), F.lit(run.run).alias("run"),
             F.lit(int(batch_id)).cast("bigint").alias("batch_id"), "until_offset")
     .write.mode("overwrite").parquet(_batch_dir(progress_path, batch_id)))


def record_route_counts(routed: DataFrame, stats_path: str, batch_id: int) -> None:
    """Lines per route of this batch (rejects counted), ``batch_id=N``."""
    (routed.groupBy("route").agg(F.count(F.lit(1)).alias("lines"))
     .withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
     .write.mode("overwrite").parquet(_batch_dir(stats_path, batch_id)))


class RouterBatchWriter:
    """foreachBatch body of the router stream (S3, S4, S5; route counts for Q4)."""

    def __init__(self, out_base: str, topic: str, group: str, run: Run = Run()):
        self.run = run
        self.lines = os.path.join(out_base, "lines")
        self.archive = os.path.join(out_base, "archive")
        self.progress = os.path.join(out_base, "progress")
        self.stats = os.path.join(out_base, "route_counts")
        self.topic, self.group = topic, group

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch_id = self.run.batch(batch_id)
        routed = applog.with_route(batch).select(*batch.columns, "_valid", "route").persist()
        try:
            write_routes(routed, self.lines, batch_id)
            # archive every valid line; invalid ones stay in the reject route
            raw_archive(routed.filter("_valid"), self.archive, batch_id)
            record_route_counts(routed, self.stats, batch_id)
            record_offsets(routed, self.progress, batch_id, self.topic, self.group, self.run)
        finally:
            routed.unpersist()


class DauBatchWriter:
    """foreachBatch body of the DAU stream.

    Rows carry a ``kind``: the state's output (``in_time``), ``late`` rows,
    ``future`` rows, and one ``offset`` row per input line when offsets are
    recorded.  Frames without ``kind`` are fact rows.
    """

    def __init__(self, table_path: str, gold_path: str | None = None,
                 quarantine_path: str | None = None, progress_path: str | None = None,
                 topic: str | None = None, group: str | None = None,
                 merge_every: int = MERGE_EVERY, run: Run = Run()):
        self.run = run
        self.table_path = table_path
        self.gold_path = gold_path
        self.quarantine_path = quarantine_path or table_path.rstrip("/") + "_quarantine"
        self.progress_path, self.topic, self.group = progress_path, topic, group
        self.merge_every = merge_every

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, number, batch_id = batch.sparkSession, int(batch_id), self.run.batch(batch_id)
        rows = (batch if "kind" in batch.columns
                else batch.withColumn("kind", F.lit(IN_TIME))).persist()
        try:
            # one row per kind and calendar day
            found = [(r.kind, r.dt) for r in rows.filter(F.col("kind") != OFFSET)
                     .select("kind", "dt").distinct().collect()]
            days = sorted({dt for kind, dt in found if kind != FUTURE})
            late = sorted({dt for kind, dt in found if kind == LATE})
            if days:
                self._write_facts(rows, batch_id)
            if any(kind == FUTURE for kind, _ in found):
                _write_days(rows.filter(F.col("kind") == FUTURE).select(*applog.FACT_COLUMNS),
                            self.quarantine_path, batch_id)
            merge = bool(self.merge_every) and (number + 1) % self.merge_every == 0
            if merge:
                # no other writer touches the table while this batch runs
                compact_fact_days(spark, self.table_path, days)
            if self.gold_path:
                self._refresh(rows, batch_id, days, late, merge)
            if self.progress_path:  # S3: after the sinks
                record_offsets(rows.filter(F.col("kind") == OFFSET), self.progress_path,
                               batch_id, self.topic, self.group, self.run)
        finally:
            rows.unpersist()

    def _refresh(self, rows: DataFrame, batch_id: int, days: list[str], late: list[str],
                 merge: bool) -> None:
        """Add this batch's changes to the stored hours; recount days whose state is not whole.

        A day is recounted from its facts, now and in every later batch, once
        it has rows that the state does not know: late ones, or those of an
        earlier run (a new checkpoint starts with an empty state).
        """
        spark = rows.sparkSession
        tracked = "prev_hr" in rows.columns
        mark_recount(spark, self.gold_path, late if tracked else days)
        again = recounted(spark, self.gold_path)
        whole = [d for d in days if d in again]
        for i in range(0, len(whole), GOLD_DAYS):
            refresh_gold(spark, self.table_path, self.gold_path, whole[i:i + GOLD_DAYS])
        changed = [d for d in days if d not in again]
        for i in range(0, len(changed), GOLD_DAYS):
            some = changed[i:i + GOLD_DAYS]
            in_time = rows.filter((F.col("kind") == IN_TIME) & F.col("dt").isin(some))
            write_changes(hour_changes(in_time), self.gold_path, batch_id)
            fold_changes(spark, self.gold_path, some, merge)

    def _write_facts(self, rows: DataFrame, batch_id: int) -> None:
        """S6 + S8: day-first layout ``dt=D/batch_id=N``.

        A replay rewrites exactly this batch's folders; the processing day is
        a column, not the key.  Late rows shrink to one per device and day first.
        """
        cols = list(applog.FACT_COLUMNS)
        late = _earliest(rows.filter(F.col("kind") == LATE).select(*cols), ["ts"])
        facts = rows.filter(F.col("kind") == IN_TIME).select(*cols).unionByName(late)
        _write_days(facts.withColumn("ingest_dt", F.date_format(F.current_date(), "yyyy-MM-dd")),
                    self.table_path, batch_id)


def _write_days(df: DataFrame, path: str, batch_id: int) -> None:
    (df.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dt", "batch_id").parquet(path))


def _earliest(df: DataFrame, order: list) -> DataFrame:
    """Per (dt, mid) the row with the smallest ``order``, with a map-side partial step."""
    rest = [c for c in df.columns if c not in FACT_KEY]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") if isinstance(c, str) else c.alias(f"_o{i}")
                        for i, c in enumerate(order)], *[F.col(c) for c in rest])
    first = df.groupBy(*FACT_KEY).agg(F.min(packed).alias("_f"))
    return first.select(*[F.col(c) if c in FACT_KEY else F.col(f"_f.{c}").alias(c)
                          for c in df.columns])


def read_facts(spark: SparkSession, table_path: str, days: list[str] | None = None) -> DataFrame:
    """Current fact rows: the earliest launch per (dt, mid) over all batch folders.

    Columns: the 9 fact columns plus ``ingest_dt`` (processing day of the
    batch that wrote the row).  With ``days`` only those days' folders are
    listed and read; a day that was never written has no rows.  Rows of equal
    time: the one of the later batch counts (the state corrected it).
    """
    # explicit schema: partition values keep their declared types (dt stays a string)
    df = read_days(spark, table_path, FACT_TABLE_SCHEMA, days)
    return _earliest(df, ["ts", -F.col("batch_id")]).drop("batch_id")


def compact_fact_days(spark: SparkSession, table_path: str, days: list[str]) -> None:
    """Merge each day's batch folders into one folder of current rows.

    The merged rows go into a *new* folder (a negative batch id, which no
    stream batch has and which none of the day's folders uses); only after
    their count is checked are the folders that were read removed.  The read
    view keeps one row per (dt, mid), so every intermediate state -- a partly
    written new folder, both present, some old ones removed -- reads the same,
    and a failed run is simply repeated.
    """
    for day in days:
        folder = os.path.join(table_path, f"dt={day}")
        ids = [int(v) for v in partition_values(spark, folder, "batch_id")]
        if len(ids) < 2:
            continue
        merged = min(0, *ids) - 1
        current = read_facts(spark, table_path, [day])
        target = os.path.join(folder, f"batch_id={merged}")
        current.drop("dt").write.mode("overwrite").parquet(target)
        written, expected = spark.read.parquet(target).count(), current.count()
        if written < expected:  # the day may shrink to fewer folders, never to fewer rows
            raise RuntimeError(f"merge of {folder}: {written} rows written, {expected} expected")
        for i in ids:
            remove(spark, os.path.join(folder, f"batch_id={i}"))


def finalize_days(spark: SparkSession, table_path: str, registry_path: str,
                  days: list[str]) -> None:
    """Daily job: register the new devices of past days, compact their facts.

    Each step is idempotent, so a failed run is simply re-run.  When late rows
    reach a day that was finalized, finalize that day again: the registry moves
    its devices from the later days that hold them.
    """
    from daypulse.operators.registry import update_device_registry

    for day in sorted(days):
        update_device_registry(spark, read_facts(spark, table_path, [day]), registry_path, day)
        compact_fact_days(spark, table_path, [day])


def _write_gold(frame: DataFrame, gold_path: str, name: str) -> None:
    # dynamic overwrite: only the partitions of the refreshed days are replaced
    (frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dt").parquet(os.path.join(gold_path, name)))


def refresh_gold(spark: SparkSession, table_path: str, gold_path: str, days: list[str]) -> None:
    """Recompute dau_total and dau_hour for ``days`` only; overwrite just those partitions."""
    facts = read_facts(spark, table_path, days)
    _write_gold(metrics.dau_total(facts), gold_path, "dau_total")
    _write_gold(metrics.dau_hour(facts), gold_path, "dau_hour")


def refresh_order_gold(purchases: DataFrame, gold_path: str, days: list[str]) -> None:
    """T7 for the amount card: order_amount_total and order_amount_hour of ``days``.

    ``purchases`` should be restricted to ``days`` already (a scan predicate).
    """
    _write_gold(metrics.order_amount_total(purchases, days), gold_path, "order_amount_total")
    _write_gold(metrics.order_amount_hour(purchases, days), gold_path, "order_amount_hour")


# --- query runners -------------------------------------------------------------------

def _trigger(writer, trigger):
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger or BATCH_INTERVAL)


def _checkpoint(spark: SparkSession, checkpoint: str | None, name: str | None) -> str:
    """The given checkpoint, else one named after the query: streams never share a default."""
    if checkpoint:
        return checkpoint
    if not name:
        raise ValueError("a stream needs a name or a checkpoint of its own")
    return checkpoint_subdir(spark, f"streams/{name}")


def _start(writer, checkpoint: str, trigger: str | None, name: str | None):
    w = writer.option("checkpointLocation", checkpoint)
    return _trigger(w.queryName(name) if name else w, trigger).start()


def run_router_stream(raw: DataFrame, out_base: str, checkpoint: str | None = None, *,
                      topic: str, group: str = "router_group",
                      trigger: str | None = None, name: str | None = None):
    """Route, archive and record offsets of a raw line stream.

    ``topic`` is the topic that ``raw`` was read from; its offsets are recorded under it.
    """
    spark = raw.sparkSession
    checkpoint = _checkpoint(spark, checkpoint, name)
    run = start_run(spark, checkpoint, [out_base])
    writer = RouterBatchWriter(out_base, topic, group, run)
    drop_uncommitted(spark, run, writer.progress, [writer.lines, writer.archive, writer.stats])
    return _start(raw.writeStream.foreachBatch(writer), checkpoint, trigger, name)


def _parsed_arrivals(start_lines: DataFrame) -> DataFrame:
    parsed = applog.parse_start_logs(start_lines, keep=("offset", "timestamp"))
    return parsed.withColumn("kind", arrival_class())


def run_dau_stream(start_lines: DataFrame, table_path: str, checkpoint: str | None = None,
                   mode: str = "first_event", delay: str = STATE_DELAY,
                   gold_path: str | None = None, trigger: str | None = None,
                   name: str | None = None, quarantine_path: str | None = None,
                   progress_path: str | None = None, topic: str = "app_start",
                   group: str = "dau_group", merge_every: int = MERGE_EVERY):
    """T1 + T2: parse start lines, dedup per (device, event day), upsert facts.

    ``start_lines`` has ``value`` (JSON text), ``partition``, ``offset`` and
    ``timestamp`` (the broker's).  ``mode`` is ``first_event`` (T4) or
    ``first_arrival`` (T3).  With ``progress_path`` the job records
    its own until-offsets after its sinks, under ``topic`` and ``group`` (S3).
    Wrong clocks go to ``quarantine_path`` (default: beside the table).  With a
    new checkpoint on a filled table the run takes a new epoch: it adds to what
    is stored, and batches whose offsets were not recorded are dropped first.
    """
    spark = start_lines.sparkSession
    checkpoint = _checkpoint(spark, checkpoint, name)
    run = start_run(spark, checkpoint, [table_path, *([progress_path] if progress_path else [])])
    if progress_path:
        drop_uncommitted(spark, run, progress_path, [table_path])
    if gold_path and run.new and run.epoch:  # the new state knows none of the stored days
        mark_recount(spark, gold_path, partition_values(spark, table_path, "dt"))
    arrivals = _parsed_arrivals(start_lines)
    in_time = observed(arrivals.filter(F.col("kind") == IN_TIME), "dedup_in")
    if mode == "first_event":
        deduped, out_mode = dedup_first_event(in_time, delay, track=bool(gold_path)), "update"
    elif mode == "first_arrival":
        deduped, out_mode = dedup_first_arrival(in_time, delay), "update"
        deduped = deduped.withColumn("prev_hr", F.lit(None).cast("string"))  # a row per device and day
    else:
        raise ValueError(f"unknown dedup mode {mode!r}")
    rows = observed(deduped, "dedup_out").withColumn("kind", F.lit(IN_TIME))
    aside = arrivals.filter(F.col("kind") != IN_TIME).observe(
        "aside", F.count_if(F.col("kind") == LATE).alias(LATE),
        F.count_if(F.col("kind") == FUTURE).alias(FUTURE))
    rows = rows.unionByName(_fact_columns(aside, keep=("kind",)), allowMissingColumns=True)
    if progress_path:
        offsets = start_lines.select(F.lit(OFFSET).alias("kind"), "partition", "offset")
        rows = rows.unionByName(offsets, allowMissingColumns=True)
    writer = DauBatchWriter(table_path, gold_path, quarantine_path, progress_path, topic, group,
                            merge_every, run)
    return _start(rows.writeStream.outputMode(out_mode).foreachBatch(writer),
                  checkpoint, trigger, name)


def launches_hourly_stream(start: DataFrame, delay: str = STATE_DELAY) -> DataFrame:
    """Launches per 1-hour event-time window, update mode -> (dt, hr, launches)."""
    ev = with_event_day(start).withWatermark("event_time", delay)
    agg = ev.groupBy(F.window("event_time", "1 hour").alias("w")).agg(
        F.count(F.lit(1)).alias("launches"))
    return agg.select(F.date_format("w.start", "yyyy-MM-dd").alias("dt"),
                      F.date_format("w.start", "HH").alias("hr"), "launches")


class HourlyBatchWriter:
    """foreachBatch body of the hourly rollup, ``dt=D/batch_id=N``.

    Rows of update mode replace older ones of their hour; ``late`` rows (which
    skip the state) are counted per hour and add to it.
    """

    def __init__(self, table_path: str, progress_path: str | None = None,
                 topic: str | None = None, group: str | None = None, run: Run = Run()):
        self.table_path, self.run = table_path, run
        self.progress_path, self.topic, self.group = progress_path, topic, group

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch_id = self.run.batch(batch_id)
        counted = batch.filter(F.col("late").isNotNull())
        rows = counted.groupBy("dt", "hr", "late").agg(F.sum("launches").alias("launches"))
        if not self.progress_path:
            _write_days(rows, self.table_path, batch_id)
            return
        batch.persist()
        try:
            _write_days(rows, self.table_path, batch_id)
            record_offsets(batch.filter(F.col("late").isNull()), self.progress_path, batch_id,
                           self.topic, self.group, self.run)
        finally:
            batch.unpersist()


def _hour_versions(df: DataFrame) -> DataFrame:
    """The newest version of each (dt, hr) in each run: a run counts only the rows it read itself."""
    versions = df.filter(~F.col("late")).withColumn("epoch", epoch_of("batch_id"))
    return latest_by_key(versions, ["dt", "hr", "epoch"], [])


def read_hourly(spark: SparkSession, table_path: str, days: list[str] | None = None) -> DataFrame:
    """Current hourly launches: each run's newest version of each (dt, hr) plus its late rows."""
    df = read_days(spark, table_path, HOURLY_SCHEMA, days)
    newest = _hour_versions(df).select("dt", "hr", "launches")
    late = df.filter("late").select("dt", "hr", "launches")
    return newest.unionByName(late).groupBy("dt", "hr").agg(F.sum("launches").alias("launches"))


def compact_hourly_days(spark: SparkSession, table_path: str, days: list[str]) -> None:
    """Remove the folders of final days whose rows are all superseded.

    At most 24 folders with current rows stay per day, and those with late rows.
    """
    for day in days:
        folder = os.path.join(table_path, f"dt={day}")
        ids = [int(v) for v in partition_values(spark, folder, "batch_id")]
        df = read_days(spark, table_path, HOURLY_SCHEMA, [day])
        late_ids = {r.batch_id for r in df.filter("late").select("batch_id").distinct().collect()}
        newest = _hour_versions(df)
        keep = {r.batch_id for r in newest.select("batch_id").distinct().collect()}
        for i in ids:
            if i not in keep and i not in late_ids:
                remove(spark, os.path.join(folder, f"batch_id={i}"))


def run_launches_hourly_stream(start_lines: DataFrame, table_path: str,
                               checkpoint: str | None = None, delay: str = STATE_DELAY,
                               trigger: str | None = None, name: str | None = None,
                               progress_path: str | None = None, topic: str = "app_start",
                               group: str = "hourly_group"):
    """Launches per event hour, update mode, upserted per micro-batch.

    Late rows add to their hour without the state; rows of a wrong clock are
    left out (the DAU stream keeps them in its quarantine).  With
    ``progress_path`` the job records its own until-offsets, from which a new
    checkpoint can go on.
    """
    spark = start_lines.sparkSession
    checkpoint = _checkpoint(spark, checkpoint, name)
    run = start_run(spark, checkpoint, [table_path, *([progress_path] if progress_path else [])])
    if progress_path:
        drop_uncommitted(spark, run, progress_path, [table_path])
    arrivals = _parsed_arrivals(start_lines)
    counted = launches_hourly_stream(arrivals.filter(F.col("kind") == IN_TIME), delay)
    late = _fact_columns(arrivals.filter(F.col("kind") == LATE)).select(
        "dt", "hr", F.lit(1).cast("bigint").alias("launches"), F.lit(True).alias("late"))
    rows = counted.withColumn("late", F.lit(False)).unionByName(late)
    if progress_path:
        rows = rows.unionByName(start_lines.select("partition", "offset"), allowMissingColumns=True)
    writer = HourlyBatchWriter(table_path, progress_path, topic, group, run)
    return _start(rows.writeStream.outputMode("update").foreachBatch(writer), checkpoint, trigger, name)
