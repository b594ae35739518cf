"""Mapping of the supplied TPC-H-like tables onto the app's inputs.

The reference reads JSON app logs from a message bus and order facts from a
database.  The test tables stand in for them:

* start log      <- ``events`` with ``event_type = 'view'``
* mid, uid       <- ``cast(user_id as string)``
* ar             <- ``customer.c_nationkey`` of ``c_custkey = user_id`` (as string)
* ch, vc         <- ``event_type``, ``props.k``
* ts (epoch ms)  <- ``events.ts`` (session zone UTC)
* new user       <- ``event_type = 'signup'``
* timed order    <- ``event_type = 'purchase'``, amount ``value`` as DECIMAL(18,2)
* day order      <- ``orders.o_totalprice`` on ``o_orderdate``
* offsets        <- partition ``event_id % 4``, batch ``event_id div 1000``,
                    until offset ``event_id + 1``
* raw log lines  <- every event rendered as JSON text; ``view`` rows carry a
                    ``start`` object, ``error`` rows are cut short (malformed
                    text, exercising the reject route), the rest are event logs;
                    some lines have a quoted or decimal ``ts`` or a ``common``
                    that is no object.

Everything here is a lazy DataFrame over the tables, so work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daypulse.functions.timeparts import day_of_ms, epoch_ms, hour_of_ms, in_days
from daypulse.plans.parallelism import spread
from daypulse.sources.tables import read_table

# Fixed surrogate choices.
START_EVENT = "view"
SIGNUP_EVENT = "signup"
PURCHASE_EVENT = "purchase"
MALFORMED_EVENT = "error"
OFFSET_PARTITIONS = 4
BATCH_SIZE = 1000
START_TOPIC = "app_start"
CONSUMER_GROUP = "dau_group"
MONEY = "decimal(18,2)"


def events(spark: SparkSession, base: str, dates=None) -> DataFrame:
    """The events table; ``dates`` keeps those days via a pushable ``ts`` range."""
    ev = read_table(spark, "events", base)
    return ev if dates is None else ev.filter(in_days("ts", dates))


def start_logs(spark: SparkSession, base: str, dates=None) -> DataFrame:
    """Start logs without the area column: event_id, mid, uid, ch, vc, ts (ms)."""
    ev = events(spark, base, dates).filter(F.col("event_type") == START_EVENT)
    mid = F.col("user_id").cast("string")
    return ev.select(
        "event_id",
        mid.alias("mid"),
        mid.alias("uid"),
        F.col("event_type").alias("ch"),
        F.get_json_object("props", "$.k").alias("vc"),
        epoch_ms("ts").alias("ts"),
    )


def signups(spark: SparkSession, base: str, dates=None) -> DataFrame:
    """New-user events: event_id, uid, ts (ms)."""
    ev = events(spark, base, dates).filter(F.col("event_type") == SIGNUP_EVENT)
    return ev.select("event_id", F.col("user_id").cast("string").alias("uid"),
                     epoch_ms("ts").alias("ts"))


def purchases(spark: SparkSession, base: str, dates=None) -> DataFrame:
    """Orders with a time of day: event_id, uid, amount DECIMAL(18,2), ts (ms)."""
    ev = events(spark, base, dates).filter(F.col("event_type") == PURCHASE_EVENT)
    return ev.select(
        "event_id",
        F.col("user_id").cast("string").alias("uid"),
        F.col("value").cast(MONEY).alias("amount"),
        epoch_ms("ts").alias("ts"),
    )


def activity(spark: SparkSession, base: str, dates=None, before: str | None = None) -> DataFrame:
    """Start logs and timed orders in one frame: mid, ts (ms), is_start, amount.

    ``before`` ('yyyy-MM-dd') keeps events earlier than that day, as a scan predicate.
    """
    ev = events(spark, base, dates)
    if before is not None:
        ev = ev.filter(F.col("ts") < F.to_timestamp_ntz(F.lit(before)))
    ev = ev.filter(F.col("event_type").isin(START_EVENT, PURCHASE_EVENT))
    is_start = F.col("event_type") == START_EVENT
    return ev.select(
        F.col("user_id").cast("string").alias("mid"),
        epoch_ms("ts").alias("ts"),
        is_start.alias("is_start"),
        F.when(~is_start, F.col("value").cast(MONEY)).alias("amount"),
    )


# JSON renderings of an event row (SQL expressions over the joined event row).
_COMMON = ("named_struct('mid', cast(user_id AS string), 'uid', cast(user_id AS string), "
           "'ar', ar, 'ch', event_type, 'vc', get_json_object(props, '$.k'))")
_TS_MS = "unix_millis(cast(ts AS timestamp))"


def _start_json(ts: str) -> str:
    return (f"to_json(named_struct('common', {_COMMON}, "
            f"'start', named_struct('entry', 'icon'), 'ts', {ts}))")


def _event_json(common: str) -> str:
    return (f"to_json(named_struct('common', {common}, "
            f"'page', named_struct('page_id', event_type), 'ts', {_TS_MS}))")


# Some clients send the time quoted or as a decimal, or a field of another type.
_START_JSON = (f"CASE event_id % 7 WHEN 3 THEN {_start_json(f'cast({_TS_MS} AS string)')} "
               f"WHEN 5 THEN {_start_json(f'cast({_TS_MS} AS decimal(18,1))')} "
               f"ELSE {_start_json(_TS_MS)} END")
_EVENT_JSON = (f"CASE event_id % 5 WHEN 2 THEN {_event_json('event_type')} "
               f"WHEN 4 THEN {_event_json('array(event_type)')} ELSE {_event_json(_COMMON)} END")
# malformed line: the event log with its closing brace cut off
_LINE = (f"CASE WHEN event_type = '{START_EVENT}' THEN {_START_JSON} "
         f"WHEN event_type = '{MALFORMED_EVENT}' THEN regexp_replace({_EVENT_JSON}, '}}$', '') "
         f"ELSE {_EVENT_JSON} END")


def raw_logs(spark: SparkSession, base: str, event_types: tuple[str, ...] | None = None) -> DataFrame:
    """Bus records derived from ``events``: partition, offset, batch_id, timestamp, value.

    Joins ``customer`` for the area code (left join: a user without a customer
    row gets no ``ar`` field).  One JSON line per event; see module docstring.
    The line is one SQL expression (a single projection to analyse and codegen).
    ``event_types`` keeps only those events (pushed into the scan).
    """
    ev = events(spark, base)
    if event_types is not None:
        ev = ev.filter(F.col("event_type").isin(list(event_types)))
    # JSON rendering is the heavy per-row work here: spread an under-split scan
    ev = spread(ev, "event_id")
    areas = read_table(spark, "customer", base).selectExpr(
        "c_custkey", "cast(c_nationkey AS string) AS ar")
    ev = ev.join(areas, ev["user_id"] == areas["c_custkey"], "left")
    return ev.selectExpr(
        f"cast(event_id % {OFFSET_PARTITIONS} AS int) AS partition",
        "event_id AS offset",
        f"cast(floor(event_id / {BATCH_SIZE}) AS bigint) AS batch_id",
        "cast(ts AS timestamp) AS timestamp",
        f"{_LINE} AS value",
    )


def start_topic_lines(spark: SparkSession, base: str) -> DataFrame:
    """The lines the router sends to the start topic: what the DAU job consumes."""
    return raw_logs(spark, base, event_types=(START_EVENT,))


def stream_progress(spark: SparkSession, base: str) -> DataFrame:
    """Per-batch committed offsets (topic, grp, partition, batch_id, until_offset)."""
    ev = events(spark, base).select("event_id")
    return (
        ev.groupBy(
            (F.col("event_id") % OFFSET_PARTITIONS).cast("int").alias("partition"),
            F.floor(F.col("event_id") / BATCH_SIZE).cast("bigint").alias("batch_id"),
        )
        .agg((F.max("event_id") + 1).alias("until_offset"))
        .select(F.lit(START_TOPIC).alias("topic"), F.lit(CONSUMER_GROUP).alias("grp"),
                "partition", "batch_id", "until_offset")
    )


def restarted_progress(spark: SparkSession, base: str) -> DataFrame:
    """An offset log over restarts: every 2500 events a run with a new checkpoint, whose batch ids start at 0 again.

    The last batch of a run is read again by the next one (its offsets repeat).
    """
    ev = events(spark, base).select("event_id")
    run, place = F.floor(F.col("event_id") / 2500), F.col("event_id") % 2500
    rows = ev.select((F.col("event_id") % OFFSET_PARTITIONS).cast("int").alias("partition"), "event_id", F.inline(F.when(
        place >= 2000, F.array(F.struct(run.alias("epoch"), F.lit(2).cast("bigint").alias("batch_id")),
                               F.struct((run + 1).alias("epoch"), F.lit(0).cast("bigint").alias("batch_id")))).otherwise(
        F.array(F.struct(run.alias("epoch"), F.floor(place / 1000).alias("batch_id"))))))
    return (rows.groupBy("partition", "epoch", "batch_id").agg((F.max("event_id") + 1).alias("until_offset"))
            .select(F.lit(START_TOPIC).alias("topic"), F.lit(CONSUMER_GROUP).alias("grp"),
                    "partition", "epoch", "batch_id", "until_offset"))


def archived_offsets(spark: SparkSession, base: str) -> DataFrame:
    """Archived (partition, offset) of the events with holes and repeats: ids 97k + 13 and 500-519 lost, 211k twice."""
    kept = events(spark, base).select("event_id").filter(
        (F.col("event_id") % 97 != 13) & ~F.col("event_id").between(500, 519))
    times = F.when(F.col("event_id") % 211 == 0, F.lit(2)).otherwise(F.lit(1))
    return kept.select((F.col("event_id") % OFFSET_PARTITIONS).cast("int").alias("partition"),
                       F.floor(F.col("event_id") / OFFSET_PARTITIONS).alias("offset"),
                       F.explode(F.sequence(F.lit(1), times))).drop("col")


def emitted_firsts(spark: SparkSession, base: str) -> DataFrame:
    """What the dedup state emits per micro-batch of 1000 events: mid, dt, batch_id, hr, prev_hr.

    A row for each device, day and batch; hr is the device's first hour up to
    and with the batch, prev_hr the one before it (NULL in its first batch).
    """
    logs = start_logs(spark, base).select("mid", day_of_ms("ts").alias("dt"), "ts",
                                          F.floor(F.col("event_id") / BATCH_SIZE).alias("batch_id"))
    per_batch = logs.groupBy("mid", "dt", "batch_id").agg(F.min("ts").alias("ts"))
    order = Window.partitionBy("mid", "dt").orderBy("batch_id")  # a row a batch
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return per_batch.select("mid", "dt", "batch_id", hour_of_ms(F.min("ts").over(so_far)).alias("hr"),
                            hour_of_ms(F.min("ts").over(before)).alias("prev_hr"))


def upsert_batches(spark: SparkSession, base: str) -> DataFrame:
    """Upsert input keyed by user_id: key, batch_id, event_id, event_type, value."""
    ev = events(spark, base)
    return ev.select(
        F.col("user_id").alias("key"),
        F.floor(F.col("event_id") / BATCH_SIZE).cast("bigint").alias("batch_id"),
        "event_id", "event_type", "value",
    )


def seen_and_candidates(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """J2 input: start logs with even event_id are 'already stored'; odd ones arrive."""
    sl = start_logs(spark, base)
    even = (F.col("event_id") % 2) == 0
    return sl.filter(even), sl.filter(~even)
