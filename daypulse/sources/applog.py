"""App-log ingest: parse, route and project.

A log line is a JSON text.  A *start* log carries a non-empty ``start`` value
and ``common.{mid,uid,ar,ch,vc}`` plus ``ts`` (epoch ms); any other valid JSON
line is an *event* log.  Lines that are not JSON, or start logs without a
``common.mid`` or a usable ``ts``, go to the *reject* route instead of failing
the task.

A line is valid when ``try_parse_json`` accepts it, whatever the types of its
fields: it is parsed once into a VARIANT and each field is read from that once as
text, so a field of an unexpected type is NULL and never costs the line.
``ts`` may be a number, a decimal or a quoted number.  A line that repeats a
key within one object is not accepted by ``try_parse_json`` and is rejected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypulse.functions.scalar import is_present
from daypulse.functions.timeparts import with_time_parts

# Route names (fixed): start logs, other event logs, unparseable / incomplete lines.
ROUTE_START = "start"
ROUTE_EVENT = "event"
ROUTE_REJECT = "reject"

# Latest event time that can be rendered as a day: the end of year 9999, in epoch ms.
MAX_TS = 253402300799999

COMMON_FIELDS = ("mid", "uid", "ar", "ch", "vc")

# The flat fact row written per first launch (9 fields, in order).
FACT_COLUMNS = ("mid", "uid", "ar", "ch", "vc", "dt", "hr", "mi", "ts")
FACT_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in FACT_COLUMNS[:-1]]
    + [T.StructField("ts", T.LongType())]
)


# Fields read from a parsed line, each once: name of the column -> path.
_FIELDS = {"_start": "$.start", **{f"_{c}": f"$.common.{c}" for c in COMMON_FIELDS}}


def read_lines(raw: DataFrame, value: str = "value") -> DataFrame:
    """Add ``_valid`` and the fields of each line (``_start``, ``_mid`` ..., ``_ts``) as text and epoch ms.

    A line is parsed once and each field read once: the parsed line and the
    fields come out of one-row generators, below which no filter on them can
    be pushed, so no predicate repeats the parse.  Absent fields, JSON nulls
    and fields below a non-object are NULL.
    """
    lines = raw.select("*", F.explode(F.array(F.try_parse_json(value))).alias("_log"))
    fields = [F.try_variant_get("_log", path, "string").alias(name) for name, path in _FIELDS.items()]
    # a number, a decimal or a quoted number
    ms = F.try_variant_get("_log", "$.ts", "string").try_cast("decimal(38,6)").try_cast("bigint")
    read = F.inline(F.array(F.struct(F.col("_log").isNotNull().alias("_valid"), *fields, ms.alias("_ms"))))
    in_range = F.when(F.col("_ms").between(0, MAX_TS), F.col("_ms"))
    return lines.select(*raw.columns, read).withColumn("_ts", in_range).drop("_ms")


def with_route(raw: DataFrame, value: str = "value") -> DataFrame:
    """Add ``route`` (start / event / reject) and the columns of :func:`read_lines`."""
    is_start = is_present(F.col("_start"))
    complete = F.col("_mid").isNotNull() & F.col("_ts").isNotNull()
    route = (
        F.when(~F.col("_valid"), F.lit(ROUTE_REJECT))
        .when(is_start & complete, F.lit(ROUTE_START))
        .when(is_start, F.lit(ROUTE_REJECT))
        .otherwise(F.lit(ROUTE_EVENT))
    )
    return read_lines(raw, value).withColumn("route", route)


def route_logs(raw: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """One route per input line; ``keep`` passes through source columns."""
    return with_route(raw, value).select(*keep, "route")


def parse_start_logs(raw: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """F1 + F2: start-route lines flattened to mid, uid, ar, ch, vc, ts (epoch ms)."""
    starts = with_route(raw, value).filter(F.col("route") == ROUTE_START)
    return starts.select(*keep, *[F.col(f"_{c}").alias(c) for c in COMMON_FIELDS], F.col("_ts").alias("ts"))


def split_routes(raw: DataFrame, value: str = "value", keep: tuple[str, ...] = ()):
    """Three DataFrames (start, event, reject) over one routed input.

    Used inside ``foreachBatch`` where the routed batch is persisted once and
    written to three sinks.
    """
    routed = with_route(raw, value).select(*keep, value, "route")
    return tuple(routed.filter(F.col("route") == r).drop("route")
                 for r in (ROUTE_START, ROUTE_EVENT, ROUTE_REJECT))


def to_fact_rows(start_logs: DataFrame) -> DataFrame:
    """the 9-column fact row (mid, uid, ar, ch, vc, dt, hr, mi, ts)."""
    return with_time_parts(start_logs, "ts").select(*FACT_COLUMNS)
