"""Time helpers: epoch milliseconds <-> day / hour / minute strings.

All functions return Column expressions, so they stay inside whole-stage codegen.
Formatting follows the session time zone (pinned to UTC by daypulse sessions).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of the fact row: day, hour and minute strings, zero padded.
DAY_FORMAT = "yyyy-MM-dd"
HOUR_FORMAT = "HH"
MINUTE_FORMAT = "mm"
COMPACT_DAY_FORMAT = "yyyyMMdd"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms(ts: Column | str) -> Column:
    """Timestamp (or timestamp_ntz, read as session-zone wall clock) -> epoch ms (truncating)."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def ms_to_ts(ms: Column | str) -> Column:
    return F.timestamp_millis(_c(ms))


def day_of_ms(ms: Column | str) -> Column:
    """epoch ms -> 'yyyy-MM-dd'."""
    return F.date_format(ms_to_ts(ms), DAY_FORMAT)


def hour_of_ms(ms: Column | str) -> Column:
    return F.date_format(ms_to_ts(ms), HOUR_FORMAT)


def minute_of_ms(ms: Column | str) -> Column:
    return F.date_format(ms_to_ts(ms), MINUTE_FORMAT)


def with_time_parts(df, ms_col: str = "ts", prefix: str = ""):
    """add dt / hr / mi string columns derived from an epoch-ms column."""
    return (
        df.withColumn(f"{prefix}dt", day_of_ms(ms_col))
        .withColumn(f"{prefix}hr", hour_of_ms(ms_col))
        .withColumn(f"{prefix}mi", minute_of_ms(ms_col))
    )


def day_string(d: Column | str) -> Column:
    """DATE/TIMESTAMP -> 'yyyy-MM-dd'."""
    return F.date_format(_c(d), DAY_FORMAT)


def shift_day(dt: Column | str, days: int) -> Column:
    """'yyyy-MM-dd' shifted by ``days``; strict parse (ANSI raises on bad input, F7)."""
    return F.date_format(F.date_add(F.to_date(_c(dt), DAY_FORMAT), days), DAY_FORMAT)


def prev_day(dt: Column | str) -> Column:
    """the day before 'yyyy-MM-dd'."""
    return shift_day(dt, -1)


def compact_day(dt: Column | str) -> Column:
    """'yyyy-MM-dd' -> 'yyyyMMdd' (day suffix of a partition / table name)."""
    return F.regexp_replace(_c(dt), "-", "")


def today_string() -> Column:
    """F8: current date as 'yyyy-MM-dd' (callers may always pass a date instead)."""
    return F.date_format(F.current_date(), DAY_FORMAT)


def in_days(ts: Column | str, dates) -> Column:
    """``ts`` falls on one of ``dates`` ('yyyy-MM-dd'), as plain range predicates.

    Written on the raw timestamp column (not on a formatted day string), so
    Catalyst pushes it into the parquet scan (PushedFilters, row-group skipping).
    """
    col = _c(ts)
    cond = None
    for d in sorted(set(dates)):
        start = F.to_timestamp_ntz(F.lit(d))
        one = (col >= start) & (col < start + F.expr("INTERVAL 1 DAY"))
        cond = one if cond is None else (cond | one)
    return cond if cond is not None else F.lit(False)
