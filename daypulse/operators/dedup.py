"""First-seen device filter, batch form.

The reference keeps a start log iff its (day, device) pair was not yet in a
per-day set.  Batch equivalent: per (mid, dt) keep the *earliest* row by
(ts, event_id).  This is written as ``groupBy(mid, dt).agg(min(struct(...)))``
rather than ``row_number() over (partition by mid, dt)``: the aggregate has a
map-side partial step, so a device holding a third of all rows is reduced to
one row per input partition before the shuffle, whereas a window would pull
every row of that device into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse.functions.timeparts import day_of_ms, hour_of_ms, minute_of_ms


def first_seen(
    logs: DataFrame,
    key: str = "mid",
    ms_col: str = "ts",
    tiebreak: str | None = "event_id",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Earliest row per (key, event day).

    Output: key, dt, hr, mi, ts, [tiebreak], *carry.  ``carry`` columns come
    from the same (earliest) row.  Rows without a key count as no device.
    """
    order = [F.col(ms_col).alias("ts")]
    if tiebreak:
        order.append(F.col(tiebreak).alias(tiebreak))
    order += [F.col(c).alias(c) for c in carry]
    first = (
        logs.where(F.col(key).isNotNull()).groupBy(F.col(key), day_of_ms(ms_col).alias("dt"))
        .agg(F.min(F.struct(*order)).alias("f"))
    )
    rest = ([tiebreak] if tiebreak else []) + list(carry)
    return first.select(key, "dt", hour_of_ms("f.ts").alias("hr"), minute_of_ms("f.ts").alias("mi"),
                        F.col("f.ts").alias("ts"), *[F.col(f"f.{c}").alias(c) for c in rest])


def distinct_day_keys(logs: DataFrame, key: str = "mid", ms_col: str = "ts") -> DataFrame:
    """The per-day key set, (key, dt) distinct."""
    return logs.select(F.col(key), day_of_ms(ms_col).alias("dt")).distinct()


def anti_backfill(
    candidates: DataFrame,
    seen: DataFrame,
    key: str = "mid",
    ms_col: str = "ts",
    tiebreak: str | None = "event_id",
) -> DataFrame:
    """First-seen rows of ``candidates`` whose (key, day) is absent from ``seen``.

    ``seen`` may be raw logs (with ``ms_col``) or a stored fact table (with
    ``dt``).  The seen side is reduced to distinct (key, dt) before the
    anti join, so the shuffle carries each pair once.
    """
    seen_keys = (
        seen.select(key, "dt").distinct() if "dt" in seen.columns
        else distinct_day_keys(seen, key, ms_col)
    )
    firsts = first_seen(candidates, key, ms_col, tiebreak)
    return firsts.join(seen_keys, [key, "dt"], "left_anti")
