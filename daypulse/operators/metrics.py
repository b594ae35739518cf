"""Dashboard metrics over start logs, signups and purchases.

Inputs are DataFrames with at least ``mid`` (or another key) and ``ts`` (epoch
ms); purchases also carry ``amount`` DECIMAL(18,2).  Every metric is computed
for **every day** present in its input.  ``dates`` restricts on the ``dt``
column, which prunes the ``dt`` partitions of a stored fact table; for raw
events pass ``dates`` to the source instead (``sources.testdata``), which
pushes a ``ts`` range into the parquet scan.

Scale notes
* All raw-data aggregations have a map-side partial step (hash aggregates;
  struct-valued min/max plan as sort aggregates), so a hot key -- one device
  or one day holding a third of the rows -- is combined before the exchange.
* Day x hour spines are generated per row of the (already aggregated) hourly
  table with ``inline`` of a 24-entry array -- no cross join, no spine join.
* The only windows run over aggregated day-level or (day, hour)-level tables.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daypulse.functions.scalar import change_rate
from daypulse.functions.timeparts import day_of_ms, hour_of_ms, shift_day

# ---------------------------------------------------------------------------
# Fixed values of the metric cards: id and display name, in display order.
CARD_DAU = ("dau", "新增日活")
CARD_NEW_MID = ("new_mid", "新增设备")
CARD_ORDER_AMOUNT = ("order_amount", "新增交易额")
# Hour-series labels.
SERIES_TODAY = "today"
SERIES_YESTERDAY = "yesterday"
# ---------------------------------------------------------------------------

MONEY = "decimal(18,2)"


def _only(df: DataFrame, dates: Iterable[str] | None, col: str = "dt") -> DataFrame:
    if dates is None:
        return df
    return df.filter(F.col(col).isin(list(dates)))


def _with_dt(df: DataFrame, ms_col: str = "ts") -> DataFrame:
    return df if "dt" in df.columns else df.withColumn("dt", day_of_ms(ms_col))


def _with_hr(df: DataFrame, ms_col: str = "ts") -> DataFrame:
    return df if "hr" in df.columns else df.withColumn("hr", hour_of_ms(ms_col))


def _money(c) -> F.Column:
    """Exact DECIMAL sum exposed as DOUBLE (stable across engines and JSON)."""
    return c.cast(MONEY).cast("double")


# --- A1 / A2 / A7 / A8 -----------------------------------------------------

def dau_total(logs: DataFrame, key: str = "mid", dates=None, approx: bool = False) -> DataFrame:
    """A1: distinct devices per day -> (dt, dau).

    ``approx=True`` uses HyperLogLog++ (fixed-size sketch per day, no per-device
    shuffle) for very large days; the exact count is the default.
    """
    df = _only(_with_dt(logs), dates)
    agg = F.approx_count_distinct(key) if approx else F.countDistinct(key)
    return df.groupBy("dt").agg(agg.alias("dau"))


def dau_hour(firsts: DataFrame, dates=None) -> DataFrame:
    """A2: first launches per (dt, hr) -> (dt, hr, dau); hours without any are absent.

    ``firsts`` is the first-seen output (one row per device and day).
    """
    return _only(firsts, dates).groupBy("dt", "hr").agg(F.count(F.lit(1)).alias("dau"))


def launch_count(logs: DataFrame, dates=None) -> DataFrame:
    """Start logs per day before dedup -> (dt, launches)."""
    return _only(_with_dt(logs), dates).groupBy("dt").agg(F.count(F.lit(1)).alias("launches"))


def hourly_active(logs: DataFrame, key: str = "mid", approx: bool = False, dates=None) -> DataFrame:
    """Distinct devices per (dt, hr) -> (dt, hr, active).

    ``approx=True`` uses HyperLogLog++ (bounded state per group) for very
    large hours.
    """
    df = _with_hr(_only(_with_dt(logs), dates))
    agg = F.approx_count_distinct(key) if approx else F.countDistinct(key)
    return df.groupBy("dt", "hr").agg(agg.alias("active"))


def launches_hourly(logs: DataFrame, ms_col: str = "ts") -> DataFrame:
    """T6 (batch form): launches per 1-hour tumbling window -> (dt, hr, launches)."""
    w = F.window(F.timestamp_millis(ms_col), "1 hour")
    return (
        logs.groupBy(w.alias("w"))
        .agg(F.count(F.lit(1)).alias("launches"))
        .select(F.date_format("w.start", "yyyy-MM-dd").alias("dt"),
                F.date_format("w.start", "HH").alias("hr"), "launches")
    )


# --- A3 / A5 / J3 / U2 / P4 --------------------------------------------------

def hour_compare(hourly: DataFrame, value: str, fill=0) -> DataFrame:
    """Dense 24-hour pairing of each day with the day before.

    (dt, hr, today, yesterday); absent hours and an absent yesterday are ``fill``.

    One pass over ``hourly`` and one aggregation, no join: every hourly row is
    expanded (``inline``) into its own (dt, hr) as ``today``, the next day's
    (dt, hr) as ``yesterday``, and the 24 zero rows of its day (the dense
    spine).  Summing per (dt, hr) pairs them; days that only appear as "the
    day after" are dropped.  Referencing the input once keeps a single scan.
    """
    vtype = _sum_type(hourly, value)
    v, zero = F.col(value), F.lit(fill).cast(vtype)

    def row(dt, hr, today, yesterday, present):
        return F.struct(dt.alias("dt"), hr.alias("hr"), today.alias("today"),
                        yesterday.alias("yesterday"), F.lit(present).alias("present"))

    spine = F.transform(F.sequence(F.lit(0), F.lit(23)),
                        lambda h: row(F.col("dt"), F.lpad(h.cast("string"), 2, "0"), zero, zero, 1))
    rows = F.concat(F.array(row(F.col("dt"), F.col("hr"), v, zero, 1),
                            row(shift_day("dt", 1), F.col("hr"), zero, v, 0)), spine)
    out = (hourly.select(F.inline(rows))
           .groupBy("dt", "hr")
           .agg(F.sum("today").cast(vtype).alias("today"),
                F.sum("yesterday").cast(vtype).alias("yesterday"),
                F.max("present").alias("present")))
    return out.filter(F.col("present") == 1).drop("present")


def _sum_type(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()


def hour_series(compare: DataFrame, metric_id: str) -> DataFrame:
    """Long form (id, dt, series, hr, value) of a ``hour_compare`` table.

    The two labelled series are a union of ``yesterday`` and ``today``, built
    as one explode so the compare table is read once.
    """
    pair = F.array(
        F.struct(F.lit(SERIES_YESTERDAY).alias("series"), F.col("yesterday").cast("double").alias("value")),
        F.struct(F.lit(SERIES_TODAY).alias("series"), F.col("today").cast("double").alias("value")))
    return compare.select(F.lit(metric_id).alias("id"), "dt", "hr",
                          F.explode(pair).alias("s")).select("id", "dt", "s.series", "hr", "s.value")


def select_metric(series: DataFrame, metric_id: str) -> DataFrame:
    """Pick one metric id from a long metric table; an unknown id gives no rows."""
    return series.filter(F.col("id") == F.lit(metric_id))


def hour_json(compare: DataFrame, as_type: str = "bigint") -> DataFrame:
    """Per day ``{"yesterday":{"00":n,...},"today":{...}}`` as JSON text.

    Values are written as ``as_type``.  Each group is exactly the 24 hours of one day.
    """
    entries = lambda c: F.map_from_entries(
        F.array_sort(F.collect_list(F.struct("hr", F.col(c).cast(as_type)))))
    agg = compare.groupBy("dt").agg(entries("yesterday").alias("y"), entries("today").alias("t"))
    return agg.select("dt", F.to_json(F.struct(F.col("y").alias(SERIES_YESTERDAY),
                                               F.col("t").alias(SERIES_TODAY))).alias("json"))


# --- A4 / A5 -----------------------------------------------------------------

def order_amount_total(purchases: DataFrame, dates=None) -> DataFrame:
    """A4: exact DECIMAL(18,2) amount per day -> (dt, order_amount)."""
    df = _only(_with_dt(purchases), dates)
    return df.groupBy("dt").agg(_money(F.sum(F.col("amount").cast(MONEY))).alias("order_amount"))


def order_amount_hour(purchases: DataFrame, dates=None) -> DataFrame:
    """A5: amount per (dt, hr) -> (dt, hr, order_amount)."""
    df = _with_hr(_only(_with_dt(purchases), dates))
    return df.groupBy("dt", "hr").agg(
        _money(F.sum(F.col("amount").cast(MONEY))).alias("order_amount"))


# --- A6 / A9 / A16 ---------------------------------------------------------

def first_day(logs: DataFrame, key: str) -> DataFrame:
    """Earliest day per key -> (key, dt); rows without a key count as none."""
    return _with_dt(logs).where(F.col(key).isNotNull()).groupBy(key).agg(F.min("dt").alias("dt"))


def new_devices(logs: DataFrame, key: str = "mid", out: str = "new_mid", dates=None) -> DataFrame:
    """Keys whose first day is ``dt`` -> (dt, out).

    Two hash aggregates: min(dt) per key (partial on the map side), then a
    count per day.  The day filter must apply *after* the first step, so that
    a key first seen earlier is not new.
    """
    return _only(first_day(logs, key), dates).groupBy("dt").agg(F.count(F.lit(1)).alias(out))


def activity_rate(logs: DataFrame, key: str = "mid") -> DataFrame:
    """DAU / devices known up to and including that day.

    (dt, dau, known, activity).  One scan: per (device, day) rows, the
    device's first day as a window over its own day rows (bounded by the
    calendar), a count per day, and a running total of new devices over the
    day-level table (one row per calendar day).
    """
    per_kd = _with_dt(logs).where(F.col(key).isNotNull()).select(key, "dt").distinct()
    first = F.min("dt").over(Window.partitionBy(key))
    per_day = per_kd.withColumn("first_dt", first).groupBy("dt").agg(
        F.count(F.lit(1)).alias("dau"),
        F.count(F.when(F.col("dt") == F.col("first_dt"), 1)).alias("new"))
    w = Window.orderBy("dt").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = F.sum("new").over(w).cast("bigint")
    return per_day.select("dt", "dau", known.alias("known")).withColumn(
        "activity", F.col("dau").cast("double") / F.col("known").cast("double"))


# --- W1 / F14 ----------------------------------------------------------------

def dau_cumulative(firsts: DataFrame) -> DataFrame:
    """Dense (dt, hr, dau, cum_dau): running first launches through each hour."""
    dense = hour_compare(dau_hour(firsts), "dau").select("dt", "hr", F.col("today").alias("dau"))
    w = (Window.partitionBy("dt").orderBy("hr")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return dense.withColumn("cum_dau", F.sum("dau").over(w).cast("bigint"))


def day_over_day(daily: DataFrame, value: str) -> DataFrame:
    """(dt, today, yesterday, rate); yesterday = the calendar day before.

    Paired on the shifted day (not ``lag``), so gaps in the calendar give a
    zero yesterday and a NULL rate instead of comparing with an older day.
    One pass: each day row also counts as the next day's ``yesterday``.
    """
    zero = F.lit(0).cast(_sum_type(daily, value))
    v = F.col(value)
    rows = F.array(
        F.struct(F.col("dt").alias("dt"), v.alias("today"), zero.alias("yesterday"), F.lit(1).alias("present")),
        F.struct(shift_day("dt", 1).alias("dt"), zero.alias("today"), v.alias("yesterday"),
                 F.lit(0).alias("present")))
    out = (daily.select(F.explode(rows).alias("r")).select("r.*").groupBy("dt")
           .agg(F.sum("today").alias("today"), F.sum("yesterday").alias("yesterday"),
                F.max("present").alias("present"))
           .filter(F.col("present") == 1))
    return out.select("dt", F.col("today").cast(_sum_type(daily, value)).alias("today"),
                      F.col("yesterday").cast(_sum_type(daily, value)).alias("yesterday"),
                      change_rate("today", "yesterday").alias("rate"))


# --- U1 / S11 ----------------------------------------------------------------

def daily_summary(activity: DataFrame, key: str = "mid") -> DataFrame:
    """Per day: dau, new_mid and order_amount from ONE pass over the activity.

    ``activity`` rows are start logs (``is_start`` true) and purchases
    (``amount``), with ``key`` and ``ts``.  First a hash aggregate per (key,
    day) -- a hot device collapses to one row per day -- then the device's
    first start day as a window over that device's day rows (at most one row
    per calendar day, so bounded), then one aggregate per day.
    """
    per_kd = _with_dt(activity).groupBy(key, "dt").agg(
        F.max(F.col("is_start").cast("int")).alias("started"),
        F.sum(F.col("amount").cast(MONEY)).alias("amt"))
    # amounts without a device count, devices without a key do not
    per_kd = per_kd.withColumn("started", F.when(F.col(key).isNotNull(), F.col("started")))
    first = F.min(F.when(F.col("started") == 1, F.col("dt"))).over(Window.partitionBy(key))
    return (per_kd.withColumn("first_dt", first).groupBy("dt").agg(
        F.sum("started").cast("bigint").alias("dau"),
        F.count(F.when((F.col("started") == 1) & (F.col("dt") == F.col("first_dt")), 1))
        .alias("new_mid"),
        _money(F.sum("amt")).alias("order_amount")))


def cards(summary: DataFrame) -> DataFrame:
    """Explode a daily summary (dt, dau, new_mid, order_amount) into three
    cards per day (dt, ord, id, name, value DOUBLE); a missing metric is 0."""
    def card(ord_, spec, col):
        return F.struct(F.lit(ord_).alias("ord"), F.lit(spec[0]).alias("id"),
                        F.lit(spec[1]).alias("name"),
                        F.coalesce(F.col(col).cast("double"), F.lit(0.0)).alias("value"))

    exploded = F.explode(F.array(card(1, CARD_DAU, "dau"), card(2, CARD_NEW_MID, "new_mid"),
                                 card(3, CARD_ORDER_AMOUNT, "order_amount")))
    return summary.select("dt", exploded.alias("card")).select("dt", "card.*")


def realtime_total(dau: DataFrame, new_mid: DataFrame, amount: DataFrame) -> DataFrame:
    """U1 from three precomputed day-level tables (e.g. gold tables).

    Days = every day present in any input; they are full-outer joined on
    ``dt`` (day-level rows only) and exploded into cards.  Over raw activity,
    prefer ``cards(daily_summary(...))``, which scans the input once.
    """
    days = (dau.select("dt", "dau")
            .join(new_mid.select("dt", "new_mid"), "dt", "full")
            .join(amount.select("dt", "order_amount"), "dt", "full"))
    return cards(days)


def totals_json(cards: DataFrame) -> DataFrame:
    """Per day the JSON card list ``[{"id","name","value"}, ...]`` in card order.

    Device counts are whole numbers, the amount has two decimals.  Each group is the 3 cards of a day.
    """
    money = F.col("id") == CARD_ORDER_AMOUNT[0]
    number = F.when(money, F.col("value").cast(MONEY).cast("string")).otherwise(F.col("value").cast("bigint").cast("string"))
    # to_json writes one number form for a column, so the value goes in as text behind the named fields
    named = F.to_json(F.struct("id", "name"))
    card = F.concat(F.expr("left(j, length(j) - 1)"), F.lit(',"value":'), F.col("number"), F.lit("}"))
    rows = cards.select("dt", "ord", named.alias("j"), number.alias("number")).select("dt", "ord", card.alias("card"))
    agg = rows.groupBy("dt").agg(F.array_sort(F.collect_list(F.struct("ord", "card"))).alias("c"))
    return agg.select("dt", F.concat(F.lit("["), F.array_join(F.col("c.card"), ","), F.lit("]")).alias("json"))


# --- A15 -----------------------------------------------------------------------

def dedup_stats(logs: DataFrame, key: str = "mid") -> DataFrame:
    """A15 (batch form): per day, rows in, rows kept by first-seen, rows dropped."""
    df = _with_dt(logs)
    return df.groupBy("dt").agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.countDistinct(key).alias("kept_rows"),
    ).withColumn("dropped_rows", F.col("input_rows") - F.col("kept_rows"))
