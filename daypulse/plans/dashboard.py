"""The dashboard's calls as DataFrame functions, one per endpoint of the reference.

The reference serves these over HTTP; here each is a function of a date (and
its other arguments) that returns a DataFrame.  Day restrictions become scan
predicates: a call for one date reads that day (and the day before for the
hour pairs) from the parquet files, not the whole history -- except new
devices, whose "first seen" needs every earlier day, so that read is bounded
above by the end of the date only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypulse.operators import detail, metrics, region, registry
from daypulse.operators.dedup import first_seen
from daypulse.sources import testdata as td
from daypulse.sources.paths import read_days

# Stored day and hour tables by metric id.
_TYPES = {"dau": T.LongType(), "order_amount": T.DoubleType()}
_TOTAL_GOLD = {m: T.StructType([T.StructField(m, t), T.StructField("dt", T.StringType())])
               for m, t in _TYPES.items()}
_HOUR_GOLD = {m: T.StructType([T.StructField("hr", T.StringType()), T.StructField(m, t),
                               T.StructField("dt", T.StringType())]) for m, t in _TYPES.items()}


def _prev(date: str) -> str:
    from datetime import date as d, timedelta
    return (d.fromisoformat(date) - timedelta(days=1)).isoformat()


def _next(date: str) -> str:
    from datetime import date as d, timedelta
    return (d.fromisoformat(date) + timedelta(days=1)).isoformat()


def realtime_total(spark: SparkSession, base: str, date: str,
                   registry_path: str | None = None) -> DataFrame:
    """``realtime-total?date=``: the three cards (ord, id, name, value) of one day.

    DAU and amount need only that day.  New devices need to know who was seen
    before: with a device registry (``operators.registry``) that is one
    registry partition and the whole call reads a single day; without one,
    activity is read up to the end of ``date``.
    """
    # a day without any activity still gets its three cards, valued 0
    day = spark.range(1).select(F.lit(date).alias("dt"))
    if registry_path is None:
        act = td.activity(spark, base, before=_next(date))
        summary = metrics.daily_summary(act).filter(F.col("dt") == date)
        return metrics.cards(day.join(summary, "dt", "left")).drop("dt")
    dau = metrics.dau_total(td.start_logs(spark, base, dates=[date]))
    amount = metrics.order_amount_total(td.purchases(spark, base, dates=[date]))
    new = registry.new_devices_on(spark, registry_path, [date])
    summary = day.join(dau, "dt", "left").join(new, "dt", "left").join(amount, "dt", "left")
    return metrics.cards(summary).drop("dt")


def realtime_hour(spark: SparkSession, base: str, metric_id: str, date: str) -> DataFrame:
    """``realtime-hour?id=&date=``: (series, hr, value) for yesterday and today, 24 hours each.

    An unknown id gives no rows (the reference returns nothing for it).
    """
    days = [_prev(date), date]
    if metric_id == "dau":
        hourly = metrics.dau_hour(first_seen(td.start_logs(spark, base, dates=days)))
        value = "dau"
    elif metric_id == "order_amount":
        hourly = metrics.order_amount_hour(td.purchases(spark, base, dates=days))
        value = "order_amount"
    else:
        return spark.createDataFrame([], "series string, hr string, value double")
    return _hour_pairs(spark, hourly, value, date)


def _hour_pairs(spark: SparkSession, hourly: DataFrame, value: str, date: str) -> DataFrame:
    # a zero-valued row marks ``date`` as present, so a day without activity
    # still gets its 24 hours (and yesterday's values) instead of no rows
    present = spark.range(1).select(F.lit(date).alias("dt"), F.lit("00").alias("hr"),
                                    F.lit(0).cast(hourly.schema[value].dataType).alias(value))
    compare = metrics.hour_compare(hourly.unionByName(present), value)
    series = metrics.hour_series(compare.filter(F.col("dt") == date), value)
    return series.select("series", "hr", "value")


def stored_total(spark: SparkSession, gold_path: str, registry_path: str, date: str) -> DataFrame:
    """``realtime_total`` from what the stream stores: three day folders, whatever the history."""
    day = spark.range(1).select(F.lit(date).alias("dt"))
    dau = read_days(spark, f"{gold_path}/dau_total", _TOTAL_GOLD["dau"], [date])
    amount = read_days(spark, f"{gold_path}/order_amount_total", _TOTAL_GOLD["order_amount"], [date])
    new = registry.new_devices_on(spark, registry_path, [date])
    summary = day.join(dau, "dt", "left").join(new, "dt", "left").join(amount, "dt", "left")
    return metrics.cards(summary).drop("dt")


def stored_hour(spark: SparkSession, gold_path: str, metric_id: str, date: str) -> DataFrame:
    """``realtime_hour`` from the stored hours of ``date`` and the day before."""
    if metric_id not in _HOUR_GOLD:
        return spark.createDataFrame([], "series string, hr string, value double")
    hourly = read_days(spark, f"{gold_path}/{metric_id}_hour", _HOUR_GOLD[metric_id],
                       [_prev(date), date])
    return _hour_pairs(spark, hourly, metric_id, date)


def realtime_hour_json(spark: SparkSession, base: str, metric_id: str, date: str) -> DataFrame:
    """The same as one JSON text: ``{"yesterday":{"00":v,...},"today":{...}}``."""
    s = realtime_hour(spark, base, metric_id, date)
    entries = lambda name: F.map_from_entries(F.array_sort(F.collect_list(
        F.when(F.col("series") == name, F.struct("hr", "value")))))
    return s.agg(F.to_json(F.struct(entries("yesterday").alias("yesterday"),
                                    entries("today").alias("today"))).alias("json"))


def sale_detail(spark: SparkSession, base: str, date: str | None = None, keyword: str | None = None,
                startpage: int = 1, size: int = 20, level: int | str | None = None
                ) -> dict[str, DataFrame]:
    """``sale_detail``: total, age and category shares, and one page of rows.

    Blank arguments mean "no filter" (F10); ``startpage`` is a 1-based page.
    """
    search = detail.Search.of(date=date, keyword=keyword, level=level)
    return detail.sale_detail_bundle(spark, base, search, int(startpage), int(size))


def region_map(spark: SparkSession, base: str) -> DataFrame:
    """Province map: (name, value, bin) for every region, legend bin included."""
    return region.region_bins(region.region_sales(spark, base))


def activity_on(spark: SparkSession, base: str, date: str, registry_path: str) -> DataFrame:
    """A16 for one date: (dau, known, activity) with known = devices registered up to ``date``.

    Reads that day's start logs and the registry partitions up to ``date``
    (device-level rows, not raw history).
    """
    dau = metrics.dau_total(td.start_logs(spark, base, dates=[date]))
    known = (registry.read_registry(spark, registry_path).filter(F.col("first_dt") <= date)
             .agg(F.count(F.lit(1)).alias("known")).withColumn("dt", F.lit(date)))
    day = spark.range(1).select(F.lit(date).alias("dt"))
    dau_v = F.coalesce(F.col("dau"), F.lit(0)).cast("bigint")
    return day.join(dau, "dt", "left").join(known, "dt", "left").select(
        dau_v.alias("dau"), "known",
        F.try_divide(dau_v.cast("double"), F.col("known").cast("double")).alias("activity"))
