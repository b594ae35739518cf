"""Distinct device counts that add up: exact bitmaps and sketches per hour.

A count of distinct devices cannot be added to another one.  What can be
merged is kept instead: every device has a number for good, and an hour is the
set of the numbers seen in it, as bitmaps of 32,768 bits each
(``bitmap_construct_agg``); the devices of any span of hours or days are the OR
of its bitmaps.  Where a bound of a few per cent is enough, an HLL sketch per
hour takes a fixed few kilobytes.

A bitmap row covers one range of numbers, so a day of a billion devices is
about 30,000 rows of at most 4 KB that different tasks merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daypulse.functions.timeparts import day_of_ms, hour_of_ms

#: Fixed value: numbers that one hash slot may hold (a slot starts at a multiple of it).
SLOT = 1 << 32


def device_numbers(devices: DataFrame, known: DataFrame | None = None, key: str = "mid",
                   slots: int = 64) -> DataFrame:
    """(key, num): a number for every device; those of ``known`` keep theirs.

    Devices are dealt to ``slots`` by hash and numbered within their slot by
    key, after the numbers it already gave out, so no task sees more than its
    slots and numbers stay dense (``slots`` should grow with the devices).
    NULL keys get none.  A new call with the numbers so far extends them.
    """
    all_keys = devices.select(F.col(key).cast("string").alias(key)).filter(F.col(key).isNotNull()).distinct()
    slot = F.pmod(F.xxhash64(key), F.lit(slots))
    order = Window.partitionBy("slot").orderBy(key)
    if known is None:
        return (all_keys.withColumn("slot", slot)
                .select(key, (F.col("slot") * SLOT + F.row_number().over(order) - 1).alias("num")))
    new = all_keys.join(known.select(key), key, "left_anti").withColumn("slot", slot)
    taken = known.groupBy(slot.alias("slot")).agg((F.max(F.col("num") % SLOT) + 1).alias("base"))
    fresh = new.join(taken, "slot", "left").select(
        key, (F.col("slot") * SLOT + F.coalesce("base", F.lit(0)) + F.row_number().over(order) - 1).alias("num"))
    return known.select(key, "num").unionByName(fresh)


def hour_bitmaps(logs: DataFrame, numbers: DataFrame, key: str = "mid", ms_col: str = "ts") -> DataFrame:
    """(dt, hr, bucket, bitmap): the devices of each hour, one row for each range of numbers that has any."""
    seen = logs.select(F.col(key).cast("string").alias(key), day_of_ms(ms_col).alias("dt"),
                       hour_of_ms(ms_col).alias("hr")).distinct()
    rows = seen.join(numbers, key)
    # numbers start at 0, bit positions and buckets of the built-in functions at 1
    number = F.col("num") + 1
    return (rows.groupBy("dt", "hr", F.bitmap_bucket_number(number).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap")))


def merged(bitmaps: DataFrame, *by: str) -> DataFrame:
    """(by..., bucket, bitmap): bitmaps of larger spans from those of smaller ones."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def devices_in(bitmaps: DataFrame, *by: str) -> DataFrame:
    """(by..., devices): exact distinct devices of each group, from bitmaps alone."""
    counts = merged(bitmaps, *by).select(*by, F.bitmap_count("bitmap").alias("n"))
    return counts.groupBy(*by).agg(F.sum("n").alias("devices"))


def trailing_devices(bitmaps: DataFrame, days: tuple[int, ...] = (1, 7, 30)) -> DataFrame:
    """(dt, active_1d, active_7d, ...): distinct devices of the last n days up to each day that has any.

    Each day's bitmap goes to the days whose span it is in; no join and no raw rows.
    """
    longest = max(days)
    daily = merged(bitmaps, "dt")
    ahead = F.explode(F.sequence(F.lit(0), F.lit(longest - 1)))
    spread = daily.select("*", ahead.alias("back")).select(
        F.date_format(F.date_add(F.to_date("dt"), F.col("back")), "yyyy-MM-dd").alias("day"), "back", "bucket", "bitmap")
    spans = spread.groupBy("day", "bucket").agg(*[
        F.bitmap_count(F.bitmap_or_agg(F.when(F.col("back") < n, F.col("bitmap")))).alias(f"n{n}") for n in days],
        F.min("back").alias("nearest"))
    return (spans.groupBy(F.col("day").alias("dt")).agg(
        *[F.sum(F.coalesce(f"n{n}", F.lit(0))).alias(f"active_{n}d") for n in days], F.min("nearest").alias("nearest"))
        .filter("nearest = 0").drop("nearest"))


def hour_sketches(logs: DataFrame, key: str = "mid", ms_col: str = "ts", lg: int = 12) -> DataFrame:
    """(dt, hr, sketch): an HLL sketch of the devices of each hour (2^lg registers: about 1.6 % error at 12)."""
    rows = logs.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("string").alias(key), day_of_ms(ms_col).alias("dt"), hour_of_ms(ms_col).alias("hr"))
    return rows.groupBy("dt", "hr").agg(F.hll_sketch_agg(key, F.lit(lg)).alias("sketch"))


def devices_about(sketches: DataFrame, *by: str) -> DataFrame:
    """(by..., devices): estimated distinct devices of each group, from sketches alone."""
    merged_ = sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged_.select(*by, F.hll_sketch_estimate("sketch").alias("devices"))
