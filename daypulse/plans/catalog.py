"""Registered queries: one per batch-testable operator of the inventory.

Each query takes ``(spark, base)`` -- ``base`` is a folder of parquet tables --
reads whole tables and computes the metric for every day present.  The
dashboard's per-date calls are in ``daypulse.plans.dashboard``; the matching
DuckDB statement for each query lives in ``daypulse.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.functions.scalar import dau_query_alias, dau_set_key, dau_table_name
from daypulse.functions.timeparts import day_of_ms, epoch_ms, with_time_parts
from daypulse.operators import continuity, detail, distinct, keyword, metrics, region, upsert
from daypulse.operators.dedup import anti_backfill, first_seen
from daypulse.sources import applog, testdata as td
from daypulse.sources.tables import read_table
from daypulse.streaming import gold
from daypulse.streaming.dau_stream import arrival_class

Query = Callable[[SparkSession, str], DataFrame]

# Arguments of the registered detail search (a dashboard call: keyword typed,
# second page of 20).  Fixed so that Spark and the oracle answer the same call.
SEARCH_KEYWORD = "red"
SEARCH_PAGE = 2
SEARCH_SIZE = 20
SEARCH_DATE = "1996-08-12"
SEARCH_LEVEL = 1
# Keywords of the registered index search (of one, two and more letters, and one without a match), and its deep page.
INDEX_KEYWORDS = ("e", "re", "red", "blue", "antique", "RED BLU", "zzzz")
DEEP_PAGE = 1500


# --- ingest -------------------------------------------------------------------

def q_route_logs(spark, base):
    return applog.route_logs(td.raw_logs(spark, base), keep=("partition", "offset"))


def q_parse_logs(spark, base):
    return applog.parse_start_logs(td.raw_logs(spark, base), keep=("offset",))


def q_time_parts(spark, base):
    ev = td.events(spark, base).select("event_id", epoch_ms("ts").alias("ts"))
    return with_time_parts(ev, "ts")


def q_partition_keys(spark, base):
    days = td.start_logs(spark, base).select(day_of_ms("ts").alias("dt")).distinct()
    return days.select("dt", dau_set_key("dt").alias("set_key"),
                       dau_table_name("dt").alias("table_name"),
                       dau_query_alias("dt").alias("query_alias"))


def q_read_table(spark, base):
    return read_table(spark, "nation", base)


# --- dedup / fact rows ----------------------------------------------------------

def q_dau_first_seen(spark, base):
    return first_seen(td.start_logs(spark, base))


def q_dau_detail(spark, base):
    """F5 end to end: start-topic lines -> parse -> first seen -> 9-column fact row."""
    parsed = applog.parse_start_logs(td.start_topic_lines(spark, base), keep=("offset",))
    firsts = first_seen(parsed, tiebreak="offset", carry=("uid", "ar", "ch", "vc"))
    return firsts.select(*applog.FACT_COLUMNS)


def q_dau_anti_backfill(spark, base):
    seen, candidates = td.seen_and_candidates(spark, base)
    return anti_backfill(candidates, seen)


def q_dedup_stats(spark, base):
    return metrics.dedup_stats(td.start_logs(spark, base))


# --- publisher metrics ------------------------------------------------------------

def q_dau_total(spark, base):
    return metrics.dau_total(td.start_logs(spark, base))


def q_dau_hour(spark, base):
    return metrics.dau_hour(first_seen(td.start_logs(spark, base)))


def q_dau_hour_compare(spark, base):
    return metrics.hour_compare(q_dau_hour(spark, base), "dau")


def q_hour_series(spark, base):
    """Both polled metrics in long form."""
    return (metrics.hour_series(q_dau_hour_compare(spark, base), metrics.CARD_DAU[0])
            .unionByName(metrics.hour_series(q_order_amount_hour_compare(spark, base),
                                             metrics.CARD_ORDER_AMOUNT[0])))


def q_metric_series(spark, base):
    """One metric picked from the table that holds both."""
    return metrics.select_metric(q_hour_series(spark, base), metrics.CARD_ORDER_AMOUNT[0])


def q_order_amount_hour_json(spark, base):
    return metrics.hour_json(q_order_amount_hour_compare(spark, base), metrics.MONEY)


def q_arrival_classes(spark, base):
    """T5: start logs per day and class, against the time the broker took them in.

    The broker time of the test logs: every seventh device's clock is some days wrong.
    """
    logs = td.start_logs(spark, base)
    shift = F.when(F.col("event_id") % 7 == 0, F.col("event_id") % 11 - 5).otherwise(0)
    logs = logs.withColumn("timestamp", F.timestamp_millis(
        F.col("ts") - shift.cast("bigint") * F.lit(86_400_000)))
    return (logs.select(day_of_ms("ts").alias("dt"), arrival_class().alias("arrival"))
            .groupBy("dt", "arrival").agg(F.count(F.lit(1)).alias("rows")))


def q_dau_hour_json(spark, base):
    return metrics.hour_json(q_dau_hour_compare(spark, base))


def q_order_amount_total(spark, base):
    return metrics.order_amount_total(td.purchases(spark, base))


def q_order_amount_hour(spark, base):
    return metrics.order_amount_hour(td.purchases(spark, base))


def q_order_amount_hour_compare(spark, base):
    return metrics.hour_compare(q_order_amount_hour(spark, base), "order_amount", fill=0.0)


def q_new_devices(spark, base):
    return metrics.new_devices(td.start_logs(spark, base))


def q_new_users(spark, base):
    return metrics.new_devices(td.signups(spark, base), key="uid", out="new_users")


def q_launch_count(spark, base):
    return metrics.launch_count(td.start_logs(spark, base))


def q_hourly_active(spark, base):
    return metrics.hourly_active(td.start_logs(spark, base))


def q_launches_hourly(spark, base):
    return metrics.launches_hourly(td.start_logs(spark, base))


def q_activity_rate(spark, base):
    return metrics.activity_rate(td.start_logs(spark, base))


def q_dau_cumulative(spark, base):
    return metrics.dau_cumulative(first_seen(td.start_logs(spark, base)))


def q_day_over_day(spark, base):
    return metrics.day_over_day(q_dau_total(spark, base), "dau")


def _cards(spark, base):
    return metrics.cards(metrics.daily_summary(td.activity(spark, base)))


def q_realtime_total(spark, base):
    return _cards(spark, base)


def q_totals_json(spark, base):
    return metrics.totals_json(_cards(spark, base))


# --- offsets / upsert ---------------------------------------------------------------

def q_latest_offsets(spark, base):
    return upsert.latest_offsets(td.stream_progress(spark, base))


def q_upsert_latest(spark, base):
    return upsert.latest_by_key(td.upsert_batches(spark, base), "key", ["event_id"])


# --- detail search ------------------------------------------------------------------

_SEARCH = detail.Search.of(keyword=SEARCH_KEYWORD)


def q_sale_detail_wide(spark, base):
    return detail.sale_detail_wide(spark, base)


def q_sale_detail_page(spark, base):
    return detail.sale_detail_page(spark, base, _SEARCH, SEARCH_PAGE, SEARCH_SIZE)


def q_sale_detail_total(spark, base):
    return detail.sale_detail_total(spark, base, _SEARCH)


_FULL_SEARCH = detail.Search.of(date=SEARCH_DATE, keyword=SEARCH_KEYWORD, level=SEARCH_LEVEL)


def q_sale_detail_search_page(spark, base):
    """P2 + P5: keyword, date and level set."""
    return detail.sale_detail_page(spark, base, _FULL_SEARCH, 1, SEARCH_SIZE)


def q_sale_detail_shares(spark, base):
    """A10 + A11 under a search, with its total."""
    return detail.search_shares(spark, base, _SEARCH)


def q_sale_detail_json(spark, base):
    """The whole reply of a search as one JSON text."""
    return detail.sale_detail_json(spark, base, _FULL_SEARCH, 1, SEARCH_SIZE)


def q_category_share(spark, base):
    return detail.category_share(spark, base)


def q_age_share(spark, base):
    return detail.age_share(spark, base)


# --- region / names / terms ------------------------------------------------------------

def q_region_sales(spark, base):
    return region.region_sales(spark, base)


def q_region_bins(spark, base):
    return region.region_bins(region.region_sales(spark, base))


def q_sales_by_name(spark, base):
    return region.sales_by_name(spark, base)


def q_array_terms(spark, base):
    return region.product_name_terms(spark, base)


def q_resume_offsets(spark, base):
    """The newest offsets of a log that new checkpoints went on with."""
    return upsert.latest_offsets(td.restarted_progress(spark, base))


def q_offset_gaps(spark, base):
    """What the archive lacks and what it holds twice."""
    return continuity.offset_report(td.archived_offsets(spark, base), block=1024)


def q_dau_hour_folded(spark, base):
    """The stored hours from the change rows of all micro-batches."""
    emitted = td.emitted_firsts(spark, base)
    changes = gold.hour_changes(emitted.withColumn("dt", F.struct("dt", "batch_id")))  # a change row per batch
    return gold.fold(changes.select("dt.dt", "hr", "delta"))


def q_active_windows(spark, base):
    """Daily, weekly and monthly active devices from hourly bitmaps."""
    logs = td.start_logs(spark, base)
    return distinct.trailing_devices(distinct.hour_bitmaps(logs, distinct.device_numbers(logs)))


def q_active_by_shift(spark, base):
    """Distinct devices per day and eight-hour shift, merged from hourly bitmaps."""
    logs = td.start_logs(spark, base)
    hours = distinct.hour_bitmaps(logs, distinct.device_numbers(logs))
    shift = F.floor(F.col("hr").cast("int") / 8).cast("int")
    return distinct.devices_in(hours.withColumn("shift", shift), "dt", "shift")


def q_keyword_matches(spark, base):
    """Parts by keyword through the index of their names."""
    parts = read_table(spark, "part", base).select("p_partkey", "p_name")
    index = keyword.build_index(parts, "p_partkey", "p_name")
    found = keyword.matches_of_all(spark, parts, index, list(INDEX_KEYWORDS), "p_partkey", "p_name")
    return found.select("keyword", F.col("id").alias("sku_id"), F.col("text").alias("sku_name"))


def q_sale_detail_deep_page(spark, base):
    """L3: a deep page by the rank directory."""
    return detail.sale_detail_jump(spark, base, page=DEEP_PAGE, size=SEARCH_SIZE)


QUERIES: dict[str, Query] = {
    "route_logs": q_route_logs,
    "parse_logs": q_parse_logs,
    "time_parts": q_time_parts,
    "partition_keys": q_partition_keys,
    "read_table": q_read_table,
    "dau_first_seen": q_dau_first_seen,
    "dau_detail": q_dau_detail,
    "dau_anti_backfill": q_dau_anti_backfill,
    "dedup_stats": q_dedup_stats,
    "dau_total": q_dau_total,
    "dau_hour": q_dau_hour,
    "dau_hour_compare": q_dau_hour_compare,
    "hour_series": q_hour_series,
    "metric_series": q_metric_series,
    "dau_hour_json": q_dau_hour_json,
    "order_amount_hour_json": q_order_amount_hour_json,
    "arrival_classes": q_arrival_classes,
    "order_amount_total": q_order_amount_total,
    "order_amount_hour": q_order_amount_hour,
    "order_amount_hour_compare": q_order_amount_hour_compare,
    "new_devices": q_new_devices,
    "new_users": q_new_users,
    "launch_count": q_launch_count,
    "hourly_active": q_hourly_active,
    "launches_hourly": q_launches_hourly,
    "activity_rate": q_activity_rate,
    "dau_cumulative": q_dau_cumulative,
    "day_over_day": q_day_over_day,
    "realtime_total": q_realtime_total,
    "totals_json": q_totals_json,
    "latest_offsets": q_latest_offsets,
    "upsert_latest": q_upsert_latest,
    "sale_detail_wide": q_sale_detail_wide,
    "sale_detail_page": q_sale_detail_page,
    "sale_detail_total": q_sale_detail_total,
    "sale_detail_search_page": q_sale_detail_search_page,
    "sale_detail_shares": q_sale_detail_shares,
    "sale_detail_json": q_sale_detail_json,
    "category_share": q_category_share,
    "age_share": q_age_share,
    "region_sales": q_region_sales,
    "region_bins": q_region_bins,
    "sales_by_name": q_sales_by_name,
    "array_terms": q_array_terms,
    "resume_offsets": q_resume_offsets,
    "offset_gaps": q_offset_gaps,
    "dau_hour_folded": q_dau_hour_folded,
    "active_windows": q_active_windows,
    "active_by_shift": q_active_by_shift,
    "keyword_matches": q_keyword_matches,
    "sale_detail_deep_page": q_sale_detail_deep_page,
}
