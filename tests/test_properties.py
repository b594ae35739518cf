"""Cross-metric properties on the sf0.01 tables, plus paging and search."""

import pytest
from pyspark.sql import functions as F

from daypulse.operators import detail
from daypulse.plans import catalog as c
from tests.conftest import SF001


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "dau_total": {r.dt: r.dau for r in c.q_dau_total(spark, SF001).collect()},
        "dau_hour": c.q_dau_hour(spark, SF001).collect(),
        "cum": c.q_dau_cumulative(spark, SF001).collect(),
        "launch": {r.dt: r.launches for r in c.q_launch_count(spark, SF001).collect()},
        "active": {(r.dt, r.hr): r.active for r in c.q_hourly_active(spark, SF001).collect()},
    }


def test_hours_sum_to_total(tables):
    sums = {}
    for r in tables["dau_hour"]:
        sums[r.dt] = sums.get(r.dt, 0) + r.dau
    assert sums == tables["dau_total"]


def test_cumulative_ends_at_total(tables):
    last = {r.dt: r.cum_dau for r in tables["cum"] if r.hr == "23"}
    assert last == tables["dau_total"]


def test_total_at_most_launches(tables):
    assert all(tables["dau_total"][d] <= tables["launch"][d] for d in tables["dau_total"])


def test_hourly_active_at_least_first_launches(tables):
    assert all(tables["active"][(r.dt, r.hr)] >= r.dau for r in tables["dau_hour"])


def test_shares_sum_to_one(spark):
    for q in (c.q_category_share, c.q_age_share):
        total = q(spark, SF001).agg(F.sum("pct")).first()[0]
        assert total == pytest.approx(1.0)


def test_share_totals_match_detail_count(spark):
    n = detail.sale_detail_wide(spark, SF001).count()
    assert c.q_category_share(spark, SF001).agg(F.sum("value")).first()[0] == n
    assert c.q_age_share(spark, SF001).agg(F.sum("value")).first()[0] == n


def test_search_filters_and_pages(spark):
    s = detail.Search.of(date="1996-03-14", keyword=" ", level="")
    assert s.keyword is None and s.level is None
    wide = detail.sale_detail_wide(spark, SF001, s)
    n = wide.count()
    assert n > 0 and wide.filter(F.col("dt") != "1996-03-14").count() == 0
    total = detail.sale_detail_total(spark, SF001, s).first().total
    assert total == n
    size = 10
    pages = [detail.sale_detail_page(spark, SF001, s, p, size).collect() for p in range(1, n // size + 3)]
    assert [len(p) for p in pages[:-1]][-1] == n - size * (n // size) or n % size == 0
    assert len(pages[-1]) == 0  # past the end
    flat = [tuple(r) for p in pages for r in p]
    assert len(flat) == n and flat == sorted(flat, key=lambda r: (r[10], r[1], r[0], r[3], r[2], r[4], r[5], r[6], r[7], r[8], r[9]))


def test_search_level_filter(spark):
    s = detail.Search.of(level=3)
    wide = detail.sale_detail_wide(spark, SF001, s)
    assert wide.count() > 0 and wide.filter(F.col("user_level") != 3).count() == 0
    assert detail.sale_detail_total(spark, SF001, s).first().total == wide.count()
    assert c.q_category_share(spark, SF001).count() >= detail.category_share(spark, SF001, s).count()
    assert detail.category_share(spark, SF001, s).agg(F.sum("value")).first()[0] == wide.count()
    assert detail.age_share(spark, SF001, s).agg(F.sum("value")).first()[0] == wide.count()


def test_metrics_date_argument_restricts(spark):
    from daypulse.operators import metrics
    from daypulse.sources import testdata as td
    sl = td.start_logs(spark, SF001)
    one = metrics.dau_total(sl, dates=["2024-01-05"]).collect()
    assert len(one) == 1 and one[0].dt == "2024-01-05"
    # a device first seen before the date is not new on it
    all_new = {r.dt: r.new_mid for r in metrics.new_devices(sl).collect()}
    day_new = metrics.new_devices(sl, dates=["2024-01-05"]).collect()
    assert [r.new_mid for r in day_new] == ([all_new["2024-01-05"]] if "2024-01-05" in all_new else [])


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["dt", "hr", "dau"] and df.count() > 0


def test_day_restriction_reaches_parquet_scan(spark):
    from daypulse.operators import metrics
    from daypulse.sources import testdata as td
    df = metrics.dau_total(td.start_logs(spark, SF001, dates=["2024-01-05"]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = [ln for ln in plan.splitlines() if "PushedFilters" in ln][0]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed
    full = {r.dt: r.dau for r in c.q_dau_total(spark, SF001).collect()}
    assert [(r.dt, r.dau) for r in df.collect()] == [("2024-01-05", full["2024-01-05"])]


def test_page_is_bounded_top_k(spark):
    df = detail.sale_detail_page(spark, SF001, detail.Search.of(keyword="red"), 3, 10)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "offset=20" in plan


def test_job_defaults_tolerate_unmodifiable_settings():
    """A driver-built session may refuse some settings; only the time zone is required."""
    from daypulse.session import apply_job_defaults

    class Conf:
        def __init__(self):
            self.values = {}

        def get(self, k, default=None):
            return self.values.get(k, default)

        def set(self, k, v):
            if k != "spark.sql.session.timeZone":
                raise RuntimeError("static")
            self.values[k] = v

    class Session:
        conf = Conf()

    s = Session()
    apply_job_defaults(s)
    assert s.conf.values == {"spark.sql.session.timeZone": "UTC"}


def test_keyset_pages_equal_offset_pages(spark):
    s = detail.Search.of(keyword="red")
    size, after, seen = 25, None, []
    for page in range(1, 5):
        by_offset = [tuple(r) for r in detail.sale_detail_page(spark, SF001, s, page, size).collect()]
        by_key = detail.sale_detail_page_after(spark, SF001, s, after, size)
        rows = [tuple(r[c] for c in detail.PAGE_ORDER) for r in by_key.collect()]
        cols = by_key.columns
        assert [tuple(r[cols.index(c)] for c in detail.PAGE_ORDER) for r in by_offset] == rows
        after = rows[-1]
        seen += rows
    assert len(set(seen)) == len(seen)
    plan = detail.sale_detail_page_after(spark, SF001, s, after, size)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "TakeOrderedAndProject(limit=25," in plan


def test_scale_settings_sizes_partitions():
    from daypulse.session import scale_settings
    s = scale_settings(100 * 2**40, 8000)
    assert int(s["spark.sql.shuffle.partitions"]) == 81920
    assert s["spark.sql.adaptive.enabled"] == "true"
    small = scale_settings(10 * 2**20, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
