"""Golden micro-fixtures (FIXTURES.md §4) for the batch operators."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypulse.functions import age_band, change_rate, value_bin
from daypulse.functions.scalar import AGE_BAND_LABELS, share_pct
from daypulse.functions.timeparts import day_of_ms, hour_of_ms, minute_of_ms, prev_day
from daypulse.operators import metrics
from daypulse.operators.dedup import anti_backfill, first_seen
from daypulse.operators.region import array_terms
from daypulse.operators.upsert import latest_by_key, read_upsert_table, write_batch
from daypulse.sources import applog


def _lines(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "offset long, value string")


def _route(spark, values):
    out = applog.route_logs(_lines(spark, values), keep=("offset",)).orderBy("offset").collect()
    return [r.route for r in out]


def test_route_start_variants(spark):
    common = {"common": {"mid": "m"}, "ts": 1}
    vals = [json.dumps({**common, "start": s}) for s in ({}, {"a": 1}, "x", 5)]
    assert _route(spark, vals) == ["start"] * 4


def test_route_event_variants(spark):
    vals = ['{"start":""}', '{"start":null}', '{"x":1}']
    assert _route(spark, vals) == ["event"] * 3


def test_route_rejects(spark):
    vals = ["not json", '{"start":{},"ts":5}', '{"start":{},"common":{"mid":"m"}}']
    assert _route(spark, vals) == ["reject"] * 3


def test_valid_lines_with_other_types_are_kept(spark):
    common = '"common":{"mid":"m"},"start":{}'
    assert _route(spark, ['{"common":"x","page":1}', '{"ts":"abc","page":{}}', '{"page":1,"ts":1.5e12}',
                          '{"common":[],"page":1}', "[1]", "5"]) == ["event"] * 6
    starts = ['{%s,"ts":"1594995376000"}' % common, '{%s,"ts":1594995376000.0}' % common,
              '{%s,"ts":1.594995376e12}' % common]
    assert _route(spark, starts) == ["start"] * 3
    assert [r.ts for r in applog.parse_start_logs(_lines(spark, starts)).collect()] == [1594995376000] * 3
    assert _route(spark, ['{%s,"ts":"abc"}' % common, '{%s,"ts":1e300}' % common, '{%s,"ts":-1}' % common,
                          "", None]) == ["reject"] * 5


def test_parse_start_logs_flattens(spark):
    v = json.dumps({"common": {"mid": "m1", "uid": "u", "ar": "7", "ch": "c", "vc": "9"},
                    "start": {"entry": "icon"}, "ts": 1594995376000})
    r = applog.parse_start_logs(_lines(spark, [v, "bad"])).collect()
    assert len(r) == 1 and (r[0].mid, r[0].uid, r[0].ar, r[0].ch, r[0].vc, r[0].ts) == \
        ("m1", "u", "7", "c", "9", 1594995376000)


def test_epoch_to_parts(spark):
    r = spark.range(1).select(day_of_ms(F.lit(1594995376000)).alias("d"),
                              hour_of_ms(F.lit(1594995376000)).alias("h"),
                              minute_of_ms(F.lit(1594995376000)).alias("m")).first()
    assert (r.d, r.h, r.m) == ("2020-07-17", "14", "16")


def test_fact_rows_order(spark):
    df = spark.createDataFrame([("m", "u", "a", "c", "v", 1594995376000)],
                               "mid string, uid string, ar string, ch string, vc string, ts long")
    out = applog.to_fact_rows(df)
    assert tuple(out.columns) == applog.FACT_COLUMNS
    assert out.first().dt == "2020-07-17"


def _ms(s):
    return int(datetime.strptime(s, "%Y-%m-%d %H:%M:%S.%f").replace(tzinfo=timezone.utc).timestamp() * 1000)


def test_midnight_two_rows(spark):
    df = spark.createDataFrame([("d", _ms("2024-01-01 23:59:59.999"), 1), ("d", _ms("2024-01-02 00:00:00.000"), 2)],
                               "mid string, ts long, event_id long")
    out = sorted((r.dt, r.hr) for r in first_seen(df).collect())
    assert out == [("2024-01-01", "23"), ("2024-01-02", "00")]


def test_first_seen_ties_broken_by_event_id(spark):
    t = _ms("2024-01-01 05:00:00.000")
    df = spark.createDataFrame([("d", t, 9), ("d", t, 3), ("d", t + 1, 1)], "mid string, ts long, event_id long")
    assert first_seen(df).first().event_id == 3


def test_first_seen_hot_device(spark):
    """One device holds a third of all rows: still one row per day, earliest kept."""
    base = _ms("2024-01-01 00:00:00.000")
    hot = spark.range(30000).select(F.lit("hot").alias("mid"),
                                    (F.lit(base) + F.col("id") * 1000).alias("ts"), F.col("id").alias("event_id"))
    cold = spark.range(60000).select((F.col("id") % 500).cast("string").alias("mid"),
                                     (F.lit(base) + F.col("id") * 1000).alias("ts"),
                                     (F.col("id") + 100000).alias("event_id"))
    out = first_seen(hot.unionByName(cold).repartition(8))
    rows = out.filter("mid = 'hot'").collect()
    assert [(r.dt, r.ts) for r in rows] == [("2024-01-01", base)]
    assert out.count() == 501


def test_anti_backfill(spark):
    t = _ms("2024-01-01 10:00:00.000")
    seen = spark.createDataFrame([("a", "2024-01-01")], "mid string, dt string")
    cand = spark.createDataFrame([("a", t, 1), ("b", t, 2), ("a", t + 86400000, 3)],
                                 "mid string, ts long, event_id long")
    out = sorted((r.mid, r.dt) for r in anti_backfill(cand, seen).collect())
    assert out == [("a", "2024-01-02"), ("b", "2024-01-01")]


def test_hours_dense_with_zero_fill(spark):
    hourly = spark.createDataFrame([("2024-01-02", "03", 5), ("2024-01-02", "17", 2)],
                                   "dt string, hr string, dau long")
    cmp_ = metrics.hour_compare(hourly, "dau").collect()
    assert len(cmp_) == 24
    by = {r.hr: (r.today, r.yesterday) for r in cmp_}
    assert by["03"] == (5, 0) and by["17"] == (2, 0) and by["00"] == (0, 0)
    series = metrics.hour_series(metrics.hour_compare(hourly, "dau"), "dau")
    assert series.count() == 48
    assert metrics.select_metric(series, "nope").count() == 0


def test_hour_json_shape(spark):
    hourly = spark.createDataFrame([("2024-01-02", "03", 5), ("2024-01-01", "03", 4)],
                                   "dt string, hr string, dau long")
    j = {r.dt: json.loads(r.json) for r in metrics.hour_json(metrics.hour_compare(hourly, "dau")).collect()}
    assert list(j["2024-01-02"]) == ["yesterday", "today"]
    assert j["2024-01-02"]["today"]["03"] == 5 and j["2024-01-02"]["yesterday"]["03"] == 4
    assert len(j["2024-01-02"]["today"]) == 24


def test_rate_null_when_yesterday_zero(spark):
    daily = spark.createDataFrame([("2024-01-02", 10), ("2024-01-03", 15)], "dt string, n long")
    out = {r.dt: r for r in metrics.day_over_day(daily, "n").collect()}
    assert out["2024-01-02"].yesterday == 0 and out["2024-01-02"].rate is None
    assert out["2024-01-03"].rate == pytest.approx(0.5)
    r = spark.range(1).select(change_rate(F.lit(5), F.lit(0)).alias("r")).first()
    assert r.r is None


def test_prev_day_strict(spark):
    assert spark.range(1).select(prev_day(F.lit("2024-03-01")).alias("d")).first().d == "2024-02-29"


def test_age_bands(spark):
    df = spark.createDataFrame([(19,), (20,), (30,), (31,)], "a int")
    out = [r.b for r in df.select(age_band("a").alias("b")).collect()]
    assert out == [AGE_BAND_LABELS[0], AGE_BAND_LABELS[1], AGE_BAND_LABELS[1], AGE_BAND_LABELS[2]]


def test_value_bins(spark):
    df = spark.createDataFrame([(0,), (99,), (100,), (599,), (600,)], "v long")
    assert [r.b for r in df.select(value_bin("v").alias("b")).collect()] == [0, 0, 1, 5, 5]


def test_share_sums_to_one(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "name string, value long")
    out = {r.name: r.pct for r in df.withColumn("pct", share_pct("value")).collect()}
    assert out == {"a": 0.25, "b": 0.75}


def test_terms_count_document_once(spark):
    docs = spark.createDataFrame([(["x", "x", "y"],), (["x"],)], "a array<string>")
    out = {r.term: r.doc_count for r in array_terms(docs, "a", k=None).collect()}
    assert out == {"x": 2, "y": 1}


def test_terms_top_k_order(spark):
    docs = spark.createDataFrame([(["b"],), (["a"],), (["c"],), (["c"],)], "a array<string>")
    assert [r.term for r in array_terms(docs, "a", k=2).collect()] == ["c", "a"]


def test_upsert_replay_keeps_last_once(spark, tmp_path):
    path = str(tmp_path / "t")
    b1 = spark.createDataFrame([(1, 10, "old")], "key long, event_id long, v string")
    b2 = spark.createDataFrame([(1, 20, "new")], "key long, event_id long, v string")
    write_batch(b1, path, 1)
    write_batch(b2, path, 2)
    write_batch(b2, path, 2)  # replay
    out = read_upsert_table(spark, path, "key", ["event_id"]).collect()
    assert len(out) == 1 and out[0].v == "new" and out[0].batch_id == 2


def test_latest_by_key_prefers_batch_then_order(spark):
    df = spark.createDataFrame([(1, 1, 99, "a"), (1, 2, 5, "b"), (2, 1, 1, "c")],
                               "key long, batch_id long, event_id long, v string")
    out = {r.key: r.v for r in latest_by_key(df, "key", ["event_id"]).collect()}
    assert out == {1: "b", 2: "c"}


def test_jdbc_options_partitioned_read():
    from daypulse.sources.tables import jdbc_options
    o = jdbc_options("jdbc:mysql://h/db", "orders", "o_orderkey", 1, 1000, 16, user="u")
    assert o["partitionColumn"] == "o_orderkey" and o["numPartitions"] == "16"
    assert o["lowerBound"] == "1" and o["upperBound"] == "1000" and o["user"] == "u"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", "k")


def test_read_table_sees_appended_rows(spark, tmp_path):
    from daypulse.sources.tables import read_table
    from tests.conftest import SF001
    base = str(tmp_path)
    spark.range(5).write.parquet(f"{base}/nation.parquet")
    assert read_table(spark, "nation", base).count() == 5
    spark.range(7).write.mode("append").parquet(f"{base}/nation.parquet")
    assert read_table(spark, "nation", base).count() == 12
    assert read_table(spark, "nation", SF001, columns=["n_name"]).columns == ["n_name"]


def test_compact_keeps_current_view(spark, tmp_path):
    from daypulse.operators.upsert import compact
    path, out = str(tmp_path / "t"), str(tmp_path / "c")
    write_batch(spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "key long, event_id long, v string"), path, 1)
    write_batch(spark.createDataFrame([(1, 2, "c")], "key long, event_id long, v string"), path, 2)
    compact(spark, path, "key", ["event_id"], out)
    got = {r.key: r.v for r in read_upsert_table(spark, out, "key", ["event_id"]).collect()}
    assert got == {1: "c", 2: "b"}


def test_hourly_active_approx_close_to_exact(spark):
    from daypulse.sources import testdata as td
    from tests.conftest import SF001
    sl = td.start_logs(spark, SF001)
    exact = {(r.dt, r.hr): r.active for r in metrics.hourly_active(sl).collect()}
    approx = {(r.dt, r.hr): r.active for r in metrics.hourly_active(sl, approx=True).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - exact[k]) <= max(1, 0.1 * exact[k]) for k in exact)


def test_api_helpers(spark, tmp_path):
    from daypulse.functions import offset_key, today_string
    from daypulse.operators import detail
    from daypulse.sources.tables import day_partition
    from tests.conftest import SF001
    r = spark.range(1).select(offset_key(F.lit("app_start"), F.lit("g")).alias("k"),
                              today_string().alias("d")).first()
    assert r.k == "app_start:g" and len(r.d) == 10
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "dt string, v long")
    assert [x.v for x in day_partition(df, "2024-01-02").collect()] == [2]
    assert day_partition(df, None).count() == 2
    bundle = detail.sale_detail_bundle(spark, SF001, detail.Search.of(keyword="red"), 1, 10)
    assert set(bundle) == {"total", "stat_age", "stat_category", "detail"}
    assert bundle["detail"].count() == 10
    assert bundle["stat_age"].agg(F.sum("value")).first()[0] == bundle["total"].first().total


def test_upsert_day_first_layout_and_day_read(spark, tmp_path):
    import os
    path = str(tmp_path / "u")
    schema = "key long, event_id long, dt string"
    write_batch(spark.createDataFrame([(1, 1, "2024-01-01"), (2, 2, "2024-01-02")], schema), path, 1, ["dt"])
    write_batch(spark.createDataFrame([(2, 3, "2024-01-02")], schema), path, 2, ["dt"])
    write_batch(spark.createDataFrame([(2, 3, "2024-01-02")], schema), path, 2, ["dt"])  # replay
    assert sorted(os.listdir(os.path.join(path, "dt=2024-01-02"))) == ["batch_id=1", "batch_id=2"]
    day = read_upsert_table(spark, path, ["dt", "key"], ["event_id"], dt="2024-01-02").collect()
    assert [(r.key, r.event_id, r.batch_id) for r in day] == [(2, 3, 2)]
