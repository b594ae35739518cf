"""Mergeable counts, the keyword index, the rank directory and offset continuity against brute force."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from daypulse.operators import continuity, detail, distinct, keyword, metrics
from daypulse.sources import testdata as td
from daypulse.sources.tables import read_table
from tests.conftest import SF0001

DAY = 86_400_000


def _logs(spark, n=600, devices=70, days=9, seed=1):
    rng = random.Random(seed)
    rows = [(f"d{rng.randint(0, devices)}", rng.randrange(days) * DAY + rng.randrange(DAY)) for _ in range(n)]
    return spark.createDataFrame(rows + [(None, 5)], "mid string, ts long"), [r for r in rows]


def test_numbers_are_kept_and_dense(spark):
    logs, _ = _logs(spark)
    first = distinct.device_numbers(logs.filter("ts < 200000000"), slots=4).cache()
    both = distinct.device_numbers(logs, known=first, slots=4)
    old, new = ({r.mid: r.num for r in x.collect()} for x in (first, both))
    assert {m: new[m] for m in old} == old and len(set(new.values())) == len(new)
    assert set(new) == {r.mid for r in logs.filter("mid is not null").select("mid").distinct().collect()}
    slots = {}
    for v in new.values():
        slots.setdefault(v // distinct.SLOT, set()).add(v % distinct.SLOT)
    assert all(x == set(range(len(x))) for x in slots.values())
    assert distinct.device_numbers(logs.limit(0)).count() == 0


@pytest.mark.parametrize("slots", [1, 16])
def test_bitmaps_count_any_span(spark, slots):
    logs, rows = _logs(spark)
    bitmaps = distinct.hour_bitmaps(logs, distinct.device_numbers(logs, slots=slots)).cache()
    hour = {(r.dt, r.hr): r.devices for r in distinct.devices_in(bitmaps, "dt", "hr").collect()}
    want = {}
    for m, t in rows:
        want.setdefault((t // DAY, t % DAY // 3_600_000), set()).add(m)
    assert sorted(hour.values()) == sorted(map(len, want.values())) and len(hour) == len(want)
    per_day = {r.dt: r.devices for r in distinct.devices_in(bitmaps, "dt").collect()}
    assert per_day == {r.dt: r.dau for r in metrics.dau_total(logs).collect()}
    assert distinct.devices_in(bitmaps).first().devices == len({m for m, _ in rows})
    trailing = {r.dt: (r.active_1d, r.active_3d) for r in distinct.trailing_devices(bitmaps, (1, 3)).collect()}
    by_day = {}
    for m, t in rows:
        by_day.setdefault(t // DAY, set()).add(m)
    span = lambda d, n: len(set().union(*[by_day.get(d - k, set()) for k in range(n)]))
    assert sorted(trailing.values()) == sorted((span(d, 1), span(d, 3)) for d in by_day)


def test_bitmaps_of_many_devices_cover_several_buckets(spark):
    logs = spark.range(100_000).selectExpr("concat('m', id) as mid", "id % 86400000 as ts")
    numbers = distinct.device_numbers(logs, slots=1)
    bitmaps = distinct.hour_bitmaps(logs, numbers)
    assert distinct.devices_in(bitmaps, "dt").first().devices == 100_000
    assert bitmaps.select("bucket").distinct().count() == 4


def test_sketches_stay_within_their_error(spark):
    logs = spark.range(60_000).selectExpr("concat('m', id % 20000) as mid", "(id % 48) * 3600000 as ts")
    sketches = distinct.hour_sketches(logs)
    about = distinct.devices_about(sketches).first().devices
    assert abs(about - 20_000) <= 0.05 * 20_000
    assert sketches.count() == 48


def test_keyword_index_equals_the_scan(spark):
    parts = read_table(spark, "part", SF0001).select("p_partkey", "p_name")
    odd = spark.createDataFrame([(10**7, None), (10**7 + 1, ""), (10**7 + 2, "é Ünï aaaa"), (10**7 + 3, "x")], parts.schema)
    parts = parts.unionByName(odd).cache()
    index = keyword.build_index(parts, "p_partkey", "p_name").cache()
    words = ["e", "x", "re", "red", "blu", "blue", "antique", " ", "d b", "Ünï", "aaaa", "aaaaa", "nothing like it", "E"]
    for word in words:
        got = {r.p_partkey for r in keyword.matching(parts, index, word, "p_partkey", "p_name").collect()}
        want = {r.p_partkey for r in parts.filter(F.lower("p_name").contains(word.lower())).collect()}
        assert got == want, word
    both = keyword.matches_of_all(spark, parts, index, words, "p_partkey", "p_name")
    counts = {r.keyword: r["count"] for r in both.groupBy("keyword").count().collect()}
    assert counts == {w: n for w in words if (n := parts.filter(F.lower("p_name").contains(w.lower())).count())}


def test_stored_index_reads_the_keywords_buckets_only(spark):
    parts = read_table(spark, "part", SF0001).select("p_partkey", "p_name")
    table = "keyword_index_test"
    keyword.store_index(keyword.build_index(parts, "p_partkey", "p_name"), table, 32, path=tempfile.mkdtemp())
    index = spark.table(table)
    scan = keyword.candidates(index, "blue")._jdf.queryExecution().sparkPlan().collectLeaves().apply(0)
    assert scan.optionalBucketSet().get().cardinality() <= 2  # of 32
    search = detail.Search.of(keyword="blue")
    page = lambda **kw: list(map(tuple, detail.sale_detail_page(spark, SF0001, search, 2, 10, **kw).collect()))
    scan = page()
    assert scan and scan == list(map(tuple, detail.sale_detail_jump(spark, SF0001, search, 2, 10, index=index).collect()))
    spark.sql(f"DROP TABLE {table}")


@pytest.mark.parametrize("width", [1, 64, 10**9])
def test_jump_equals_offset_on_every_kind_of_page(spark, width):
    for search in (detail.Search(), detail.Search.of(keyword="red"), detail.Search.of(date="1996-08-12")):
        total = detail.sale_detail_total(spark, SF0001, search).first().total
        last = max(1, -(-total // 50))
        for page in sorted({1, last // 2 or 1, last, last + 1}):
            want = list(map(tuple, detail.sale_detail_page(spark, SF0001, search, page, 50).collect()))
            got = list(map(tuple, detail.sale_detail_jump(spark, SF0001, search, page, 50, width=width).collect()))
            assert got == want, (search, page)
    with pytest.raises(ValueError):
        detail.sale_detail_jump(spark, SF0001, page=0)


def test_directory_counts_every_line_once(spark):
    t = detail.DetailTables(spark, SF0001)
    rows = detail.page_directory(t, 100).orderBy("dt", "block").collect()
    assert sum(r.n for r in rows) == read_table(spark, "lineitem", SF0001).count()
    at = 0
    for r in rows:
        assert r.before == at
        at += r.n


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_gaps_and_replay_close_the_archive(spark, block):
    rng = random.Random(block)
    whole = [(p, o) for p in range(3) for o in range(400)]
    lost = {x for x in whole if rng.random() < 0.1 or 100 <= x[1] < 140 and x[0] == 1}
    lost -= {(p, o) for p in range(3) for o in (0, 399)}
    kept = [x for x in whole if x not in lost] + [(0, 0), (0, 0), (2, 399)]
    source = spark.createDataFrame(whole, "partition int, offset long")
    archive = spark.createDataFrame(kept + [(1, None)], "partition int, offset long")
    report = continuity.offset_report(archive, block).cache()
    holes = {(r["partition"], o) for r in report.filter("kind = 'missing'").collect() for o in range(r["first"], r["last"] + 1)}
    assert holes == lost
    assert report.filter("kind = 'missing'").agg(F.sum("n")).first()[0] == len(lost)
    again = {(r["partition"], r["first"], r["n"]) for r in report.filter("kind = 'repeated'").collect()}
    assert again == {(0, 0, 3), (2, 399, 2)}
    replayed = continuity.replay(source, report, block)
    assert sorted(map(tuple, replayed.collect())) == sorted(lost)
    closed = continuity.offset_report(archive.unionByName(replayed), block)
    assert closed.filter("kind = 'missing'").count() == 0


def test_numbers_in_cards_are_whole_counts(spark):
    import json
    cards = metrics.totals_json(metrics.cards(metrics.daily_summary(td.activity(spark, SF0001)))).collect()
    for r in cards:
        parsed = json.loads(r.json)
        assert [c["id"] for c in parsed] == [metrics.CARD_DAU[0], metrics.CARD_NEW_MID[0], metrics.CARD_ORDER_AMOUNT[0]]
        assert isinstance(parsed[0]["value"], int) and isinstance(parsed[1]["value"], int)
        assert f'"value":{parsed[0]["value"]}}}' in r.json


def test_upsert_table_is_merged_in_place(spark, monkeypatch):
    import os

    from daypulse.operators import upsert
    path = tempfile.mkdtemp()
    frame = lambda rows: spark.createDataFrame(rows, "key string, at long, v int")
    for n, rows in enumerate([[("a", 1, 1), ("b", 1, 2)], [("a", 2, 3)], [("c", 1, 4), ("b", 0, 5)]]):
        upsert.write_batch(frame(rows), path, n)
    read = lambda: sorted((r.key, r.at, r.v) for r in upsert.read_upsert_table(spark, path, "key", ["at"]).collect())
    want = [("a", 2, 3), ("b", 0, 5), ("c", 1, 4)]
    assert read() == want
    real = upsert.remove

    def stop(*a):
        raise OSError("stopped")

    monkeypatch.setattr(upsert, "remove", stop)
    with pytest.raises(OSError):
        upsert.compact_in_place(spark, path, "key", ["at"])
    assert read() == want
    monkeypatch.setattr(upsert, "remove", real)
    upsert.compact_in_place(spark, path, "key", ["at"])
    assert read() == want and len(os.listdir(path)) == 1
    upsert.write_batch(frame([("a", 0, 9)]), path, 3)  # a later batch replaces merged rows
    assert read() == [("a", 0, 9), *want[1:]]
    upsert.compact_in_place(spark, path, "key", ["at"])
    assert read() == [("a", 0, 9), *want[1:]]
