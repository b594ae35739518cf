"""Structured Streaming: stream result = batch result, replay, late data, routing sinks."""

import json
import os
import tempfile
import time
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from daypulse.operators.dedup import first_seen
from daypulse.plans.catalog import q_dau_detail
from daypulse.sources import applog
from daypulse.sources import testdata as td
from daypulse.streaming import dau_stream as ds
from daypulse.streaming.sources import LINE_SCHEMA, kafka_options, line_file_stream
from tests.conftest import SF0001


def _is_json(text):
    try:
        json.loads(text)
        return True
    except ValueError:
        return False


def _scratch():
    return tempfile.mkdtemp(prefix="daypulse-test-")


def _write_line_files(rows, folder, per_file):
    """rows: list of dicts (partition, offset, timestamp, value); one parquet file per chunk."""
    os.makedirs(folder, exist_ok=True)
    schema = pa.schema([("partition", pa.int32()), ("offset", pa.int64()),
                        ("timestamp", pa.timestamp("us", tz="UTC")), ("value", pa.string())])
    now = time.time() - 10_000
    for i in range(0, len(rows), per_file):
        chunk = rows[i:i + per_file]
        table = pa.Table.from_pylist(chunk, schema=schema)
        path = os.path.join(folder, f"part-{i // per_file:05d}.parquet")
        pq.write_table(table, path)
        os.utime(path, (now + i, now + i))


@pytest.fixture(scope="module")
def raw_rows(spark):
    pdf = td.raw_logs(spark, SF0001).orderBy("offset").toPandas()
    return pdf.to_dict("records")


@pytest.fixture(scope="module")
def line_dir(raw_rows):
    folder = os.path.join(_scratch(), "in")
    _write_line_files(raw_rows, folder, per_file=100)
    return folder


def test_kafka_options_shape():
    o = kafka_options("b:9092", "app_start", "dau_group")
    assert o["subscribe"] == "app_start" and o["startingOffsets"] == "latest"
    o = kafka_options("b:9092", "t", starting_offsets='{"t":{"0":5}}', max_offsets_per_trigger=1000)
    assert o["startingOffsets"] == '{"t":{"0":5}}' and o["maxOffsetsPerTrigger"] == "1000"


def test_router_stream_routes_archives_and_records_offsets(spark, line_dir, raw_rows):
    out, ckpt = _scratch(), _scratch()
    q = ds.run_router_stream(line_file_stream(spark, line_dir), out, ckpt, topic="app_log",
                             trigger="availableNow")
    q.awaitTermination(300)
    lines = spark.read.parquet(os.path.join(out, "lines"))
    got = {r["route"]: r["count"] for r in lines.groupBy("route").count().collect()}
    raw = td.raw_logs(spark, SF0001)
    want = {r["route"]: r["count"] for r in applog.route_logs(raw).groupBy("route").count().collect()}
    assert got == want and set(got) == {"start", "event", "reject"}
    archived = spark.read.text(os.path.join(out, "archive"))
    accepted = [r["value"] for r in raw_rows if _is_json(r["value"])]
    assert len(accepted) < len(raw_rows)  # the malformed lines are not archived
    assert sorted(r[0] for r in archived.collect()) == sorted(accepted)
    counts = spark.read.parquet(os.path.join(out, "route_counts")).groupBy("route").sum("lines")
    assert {r[0]: r[1] for r in counts.collect()} == want  # rejects counted per batch
    prog = spark.read.parquet(os.path.join(out, "progress"))
    from daypulse.operators.upsert import latest_offsets
    latest = {r["partition"]: r["until_offset"] for r in latest_offsets(prog).collect()}
    want_off = {}
    for r in raw_rows:
        want_off[r["partition"]] = max(want_off.get(r["partition"], 0), r["offset"] + 1)
    assert latest == want_off


def test_dau_stream_first_event_equals_batch(spark, line_dir):
    table, gold, ckpt = _scratch(), _scratch(), _scratch()
    q = ds.run_dau_stream(line_file_stream(spark, line_dir), table, ckpt,
                          mode="first_event", gold_path=gold, trigger="availableNow")
    q.awaitTermination(300)
    facts = ds.read_facts(spark, table).select(*applog.FACT_COLUMNS)
    batch = q_dau_detail(spark, SF0001)
    assert facts.count() == batch.count()
    assert facts.exceptAll(batch).count() == 0 and batch.exceptAll(facts).count() == 0
    # Observed counts reached the progress report
    prog = q.recentProgress
    seen_in = 0
    for p in prog:
        om = p["observedMetrics"] or {}
        if "dedup_in" in om:
            seen_in += om["dedup_in"]["rows"]
    assert seen_in == batch.sparkSession.read.parquet(
        f"{SF0001}/events.parquet").filter("event_type = 'view'").count()
    # Gold tables equal the batch metrics
    gold_total = spark.read.parquet(os.path.join(gold, "dau_total")).select("dt", "dau")
    from daypulse.plans.catalog import q_dau_hour, q_dau_total
    assert gold_total.exceptAll(q_dau_total(spark, SF0001)).count() == 0
    assert q_dau_total(spark, SF0001).exceptAll(gold_total).count() == 0
    gold_hour = spark.read.parquet(os.path.join(gold, "dau_hour")).select("dt", "hr", "dau")
    assert gold_hour.exceptAll(q_dau_hour(spark, SF0001)).count() == 0

    # replay: same checkpoint, no new input -> nothing changes
    before = sorted(map(tuple, facts.collect()))
    q2 = ds.run_dau_stream(line_file_stream(spark, line_dir), table, ckpt,
                           mode="first_event", gold_path=gold, trigger="availableNow")
    q2.awaitTermination(300)
    assert sorted(map(tuple, ds.read_facts(spark, table).select(*applog.FACT_COLUMNS).collect())) == before


def test_dau_stream_first_arrival_keeps_device_day_set(spark, line_dir):
    table, ckpt = _scratch(), _scratch()
    q = ds.run_dau_stream(line_file_stream(spark, line_dir), table, ckpt,
                          mode="first_arrival", trigger="availableNow")
    q.awaitTermination(300)
    facts = ds.read_facts(spark, table)
    keys = facts.select("mid", "dt")
    want = first_seen(td.start_logs(spark, SF0001)).select("mid", "dt")
    assert keys.count() == want.count()
    assert keys.exceptAll(want).count() == 0


def test_batch_rewrite_is_idempotent(spark):
    table = _scratch()
    rows = [("1", "1", "0", "view", "3", "2024-01-01", "10", "00", 1704103200000)]
    df = spark.createDataFrame(rows, applog.FACT_SCHEMA)
    writer = ds.DauBatchWriter(table)
    writer(df, 1)
    writer(df, 1)  # replayed batch 1
    assert ds.read_facts(spark, table).count() == 1


# --- micro fixtures (FIXTURES.md §4) -------------------------------------------------

def _start_line(mid, ms, offset, broker_ms=None):
    return {"partition": 0, "offset": offset,
            "timestamp": None if broker_ms is None else datetime.fromtimestamp(broker_ms / 1000, timezone.utc),
            "value": json.dumps({"common": {"mid": mid, "uid": mid, "ar": "1", "ch": "c", "vc": "v"},
                                 "start": {"entry": "icon"}, "ts": ms})}


def _ms(s):
    return int(datetime.strptime(s, "%Y-%m-%d %H:%M:%S.%f").replace(tzinfo=timezone.utc).timestamp() * 1000)


def _run_batches(spark, batches, mode, **kw):
    """``batches``: lists of (device, event time[, broker time]); without one the broker is in time."""
    folder = os.path.join(_scratch(), "in")
    rows, off = [], 0
    for b in batches:
        for mid, t, *broker in b:
            rows.append(_start_line(mid, _ms(t), off, _ms(broker[0] if broker else t)))
            off += 1
    # one file per micro-batch
    os.makedirs(folder, exist_ok=True)
    i = 0
    now = time.time() - 10_000
    schema = pa.schema([("partition", pa.int32()), ("offset", pa.int64()),
                        ("timestamp", pa.timestamp("us", tz="UTC")), ("value", pa.string())])
    for n, b in enumerate(batches):
        chunk = rows[i:i + len(b)]
        i += len(b)
        path = os.path.join(folder, f"part-{n:05d}.parquet")
        pq.write_table(pa.Table.from_pylist(chunk, schema=schema), path)
        os.utime(path, (now + n, now + n))
    table, ckpt = _scratch(), _scratch()
    q = ds.run_dau_stream(line_file_stream(spark, folder), table, ckpt, mode=mode,
                          trigger="availableNow", quarantine_path=table + "_q", **kw)
    q.awaitTermination(300)
    assert q.exception() is None
    return ds.read_facts(spark, table).select("mid", "dt", "hr", "mi").collect(), q, table


@pytest.mark.parametrize("mode", ["first_event", "first_arrival"])
def test_midnight_gives_two_days(spark, mode):
    out, *_ = _run_batches(spark, [[("d1", "2024-01-01 23:59:59.999"), ("d1", "2024-01-02 00:00:00.000")]], mode)
    assert sorted((r.dt, r.hr) for r in out) == [("2024-01-01", "23"), ("2024-01-02", "00")]


@pytest.mark.parametrize("mode", ["first_event", "first_arrival"])
def test_repeat_launches_one_row_per_day(spark, mode):
    batches = [[("d1", "2024-01-01 00:05:00.000")],
               [("d2", "2024-01-01 08:00:00.000"), ("d3", "2024-01-01 09:00:00.000"),
                ("d4", "2024-01-01 10:00:00.000")],
               [("d1", "2024-01-01 11:00:00.000")], [("d1", "2024-01-01 12:00:00.000")]]
    out, *_ = _run_batches(spark, batches, mode)
    d1 = [r for r in out if r.mid == "d1"]
    assert len(d1) == 1 and d1[0].hr == "00"


def test_disorder_first_event_keeps_earliest_hour(spark):
    batches = [[("d1", "2024-01-01 08:00:00.000")], [("d1", "2024-01-01 07:00:00.000")],
               [("d1", "2024-01-01 06:00:00.000")], [("d1", "2024-01-01 09:00:00.000")]]
    out, *_ = _run_batches(spark, batches, "first_event")
    assert [(r.dt, r.hr) for r in out] == [("2024-01-01", "06")]


def test_disorder_first_arrival_keeps_one_row(spark):
    batches = [[("d1", "2024-01-01 08:00:00.000")], [("d1", "2024-01-01 07:00:00.000")]]
    out, *_ = _run_batches(spark, batches, "first_arrival")
    assert [(r.dt, r.hr) for r in out] == [("2024-01-01", "08")]


@pytest.mark.parametrize("mode", ["first_event", "first_arrival"])
def test_late_and_future_rows_lose_nothing(spark, mode):
    """One clock a month ahead, rows one to nine days late: the batch result plus a quarantine."""
    now = "2024-01-10 12:00:00.000"
    batches = [
        [("a", "2024-01-10 10:00:00.000"), ("bad", "2024-02-10 10:00:00.000", now)],
        [("n1", "2024-01-10 11:00:00.000")],
        [("n2", "2024-01-10 12:00:00.000"), ("y", "2024-01-09 12:00:00.000", now)],
        [("n3", "2024-01-10 12:30:00.000"), ("old", "2024-01-07 12:00:00.000", now)],
        [("n4", "2024-01-10 13:00:00.000"), ("old", "2024-01-07 11:00:00.000", now),
         ("old", "2024-01-07 13:00:00.000", now), ("older", "2024-01-01 13:00:00.000", now)],
        [("y", "2024-01-09 13:00:00.000", now), ("a", "2024-01-10 14:00:00.000")],
    ]
    out, q, table = _run_batches(spark, batches, mode)
    want = {}
    for b in batches:
        for mid, t, *_ in b:
            if mid != "bad":
                key = (mid, t[:10])
                want[key] = min(want.get(key, "99"), t[11:13])
    assert {(r.mid, r.dt): r.hr for r in out} == want and len(out) == len(want)
    quarantine = spark.read.parquet(table + "_q")
    assert [r.mid for r in quarantine.select("mid").collect()] == ["bad"]
    aside = [p["observedMetrics"]["aside"] for p in q.recentProgress if "aside" in (p["observedMetrics"] or {})]
    assert sum(x["late"] for x in aside) == 4 and sum(x["future"] for x in aside) == 1
    dropped = sum(sum(o.get("numRowsDroppedByWatermark", 0) for o in p["stateOperators"])
                  for p in q.recentProgress)
    assert dropped == 0


def test_dau_job_records_its_own_offsets(spark, line_dir, raw_rows, tmp_path):
    from daypulse.operators.upsert import latest_offsets
    from daypulse.streaming.sources import resume_kafka_options
    prog = str(tmp_path / "progress")
    q = ds.run_dau_stream(line_file_stream(spark, line_dir), _scratch(), _scratch(),
                          trigger="availableNow", progress_path=prog)
    q.awaitTermination(300)
    want = {}
    for r in raw_rows:
        want[r["partition"]] = max(want.get(r["partition"], 0), r["offset"] + 1)
    got = latest_offsets(ds.read_progress(spark, prog)).collect()
    assert {r["partition"]: r.until_offset for r in got} == want
    assert {(r.topic, r.grp) for r in got} == {("app_start", "dau_group")}
    o = resume_kafka_options(spark, prog, "b:9092", "app_start", "dau_group")
    assert json.loads(o["startingOffsets"]) == {"app_start": {str(k): v for k, v in want.items()}}


def test_streams_need_a_name_or_a_checkpoint(spark, line_dir):
    lines = line_file_stream(spark, line_dir)
    for run in (lambda: ds.run_dau_stream(lines, _scratch()),
                lambda: ds.run_router_stream(lines, _scratch(), topic="app_log"),
                lambda: ds.run_launches_hourly_stream(lines, _scratch())):
        with pytest.raises(ValueError):
            run()


def test_hourly_stream_counts_late_rows_and_compacts(spark):
    folder, table = os.path.join(_scratch(), "in"), _scratch()
    now = _ms("2024-01-10 12:00:00.000")
    times = ["2024-01-10 10:00:00.000", "2024-01-10 10:30:00.000", "2024-01-01 09:00:00.000",
             "2024-02-10 09:00:00.000", "2024-01-10 10:40:00.000", "2024-01-01 09:10:00.000"]
    _write_line_files([_start_line("d", _ms(t), i, now) for i, t in enumerate(times)], folder, per_file=1)
    q = ds.run_launches_hourly_stream(line_file_stream(spark, folder), table, _scratch(), trigger="availableNow")
    q.awaitTermination(300)
    want = {("2024-01-10", "10"): 3, ("2024-01-01", "09"): 2}
    days = ["2024-01-01", "2024-01-10", "2024-03-01"]
    read = lambda: {(r.dt, r.hr): r.launches for r in ds.read_hourly(spark, table, days).collect()}
    assert read() == want
    ds.compact_hourly_days(spark, table, days)
    assert read() == want
    assert len(os.listdir(os.path.join(table, "dt=2024-01-10"))) == 1


def test_launches_hourly_stream_equals_batch(spark, line_dir):
    from daypulse.plans.catalog import q_launches_hourly
    parsed = applog.parse_start_logs(line_file_stream(spark, line_dir), keep=("offset",))
    agg = ds.launches_hourly_stream(parsed)
    name = "launches_hourly_test"
    q = (agg.writeStream.outputMode("complete").format("memory").queryName(name)
         .option("checkpointLocation", _scratch()).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.table(name)
    want = q_launches_hourly(spark, SF0001)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_starting_offsets_json_for_resume(spark):
    from daypulse.operators.upsert import latest_offsets, starting_offsets_json
    prog = spark.createDataFrame(
        [("app_start", "g", 0, 1, 10), ("app_start", "g", 0, 2, 25), ("app_start", "g", 1, 1, 7)],
        "topic string, grp string, partition int, batch_id long, until_offset long")
    j = json.loads(starting_offsets_json(latest_offsets(prog)).first().json)
    assert j == {"app_start": {"0": 25, "1": 7}}
    o = kafka_options("b:9092", "app_start", starting_offsets=json.dumps(j))
    assert json.loads(o["startingOffsets"]) == j


def test_default_checkpoint_under_shared_dir(spark):
    from daypulse.session import checkpoint_subdir
    base = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_subdir(spark, "streams/dau").startswith(base)


def test_launches_hourly_update_stream_upserts_to_batch_result(spark, line_dir):
    from daypulse.plans.catalog import q_launches_hourly
    table = _scratch()
    q = ds.run_launches_hourly_stream(line_file_stream(spark, line_dir), table, _scratch(),
                                      trigger="availableNow")
    q.awaitTermination(300)
    got = ds.read_hourly(spark, table).select("dt", "hr", "launches")
    want = q_launches_hourly(spark, SF0001)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_split_routes_three_frames(spark):
    from daypulse.sources.testdata import raw_logs
    start, event, reject = applog.split_routes(raw_logs(spark, SF0001), keep=("offset",))
    ev = spark.read.parquet(f"{SF0001}/events.parquet")
    assert start.count() == ev.filter("event_type = 'view'").count()
    assert reject.count() == ev.filter("event_type = 'error'").count()
    assert start.count() + event.count() + reject.count() == ev.count()


def test_source_stream_files_and_progress_reader(spark, line_dir):
    from daypulse.streaming.sources import source_stream
    s = source_stream(spark, "files", path=line_dir)
    assert s.isStreaming and s.columns == ["partition", "offset", "timestamp", "value"]
    with pytest.raises(ValueError):
        source_stream(spark, "socket")
    out = _scratch()
    q = ds.run_router_stream(s, out, _scratch(), topic="app_log", trigger="availableNow")
    q.awaitTermination(300)
    prog = ds.read_progress(spark, os.path.join(out, "progress"))
    assert set(prog.columns) == {"topic", "grp", "partition", "epoch", "run", "batch_id", "until_offset"}
    assert prog.select("batch_id").distinct().count() == len(os.listdir(line_dir))


def test_resume_options_from_progress(spark, tmp_path):
    from daypulse.streaming.sources import resume_kafka_options
    empty = str(tmp_path / "none")
    assert resume_kafka_options(spark, empty, "b:9092", "app_start", "g")["startingOffsets"] == "latest"
    prog = str(tmp_path / "progress")
    spark.createDataFrame(
        [("app_start", "g", 0, 1, 10), ("app_start", "g", 0, 2, 25), ("app_start", "g", 1, 2, 7),
         ("other", "g", 0, 9, 99)],
        "topic string, grp string, partition int, batch_id long, until_offset long").write.parquet(prog)
    o = resume_kafka_options(spark, prog, "b:9092", "app_start", "g")
    assert json.loads(o["startingOffsets"]) == {"app_start": {"0": 25, "1": 7}}


def test_facts_keep_processing_day_column(spark):
    table = _scratch()
    rows = [("1", "1", "0", "view", "3", "2024-01-01", "10", "00", 1704103200000)]
    ds.DauBatchWriter(table)(spark.createDataFrame(rows, applog.FACT_SCHEMA), 3)
    r = ds.read_facts(spark, table).first()
    assert r.dt == "2024-01-01" and r.ingest_dt == datetime.now(timezone.utc).date().isoformat()


def test_first_event_stream_pre_aggregates_before_state(spark, line_dir):
    """T4 collapses a hot device map-side: partial min below the state store."""
    import contextlib
    import io
    q = ds.run_dau_stream(line_file_stream(spark, line_dir), _scratch(), _scratch(),
                          mode="first_event", trigger="availableNow")
    q.awaitTermination(300)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain()
    plan = buf.getvalue()
    assert "StateStoreSave" in plan
    after_state = plan[plan.index("StateStoreRestore"):]
    assert "partial_min" in after_state, plan


def test_fact_layout_is_day_first_and_day_reads_prune(spark):
    table = _scratch()
    w = ds.DauBatchWriter(table)
    rows = lambda d, mid: [(mid, mid, "0", "view", "3", d, "10", "00", 1704103200000)]
    w(spark.createDataFrame(rows("2024-01-01", "a") + rows("2024-01-02", "b"), applog.FACT_SCHEMA), 1)
    w(spark.createDataFrame(rows("2024-01-02", "c"), applog.FACT_SCHEMA), 2)
    assert sorted(os.listdir(os.path.join(table, "dt=2024-01-02"))) == ["batch_id=1", "batch_id=2"]
    one = ds.read_facts(spark, table, days=["2024-01-01"])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "2024-01-01" in plan
    assert [r.mid for r in one.collect()] == ["a"]
    assert sorted(r.mid for r in ds.read_facts(spark, table).collect()) == ["a", "b", "c"]


def test_router_layout_route_and_day_first(spark, line_dir):
    out = _scratch()
    q = ds.run_router_stream(line_file_stream(spark, line_dir), out, _scratch(), topic="app_log", trigger="availableNow")
    q.awaitTermination(300)
    routes = sorted(d for d in os.listdir(os.path.join(out, "lines")) if d.startswith("route="))
    assert routes == ["route=event", "route=reject", "route=start"]
    days = [d for d in os.listdir(os.path.join(out, "archive")) if d.startswith("ingest_dt=")]
    assert days and all(os.listdir(os.path.join(out, "archive", d))[0].startswith("batch_id=") for d in days)
    starts = spark.read.parquet(os.path.join(out, "lines", "route=start"))
    assert starts.count() == spark.read.parquet(f"{SF0001}/events.parquet").filter("event_type = 'view'").count()


def test_router_then_dau_chain_equals_batch(spark, line_dir):
    """Collector -> start topic -> DAU job: the DAU stream reads the router's start folder."""
    out = _scratch()
    q1 = ds.run_router_stream(line_file_stream(spark, line_dir), out, _scratch(), topic="app_log", trigger="availableNow")
    q1.awaitTermination(300)
    start_lines = line_file_stream(spark, os.path.join(out, "lines", "route=start"), files_per_trigger=4)
    table = _scratch()
    q2 = ds.run_dau_stream(start_lines, table, _scratch(), mode="first_event", trigger="availableNow")
    q2.awaitTermination(300)
    facts = ds.read_facts(spark, table).select(*applog.FACT_COLUMNS)
    batch = q_dau_detail(spark, SF0001)
    assert facts.count() == batch.count()
    assert facts.exceptAll(batch).count() == 0


def test_compact_final_day_keeps_current_rows(spark):
    table = _scratch()
    w = ds.DauBatchWriter(table)
    row = lambda mid, hr, ts: (mid, mid, "0", "view", "3", "2024-01-01", hr, "00", ts)
    w(spark.createDataFrame([row("a", "10", 1704103200000), row("b", "11", 1704106800000)], applog.FACT_SCHEMA), 1)
    w(spark.createDataFrame([row("a", "09", 1704099600000)], applog.FACT_SCHEMA), 2)  # earlier launch of a
    w(spark.createDataFrame([row("c", "12", 1704110400000)], applog.FACT_SCHEMA), 3)
    before = sorted(map(tuple, ds.read_facts(spark, table).collect()))
    ds.compact_fact_days(spark, table, ["2024-01-01", "2024-01-09"])  # the second was never written
    folders = [d for d in os.listdir(os.path.join(table, "dt=2024-01-01")) if d.startswith("batch_id=")]
    assert folders == ["batch_id=-1"]
    after = sorted(map(tuple, ds.read_facts(spark, table).collect()))
    assert after == before and len(after) == 3
    # rows of a later batch join the merged ones, and merge again
    w(spark.createDataFrame([row("a", "08", 1704096000000), row("d", "13", 1704114000000)], applog.FACT_SCHEMA), 4)
    ds.compact_fact_days(spark, table, ["2024-01-01"])
    assert {r.mid: r.hr for r in ds.read_facts(spark, table).collect()} == {"a": "08", "b": "11", "c": "12", "d": "13"}


@pytest.mark.parametrize("step", ["write", "remove"])
def test_compaction_survives_a_failure(spark, monkeypatch, step):
    """A merge that stops midway changes no row, nor does the run after it."""
    table, day = _scratch(), "2024-01-01"
    w = ds.DauBatchWriter(table)
    row = lambda mid, hr, ts: (mid, mid, "0", "view", "3", day, hr, "00", ts)
    w(spark.createDataFrame([row("a", "10", 1704103200000), row("b", "11", 1704106800000)], applog.FACT_SCHEMA), 1)
    w(spark.createDataFrame([row("a", "09", 1704099600000)], applog.FACT_SCHEMA), 2)
    w(spark.createDataFrame([row("c", "12", 1704110400000)], applog.FACT_SCHEMA), 3)
    before = sorted(map(tuple, ds.read_facts(spark, table).collect()))
    if step == "write":  # part of the new folder was committed before the run stopped
        (ds.read_facts(spark, table, [day]).drop("dt").limit(1)
         .write.parquet(os.path.join(table, f"dt={day}", "batch_id=-1")))
    else:
        removed = []

        def remove_one(sp, path):
            if removed:
                raise OSError("stopped")
            removed.append(path)
            real(sp, path)

        real = ds.remove
        monkeypatch.setattr(ds, "remove", remove_one)
        with pytest.raises(OSError):
            ds.compact_fact_days(spark, table, [day])
        monkeypatch.undo()
    assert sorted(map(tuple, ds.read_facts(spark, table).collect())) == before
    ds.compact_fact_days(spark, table, [day])
    assert sorted(map(tuple, ds.read_facts(spark, table).collect())) == before
    assert len(os.listdir(os.path.join(table, f"dt={day}"))) == 1


def test_writer_merges_the_days_in_work(spark):
    table = _scratch()
    w = ds.DauBatchWriter(table, merge_every=4)
    for i in range(8):
        w(spark.createDataFrame([(str(i), str(i), "0", "v", "3", "2024-01-01", "10", "00", 1704103200000 + i)],
                                applog.FACT_SCHEMA), i)
    assert len(os.listdir(os.path.join(table, "dt=2024-01-01"))) == 1
    assert ds.read_facts(spark, table, ["2024-01-01"]).count() == 8


def test_a_day_read_lists_only_its_folder(spark):
    table = _scratch()
    w = ds.DauBatchWriter(table)
    for i in range(1, 5):
        w(spark.createDataFrame([("a", "a", "0", "v", "3", f"2024-01-0{i}", "10", "00", 1704103200000)],
                                applog.FACT_SCHEMA), i)
    files = ds.read_days(spark, table, ds.FACT_TABLE_SCHEMA, ["2024-01-02"]).inputFiles()
    assert files and all("dt=2024-01-02" in f for f in files)


def test_finalize_days_registers_and_compacts(spark, line_dir):
    from daypulse.operators import metrics
    from daypulse.operators.registry import new_devices_on
    table, reg = _scratch(), _scratch()
    q = ds.run_dau_stream(line_file_stream(spark, line_dir), table, _scratch(),
                          mode="first_event", trigger="availableNow")
    q.awaitTermination(300)
    before = sorted(map(tuple, ds.read_facts(spark, table).collect()))
    days = sorted(r.dt for r in ds.read_facts(spark, table).select("dt").distinct().collect())[:-2]
    ds.finalize_days(spark, table, reg, days)
    ds.finalize_days(spark, table, reg, days)  # re-run: idempotent
    assert sorted(map(tuple, ds.read_facts(spark, table).collect())) == before
    for d in days:
        assert len([x for x in os.listdir(os.path.join(table, f"dt={d}")) if x.startswith("batch_id=")]) == 1
    got = {r.dt: r.new_mid for r in new_devices_on(spark, reg, days).collect()}
    want = {r.dt: r.new_mid for r in metrics.new_devices(td.start_logs(spark, SF0001)).collect() if r.dt in days}
    assert got == want
