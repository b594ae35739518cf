"""Runs of a stream: restarts with a new checkpoint, crashes before the offsets, gold by changes."""

import json
import os
import random
import shutil
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from daypulse.operators import metrics
from daypulse.operators.upsert import latest_offsets
from daypulse.sources import applog
from daypulse.streaming import dau_stream as ds
from daypulse.streaming import epochs, gold
from daypulse.streaming.sources import line_file_stream, read_progress, resume_kafka_options, resume_lines
from tests.test_stream import _ms, _start_line, _write_line_files


def _scratch():
    return tempfile.mkdtemp(prefix="daypulse-restart-")


def _rows(df):
    return sorted(map(str, df.collect()))


def _lines(n, seed, days=("2024-01-09", "2024-01-10"), partitions=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        t = f"{rng.choice(days)} {rng.randint(0, 23):02d}:{rng.randint(0, 59):02d}:00.000"
        row = _start_line(f"d{rng.randint(0, n // 3)}", _ms(t), i // partitions, _ms("2024-01-10 23:59:59.000"))
        rows.append({**row, "partition": i % partitions})
        if i % 10 == 3:
            rows[-1]["value"] = "{broken"
        if i % 10 == 6:
            rows[-1]["value"] = json.dumps({"common": {"mid": "e"}, "page": {"id": i}, "ts": _ms(t)})
    return rows


def _day_files(rows, cuts):
    """One folder with all files, one with those before the stop."""
    whole, part = os.path.join(_scratch(), "in"), os.path.join(_scratch(), "in")
    _write_line_files(rows, whole, per_file=-(-len(rows) // cuts))
    shutil.copytree(whole, part)
    for name in sorted(os.listdir(part))[cuts // 2:]:
        os.remove(os.path.join(part, name))
    return whole, part


def _router(spark, folder, out, checkpoint, resume=False):
    lines = line_file_stream(spark, folder)
    if resume:
        lines = resume_lines(spark, lines, os.path.join(out, "progress"), "app_log", "router_group")
    q = ds.run_router_stream(lines, out, checkpoint, topic="app_log", trigger="availableNow")
    q.awaitTermination(300)
    assert q.exception() is None


def _router_rows(spark, out):
    lines = spark.read.parquet(os.path.join(out, "lines")).select("partition", "offset", "value", "route")
    archive = spark.read.text(os.path.join(out, "archive")).select("value")
    counts = spark.read.parquet(os.path.join(out, "route_counts")).groupBy("route").agg(F.sum("lines"))
    offsets = latest_offsets(read_progress(spark, os.path.join(out, "progress"))).select("partition", "until_offset")
    return [_rows(x) for x in (lines, archive, counts, offsets)]


def test_router_with_a_new_checkpoint_keeps_every_line_once(spark):
    rows = _lines(240, 1)
    whole, part = _day_files(rows, 6)
    unbroken, broken = _scratch(), _scratch()
    _router(spark, whole, unbroken, _scratch())
    _router(spark, part, broken, _scratch())
    _router(spark, whole, broken, _scratch(), resume=True)
    assert _router_rows(spark, broken) == _router_rows(spark, unbroken)
    assert len(_router_rows(spark, broken)[0]) == len(rows)
    epochs_seen = {r.epoch for r in read_progress(spark, os.path.join(broken, "progress")).collect()}
    assert epochs_seen == {0, 1}


def test_router_that_died_before_its_offsets_repeats_no_line(spark):
    """The last batch's rows are written, its offsets are not: the next run drops and reads them again."""
    whole, part = _day_files(_lines(240, 2), 6)
    unbroken, broken = _scratch(), _scratch()
    _router(spark, whole, unbroken, _scratch())
    _router(spark, part, broken, _scratch())
    shutil.rmtree(os.path.join(broken, "progress", "batch_id=2"))
    _router(spark, whole, broken, _scratch(), resume=True)
    assert _router_rows(spark, broken) == _router_rows(spark, unbroken)


def _dau(spark, folder, base, checkpoint, resume=False, mode="first_event"):
    lines, prog = line_file_stream(spark, folder), os.path.join(base, "progress")
    if resume:
        lines = resume_lines(spark, lines, prog, "app_start", "dau_group")
    q = ds.run_dau_stream(lines, os.path.join(base, "facts"), checkpoint, mode=mode, trigger="availableNow",
                          gold_path=os.path.join(base, "gold"), progress_path=prog, merge_every=3)
    q.awaitTermination(300)
    assert q.exception() is None


def _dau_rows(spark, base, offsets=True):
    facts = ds.read_facts(spark, os.path.join(base, "facts")).select(*applog.FACT_COLUMNS)
    g = os.path.join(base, "gold")
    day = F.col("dt").cast("string").alias("dt")
    out = [facts, spark.read.parquet(os.path.join(g, "dau_total")).select(day, "dau"),
           spark.read.parquet(os.path.join(g, "dau_hour")).select(day, "hr", "dau")]
    if offsets:
        out.append(latest_offsets(read_progress(spark, os.path.join(base, "progress"))).select("partition", "until_offset"))
    return [_rows(x) for x in out]


def test_dau_job_with_a_new_checkpoint_equals_an_unbroken_run(spark):
    whole, part = _day_files(_lines(300, 3), 6)
    unbroken, broken = _scratch(), _scratch()
    _dau(spark, whole, unbroken, _scratch())
    _dau(spark, part, broken, _scratch())
    _dau(spark, whole, broken, _scratch(), resume=True)
    assert _dau_rows(spark, broken) == _dau_rows(spark, unbroken)
    o = resume_kafka_options(spark, os.path.join(broken, "progress"), "b:9092", "app_start", "dau_group")
    assert json.loads(o["startingOffsets"]) == {"app_start": {str(p): 100 for p in range(3)}}


def test_hourly_job_with_a_new_checkpoint_equals_an_unbroken_run(spark):
    whole, part = _day_files(_lines(240, 4), 6)

    def run(folder, base, resume=False):
        lines, prog = line_file_stream(spark, folder), os.path.join(base, "progress")
        if resume:
            lines = resume_lines(spark, lines, prog, "app_start", "hourly_group")
        q = ds.run_launches_hourly_stream(lines, os.path.join(base, "hours"), _scratch(), trigger="availableNow", progress_path=prog)
        q.awaitTermination(300)
        assert q.exception() is None

    unbroken, broken = _scratch(), _scratch()
    run(whole, unbroken)
    run(part, broken)
    run(whole, broken, resume=True)
    read = lambda base: _rows(ds.read_hourly(spark, os.path.join(base, "hours")).select("dt", "hr", "launches"))
    assert read(broken) == read(unbroken)
    ds.compact_hourly_days(spark, os.path.join(broken, "hours"), ["2024-01-09", "2024-01-10"])
    assert read(broken) == read(unbroken)


def test_a_restart_from_its_checkpoint_keeps_its_epoch(spark):
    sink, first, second = _scratch(), _scratch(), _scratch()
    one = epochs.start_run(spark, first, [sink])
    assert (one.epoch, one.new) == (0, True) and one.batch(7) == 7
    assert epochs.start_run(spark, first, [sink]) == epochs.Run(0, one.run)
    two = epochs.start_run(spark, second, [sink])
    assert (two.epoch, two.new) == (1, True) and two.batch(7) == epochs.SPAN + 7
    assert epochs.known_epochs(spark, sink) == [0, 1]
    old = _scratch()  # a sink and a checkpoint from before there were epochs
    os.makedirs(os.path.join(old, "dt=2024-01-01"))
    kept = _scratch()
    open(os.path.join(kept, "metadata"), "w").close()
    assert epochs.start_run(spark, kept, [old]).epoch == 0
    assert epochs.start_run(spark, _scratch(), [old]).epoch == 1


def test_newest_offset_is_that_of_the_newest_run(spark):
    rows = [("t", "g", 0, 0, b, o) for b, o in enumerate((10, 20, 30))] + [("t", "g", 0, 1, 0, 99), ("t", "g", 1, None, 5, 7)]
    log = spark.createDataFrame(rows, "topic string, grp string, partition int, epoch long, batch_id long, until_offset long")
    assert {r["partition"]: r.until_offset for r in latest_offsets(log).collect()} == {0: 99, 1: 7}


def test_a_registry_or_log_that_cannot_be_read_raises(spark):
    from daypulse.operators.registry import read_registry
    assert read_registry(spark, os.path.join(_scratch(), "none")).count() == 0
    bad = _scratch()
    os.makedirs(os.path.join(bad, "first_dt=2024-01-01"))
    with open(os.path.join(bad, "first_dt=2024-01-01", "part-0.parquet"), "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        read_registry(spark, bad).collect()
    with open(os.path.join(bad, "progress.parquet"), "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        resume_kafka_options(spark, bad, "b:9092", "t")


# --- gold by changes ------------------------------------------------------------------------


@pytest.mark.parametrize("mode", ["first_event", "first_arrival"])
def test_gold_equals_recomputation_with_late_rows(spark, mode):
    rng = random.Random(5)
    rows, now = [], _ms("2024-01-10 12:00:00.000")
    for i in range(250):
        day = rng.choice(["2024-01-10", "2024-01-10", "2024-01-09", "2024-01-03" if i > 120 else "2024-01-10"])
        rows.append(_start_line(f"d{rng.randint(0, 40)}", _ms(f"{day} {rng.randint(0, 23):02d}:00:{rng.randint(0, 59):02d}.000"), i, now))
    folder, base = os.path.join(_scratch(), "in"), _scratch()
    _write_line_files(rows, folder, per_file=36)
    _dau(spark, folder, base, _scratch(), mode=mode)
    facts = ds.read_facts(spark, os.path.join(base, "facts"))
    got = _dau_rows(spark, base, offsets=False)
    assert got[1:] == [_rows(metrics.dau_total(facts).select("dt", "dau")), _rows(metrics.dau_hour(facts).select("dt", "hr", "dau"))]
    assert gold.recounted(spark, os.path.join(base, "gold")) == {"2024-01-03"}


def test_moved_devices_change_two_hours_and_replays_change_nothing(spark):
    g, schema = _scratch(), "mid string, dt string, hr string, prev_hr string"
    one = spark.createDataFrame([("a", "D", "10", None), ("b", "D", "10", None), ("c", "E", "05", None)], schema)
    two = spark.createDataFrame([("a", "D", "08", "10"), ("b", "D", "10", "10"), ("d", "D", "08", None)], schema)
    for frame, n in ((one, 0), (two, 1), (two, 1)):
        gold.write_changes(gold.hour_changes(frame), g, n)
        gold.fold_changes(spark, g, ["D", "E"])
    hours = {(r.dt, r.hr): r.dau for r in spark.read.parquet(os.path.join(g, "dau_hour")).collect()}
    assert hours == {("D", "08"): 2, ("D", "10"): 1, ("E", "05"): 1}
    assert {r.dt: r.dau for r in spark.read.parquet(os.path.join(g, "dau_total")).collect()} == {"D": 3, "E": 1}


def test_merged_changes_survive_a_crash(spark, monkeypatch):
    g = _scratch()
    for n in range(6):
        frame = spark.createDataFrame([(f"m{n}", "D", f"{n % 3:02d}", None)], "mid string, dt string, hr string, prev_hr string")
        gold.write_changes(gold.hour_changes(frame), g, n)
    want = _rows(gold.fold(gold.read_changes(spark, g)))
    folder = os.path.join(g, "dau_changes", "dt=D")
    calls = []
    real = gold.remove

    def stop_at_second(sp, path):
        calls.append(path)
        if len(calls) == 2:
            raise OSError("stopped")
        real(sp, path)

    monkeypatch.setattr(gold, "remove", stop_at_second)
    with pytest.raises(OSError):
        gold.merge_changes(spark, g, "D")
    monkeypatch.undo()
    gold.fold_changes(spark, g, ["D"])
    assert _rows(spark.read.parquet(os.path.join(g, "dau_hour")).select("dt", "hr", "dau")) == want
    assert _rows(gold.fold(gold.read_changes(spark, g))) == want
    assert len([n for n in os.listdir(folder) if n.startswith("batch_id=")]) == 2


def test_a_batch_reads_no_facts_for_its_gold(spark, monkeypatch):
    """In-time batches of a day that the state knows whole never recount it."""
    folder, base = os.path.join(_scratch(), "in"), _scratch()
    _write_line_files(_lines(120, 9), folder, per_file=30)
    monkeypatch.setattr(ds, "refresh_gold", lambda *a: pytest.fail("the day was recounted"))
    _dau(spark, folder, base, _scratch())
    monkeypatch.undo()
    facts = ds.read_facts(spark, os.path.join(base, "facts"))
    assert _dau_rows(spark, base)[2] == _rows(metrics.dau_hour(facts).select("dt", "hr", "dau"))
