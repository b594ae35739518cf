"""Randomised inputs checked against plain-Python recomputation."""

from collections import defaultdict
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import numpy as np
import pytest

from daypulse.operators import metrics
from daypulse.operators.dedup import first_seen

EPOCH0 = datetime(2024, 2, 27, tzinfo=timezone.utc)  # spans a leap day


def _day(ms):
    return datetime.fromtimestamp(ms / 1000, tz=timezone.utc).strftime("%Y-%m-%d")


def _hour(ms):
    return datetime.fromtimestamp(ms / 1000, tz=timezone.utc).strftime("%H")


@pytest.fixture(scope="module", params=[7, 11])
def logs(request):
    rng = np.random.default_rng(request.param)
    n = 3000
    # gappy calendar: only some days have activity; a few devices dominate
    days = rng.choice([0, 1, 2, 4, 5, 9, 10], size=n)
    ms = [int((EPOCH0 + timedelta(days=int(d))).timestamp() * 1000) + int(x)
          for d, x in zip(days, rng.integers(0, 86_400_000, size=n))]
    mids = [f"m{int(x)}" for x in np.minimum(rng.zipf(1.6, size=n), 300)]
    starts = rng.random(n) < 0.7
    amounts = [None if s else Decimal(int(a)) / 100 for s, a in zip(starts, rng.integers(1, 50_000, size=n))]
    return [(m, t, i, bool(s), a) for i, (m, t, s, a) in enumerate(zip(mids, ms, starts, amounts))]


@pytest.fixture(scope="module")
def frames(spark, logs):
    act = spark.createDataFrame(logs, "mid string, ts long, event_id long, is_start boolean, amount decimal(18,2)")
    return act, act.filter("is_start").select("mid", "ts", "event_id")


def _firsts(logs):
    best = {}
    for m, t, i, s, _ in logs:
        if s:
            k = (m, _day(t))
            if k not in best or (t, i) < best[k]:
                best[k] = (t, i)
    return best


def test_first_seen(frames, logs):
    got = {(r.mid, r.dt): (r.ts, r.event_id) for r in first_seen(frames[1]).collect()}
    assert got == _firsts(logs)


def test_hour_compare(frames, logs):
    hourly = defaultdict(int)
    for (m, d), (t, _) in _firsts(logs).items():
        hourly[(d, _hour(t))] += 1
    days = {d for d, _ in hourly}
    want = {}
    for d in days:
        prev = (datetime.strptime(d, "%Y-%m-%d") - timedelta(days=1)).strftime("%Y-%m-%d")
        for h in range(24):
            hh = f"{h:02d}"
            want[(d, hh)] = (hourly.get((d, hh), 0), hourly.get((prev, hh), 0))
    got = {(r.dt, r.hr): (r.today, r.yesterday)
           for r in metrics.hour_compare(metrics.dau_hour(first_seen(frames[1])), "dau").collect()}
    assert got == want


def test_day_over_day(frames, logs):
    dau = defaultdict(set)
    for m, t, _, s, _ in logs:
        if s:
            dau[_day(t)].add(m)
    got = {r.dt: (r.today, r.yesterday, r.rate)
           for r in metrics.day_over_day(metrics.dau_total(frames[1]), "dau").collect()}
    for d, ms in dau.items():
        prev = (datetime.strptime(d, "%Y-%m-%d") - timedelta(days=1)).strftime("%Y-%m-%d")
        y = len(dau.get(prev, ()))
        t = len(ms)
        assert got[d][:2] == (t, y)
        assert got[d][2] == (None if y == 0 else (t - y) / y)
    assert set(got) == set(dau)


def test_daily_summary_and_activity(frames, logs):
    first_day, dau, amt, days = {}, defaultdict(set), defaultdict(Decimal), set()
    for m, t, _, s, a in sorted(logs, key=lambda r: r[1]):
        d = _day(t)
        days.add(d)
        if s:
            dau[d].add(m)
            first_day.setdefault(m, d)
        else:
            amt[d] += a
    new = defaultdict(int)
    for m, d in first_day.items():
        new[d] += 1
    got = {r.dt: (r.dau, r.new_mid, r.order_amount)
           for r in metrics.daily_summary(frames[0]).collect()}
    assert set(got) == days
    for d in days:
        assert got[d][0] == len(dau.get(d, ())) and got[d][1] == new.get(d, 0)
        assert (got[d][2] or 0.0) == float(amt.get(d, Decimal(0)))
    act = {r.dt: (r.dau, r.known) for r in metrics.activity_rate(frames[1]).collect()}
    known = 0
    for d in sorted(dau):
        known += new.get(d, 0)
        assert act[d] == (len(dau[d]), known)


def test_scalar_rules_against_python(spark):
    from daypulse.functions import age_band, change_rate, value_bin
    from daypulse.functions.scalar import AGE_BAND_LABELS
    rng = np.random.default_rng(3)
    vals = [int(x) for x in rng.integers(-50, 900, size=2000)]
    prev = [int(x) for x in rng.integers(0, 5, size=2000)]
    df = spark.createDataFrame(list(zip(vals, prev)), "v long, y long")
    got = df.select("v", "y", age_band("v").alias("band"), value_bin("v").alias("bin"),
                    change_rate("v", "y").alias("rate")).collect()

    def band(a):
        return AGE_BAND_LABELS[0] if a < 20 else AGE_BAND_LABELS[1] if a <= 30 else AGE_BAND_LABELS[2]

    for r in got:
        assert r.band == band(r.v)
        assert r.bin == max(0, min(r.v // 100, 5))
        assert r.rate == (None if r.y == 0 else (r.v - r.y) / r.y)
