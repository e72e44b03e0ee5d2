"""Cross-check, fuel buckets, comparison with earlier weeks and alert episodes against plain Python."""

import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from halfhourly.operators import alerts, crosscheck, fuel_buckets, seasonal
from halfhourly.schemas import FUEL_BUCKETS, FUELS, MIX_SCHEMA

T0 = datetime(2024, 3, 1)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


# -- cross-check ------------------------------------------------------------------------------------------------------

def test_cross_check_equals_plain_medians(spark):
    rng = random.Random(1)
    left = [(at(30 * k), rng.choice([None, *range(80, 120)])) for k in range(400) if k % 17]
    right = [(at(30 * k), float(rng.randint(85, 115) + (60 if k % 50 == 0 else 0))) for k in range(400) if k % 13]
    a, b = spark.createDataFrame(left, "p TIMESTAMP_NTZ, x INT"), spark.createDataFrame(right, "p TIMESTAMP_NTZ, y DOUBLE")
    got = crosscheck.cross_check(crosscheck.merge_series(a, b, "p", "x", "y"), F.hour("p")).collect()
    x, y, groups = dict(left), dict(right), {}
    for p in x.keys() & y.keys():
        if x[p] is not None:
            groups.setdefault(p.hour, []).append(x[p] - y[p])
    assert {r.p for r in got} == x.keys() | y.keys() and len(got) == len(x.keys() | y.keys())
    for r in got:
        status = "both" if r.p in x and r.p in y else "left_only" if r.p in x else "right_only"
        assert r.status == status
        med = statistics.median(groups[r.p.hour])
        mad = statistics.median(abs(d - med) for d in groups[r.p.hour])
        assert (r.median_deviation, r.mad) == (med, mad)
        if r.status == "both" and r.left_value is not None:
            assert r.deviation == x[r.p] - y[r.p] and r.outlier == (abs(r.deviation - med) > 3 * 1.4826 * mad)
        else:
            assert r.deviation is None and r.outlier is None
    assert sum(bool(r.outlier) for r in got) >= 5


@pytest.mark.parametrize("values", [[3], [3, 4], [1, 1, 1], [1, 2, 3, 100], [-5, -5, 7, 8, 9], list(range(101))])
def test_grouped_median(spark, values):
    df = spark.createDataFrame([("g", v) for v in values] + [("g", None), ("only null", None)], "g STRING, v BIGINT")
    assert [(r.g, r.m / 2) for r in crosscheck.grouped_medians(df, "g", "v", "m").collect()] == [("g", statistics.median(values))]


def test_medians_see_distinct_values_only(spark):
    """The window's input is the histogram: a partial and a final count come before it."""
    plan = crosscheck.grouped_medians(spark.range(1000).select((F.col("id") % 2).alias("g"), F.col("id").alias("v")), "g", "v", "m")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("Window") < text.index("partial_count")


# -- fuel buckets -----------------------------------------------------------------------------------------------------

def wide(spark, data):
    schema = "period_start_utc TIMESTAMP_NTZ, " + ", ".join(f"{c} DOUBLE" for c, _, _ in FUELS)
    return spark.createDataFrame(data, schema)


def test_buckets_equal_plain_sums(spark):
    rng = random.Random(2)
    data = [(at(30 * k), *(rng.choice([None, float(rng.randint(-50, 500))]) for _ in FUELS)) for k in range(48 * 40)]
    data += [(at(-30), *[None] * len(FUELS)), (at(-60), *[0.0] * len(FUELS)), (at(-90), *[-1.0] * len(FUELS))]
    place, want = {label: i + 1 for i, (_, label, _) in enumerate(FUELS)}, {}
    plus = lambda a, b: b if a is None else a if b is None else a + b
    for row in data:
        p = row[0]
        starts = {"period": p, "day": p.replace(hour=0, minute=0), "month": p.replace(day=1, hour=0, minute=0)}
        total = sum((v for v in row[1:] if v is not None), 0.0) if any(v is not None for v in row[1:]) else None
        for bucket, fuels in FUEL_BUCKETS.items():
            part = [row[place[f]] for f in fuels if row[place[f]] is not None]
            for grain, start in starts.items():
                n, mw, all_mw = want.get((grain, bucket, start), (0, None, None))
                want[grain, bucket, start] = n + 1, plus(mw, sum(part) if part else None), plus(all_mw, total)
    got = {(r.grain, r.bucket, r.start): r for r in fuel_buckets.bucket_shares(wide(spark, data)).collect()}
    assert got.keys() == want.keys()
    for k, (n, mw, total) in want.items():
        assert (got[k].half_hours, got[k].mw, got[k].total_mw) == (n, mw, total)
        assert got[k].share_pct == (100.0 * mw / total if total is not None and total > 0 and mw is not None else None)


def test_buckets_are_one_scan_and_one_exchange(spark, tmpdir_path):
    wide(spark, [(at(30 * k), *[1.0] * len(FUELS)) for k in range(500)]).write.parquet(f"{tmpdir_path}/mix")
    df = fuel_buckets.bucket_shares(spark.read.schema(MIX_SCHEMA).parquet(f"{tmpdir_path}/mix"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange ") == 1 and "total_generation_mw" not in plan
    assert plan.count("HashAggregate") == 2


# -- earlier weeks ----------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("days,minutes", [(seasonal.YEAR, 24 * 60), (seasonal.WEEK, 30)])
def test_against_earlier_equals_lookups(spark, days, minutes):
    rng, step = random.Random(3), timedelta(minutes=minutes)
    n = 800 if minutes > 60 else 48 * 20
    series = {(k, T0 + step * i): rng.choice([None, 0, *range(5, 90)]) for k in (1, 2) for i in range(n) if rng.random() < 0.8}
    first, last = T0 + step * 10, T0 + step * (n + 5)
    df = spark.createDataFrame([(k, t, v) for (k, t), v in series.items()], "k INT, t TIMESTAMP_NTZ, v BIGINT")
    got = {(r.k, r.t): r for r in seasonal.against_earlier(df, ["k"], "t", "v", days, minutes, first, last).collect()}
    assert got.keys() == {(k, T0 + step * i) for k in (1, 2) for i in range(10, n + 6)}
    for (k, t), r in got.items():
        v, e = series.get((k, t)), series.get((k, t - timedelta(days=days)))
        assert (r.value, r.earlier, r.earlier_period) == (v, e, t - timedelta(days=days))
        assert r.change == (None if v is None or e is None else v - e)
        assert r.change_pct == (None if r.change is None or e == 0 else 100.0 * (v - e) / e)
        assert r.status == ("missing_both" if v is None and e is None else "missing_now" if v is None else
                            "missing_earlier" if e is None else "both")
        assert (t - r.earlier_period).days % 7 == 0 and t.weekday() == r.earlier_period.weekday()
    assert len({r.status for r in got.values()}) == 4


def test_series_is_not_joined_with_itself(spark):
    df = spark.createDataFrame([(1, T0, 5)], "k INT, t TIMESTAMP_NTZ, v BIGINT")
    plan = seasonal.against_earlier(df, ["k"], "t", "v", 7, 30, T0, at(30))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan


# -- alerts -----------------------------------------------------------------------------------------------------------

def plain_episodes(ingests, limit, hold, now, every):
    """Evaluate every tick."""
    second = timedelta(seconds=1)
    ticks, t = [], datetime(1970, 1, 1) + every * second * ((min(ingests) - datetime(1970, 1, 1)) // (every * second))
    while t <= now:
        known = [i for i in ingests if i <= t]
        if known:
            ticks.append((t, t - max(known) > limit * second))
        t += every * second
    out, open_ = [], None
    for t, stale in ticks + [(None, False)]:
        if stale and open_ is None:
            open_ = [t, None]
        if open_ and stale and open_[1] is None and t - open_[0] >= hold * second:
            open_[1] = t
        if open_ and not stale:
            state = ("firing" if open_[1] else "pending") if t is None else ("resolved" if open_[1] else "cleared")
            out.append((open_[0], open_[1], t, state, int(((t or now) - open_[0]).total_seconds())))
            open_ = None
    return out


@pytest.mark.parametrize("seed", range(6))
def test_episodes_equal_evaluating_every_tick(spark, seed):
    rng = random.Random(seed)
    limits, holds, log, want = {"a": 5400, "b": 1800}, {"a": 1800, "b": 600}, [], []
    now = T0 + timedelta(days=6, minutes=rng.randint(0, 90), seconds=rng.choice([0, 30]))
    for feed in limits:
        for region in range(3):
            t, own = T0 + timedelta(seconds=rng.randint(0, 4000)), []
            while t < T0 + timedelta(days=5, hours=23, minutes=rng.choice([0, 30])):
                own.append(t)
                t += timedelta(seconds=rng.choice([300, 900, limits[feed], limits[feed] + 1, limits[feed] + 320, 3 * limits[feed], 7 * limits[feed], 12_345]))
            log += [(feed, region, i) for i in own] + [(feed, region, now + timedelta(hours=1))]
            want += [(feed, region, *e) for e in plain_episodes(own, limits[feed], holds[feed], now, 300)]
    log += [("unknown", 0, T0)]
    df = spark.createDataFrame(log, "feed STRING, region INT, ts TIMESTAMP_NTZ")
    feed = F.col("feed")
    got = alerts.episodes(df, ["feed", "region"], "ts", alerts.rule(feed, limits), alerts.rule(feed, holds), now)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert {"resolved", "cleared"} <= {w[5] for w in want}


def test_episodes_do_not_depend_on_the_session_zone(spark):
    ingests = [datetime(2024, 3, 30, 23, 0) + timedelta(minutes=m) for m in (0, 20, 200, 420, 430, 800)]
    df = spark.createDataFrame([("a", i) for i in ingests], "feed STRING, ts TIMESTAMP_NTZ")
    run = lambda: sorted(map(tuple, alerts.episodes(df, ["feed"], "ts", F.lit(5400), F.lit(1800), datetime(2024, 3, 31, 20)).collect()))
    zone, utc = spark.conf.get("spark.sql.session.timeZone"), run()
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/London")  # its clocks change in that night
        assert run() == utc and len(utc) == 4
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_sessions_are_formed_a_day_at_a_time(spark):
    df = spark.createDataFrame([("a", T0)], "feed STRING, ts TIMESTAMP_NTZ")
    plan = alerts.sessions(df, ["feed"], "ts", F.lit(60))._jdf.queryExecution().executedPlan().toString()
    first = plan[plan.rindex("hashpartitioning("):]
    assert "block" in first.split("\n")[0]


def test_no_ingest_no_episode(spark):
    df = spark.createDataFrame([], "feed STRING, ts TIMESTAMP_NTZ")
    assert alerts.episodes(df, ["feed"], "ts", F.lit(5400), F.lit(1800), T0).collect() == []
