"""Forecast, charging schedule and block choice against brute force."""

import itertools
import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from halfhourly.operators import forecast, schedule

T0 = datetime(2024, 1, 1)


def half_hours(n, start=T0):
    return [start + timedelta(minutes=30 * k) for k in range(n)]


# -- forecast ---------------------------------------------------------------------------------------------------------

def design(times):
    out = []
    for t in times:
        m = (t - T0) // timedelta(minutes=1)
        row = [1.0, m / 10_080]
        for period, waves in ((1440, forecast.DAILY), (10_080, forecast.WEEKLY)):
            for k in range(1, waves + 1):
                a = (m % period) * 2 * math.pi * k / period
                row += [math.sin(a), math.cos(a)]
        out.append(row)
    return np.array(out)


def series(spark, noise=4.0, days=28):
    rng = random.Random(8)
    data = [(r, t, None if rng.random() < 0.05 else round(100 + 10 * r + 20 * math.sin((t.hour + t.minute / 60) * math.pi / 12)
                                                         + 5 * (t.weekday() >= 5) + rng.gauss(0, noise)))
            for r in range(3) for t in half_hours(48 * days)]
    return data, spark.createDataFrame(data, "r INT, t TIMESTAMP_NTZ, v INT")


def test_coefficients_equal_a_direct_fit(spark):
    data, df = series(spark)
    got = {x.r: (x.n, x.coefficients) for x in forecast.solve(forecast.normal_equations(df, ["r"], "t", "v")).collect()}
    for r in range(3):
        own = [(t, v) for k, t, v in data if k == r and v is not None]
        direct = np.linalg.lstsq(design([t for t, _ in own]), np.array([v for _, v in own], float), rcond=None)[0]
        assert got[r][0] == len(own) and np.allclose(got[r][1], direct, rtol=0, atol=1e-9 * max(1, abs(direct).max()))


def test_equations_of_parts_add_up(spark):
    _, df = series(spark)
    cut = F.lit("2024-01-12 05:30:00").cast("timestamp_ntz")
    parts = [forecast.normal_equations(df.filter(c), ["r"], "t", "v") for c in (F.col("t") < cut, F.col("t") >= cut)]
    whole = {x.r: x for x in forecast.normal_equations(df, ["r"], "t", "v").collect()}
    for x in forecast.add_up(parts[0].unionByName(parts[1]), ["r"]).collect():
        assert x.n == whole[x.r].n and np.allclose(x.products, whole[x.r].products, rtol=1e-12)
        assert np.allclose(x.with_value, whole[x.r].with_value, rtol=1e-12, atol=1e-9)


def test_beats_the_week_before_on_held_out_days(spark):
    data, df = series(spark)
    got = forecast.held_out(df, ["r"], "t", "v", T0 + timedelta(days=21), T0, T0 + timedelta(days=28)).collect()
    for x in got:
        own = {t: v for k, t, v in data if k == x.r}
        test = [t for t, v in own.items() if v is not None and t >= T0 + timedelta(days=21)]
        both = [t for t in test if own[t - timedelta(days=7)] is not None]
        assert (x.n_test, x.n_compared) == (len(test), len(both))
        assert math.isclose(x.week_before_mae, sum(abs(own[t] - own[t - timedelta(days=7)]) for t in both) / len(both))
        assert x.model_mae < x.week_before_mae and abs(x.train_bias) < 1e-9
    assert len(got) == 3


def test_too_few_rows_to_decide(spark):
    df = spark.createDataFrame([(1, T0, 5), (1, T0 + timedelta(hours=1), 7), (2, T0, None)], "r INT, t TIMESTAMP_NTZ, v INT")
    fitted = forecast.solve(forecast.normal_equations(df, ["r"], "t", "v"))
    got = {(x.r, x.t): x.forecast for x in forecast.predict(df, fitted, ["r"], "t").collect()}
    assert math.isclose(got[1, T0], 5, abs_tol=1e-6) and math.isclose(got[1, T0 + timedelta(hours=1)], 7, abs_tol=1e-6) and got[2, T0] is None


# -- charging ---------------------------------------------------------------------------------------------------------

def best_worth(prices, levels, fee, first=0):
    v = [0 if i == first else None for i in range(levels + 1)]
    for p in prices:
        w = []
        for i in range(levels + 1):
            ways = [v[i]] + ([v[i - 1] - p if v[i - 1] is not None else None] if i else [])
            ways += [v[i + 1] + p - fee if v[i + 1] is not None else None] if i < levels else []
            w.append(max((x for x in ways if x is not None), default=None))
        v = w
    return max(x for x in v if x is not None)


@pytest.mark.parametrize("levels,fee,first,fan", [(4, 0, 0, 32), (1, 50, 0, 2), (3, 10, 2, 3)])
def test_schedule_is_optimal_and_feasible(spark, monkeypatch, levels, fee, first, fan):
    monkeypatch.setattr(schedule, "FAN", fan)
    rng = random.Random(levels)
    kinds = {1: lambda k: rng.randint(-50, 300), 2: lambda k: 100, 3: lambda k: rng.choice([10, 20]), 4: lambda k: k, 5: lambda k: -k}
    data = [(r, t, kind(k)) for r, kind in kinds.items() for k, t in enumerate(half_hours(48 * 12)) if k % 7 or r != 1]
    data += [(6, T0, 40), (7, T0, None)]
    df = spark.createDataFrame(data, "r INT, t TIMESTAMP_NTZ, p BIGINT")
    got = schedule.charging(df, "r", "t", "p", levels, fee, first).collect()
    for r in [*kinds, 6]:
        prices = [p for k, t, p in sorted(data, key=lambda x: x[1]) if k == r]
        rows = sorted((x for x in got if x.r == r), key=lambda x: x.t)
        assert [x.p for x in rows] == prices
        level, gain = first, 0
        for x in rows:
            level += x.action
            assert x.action in (-1, 0, 1) and level == x.level and 0 <= level <= levels
            gain += {1: -x.p, -1: x.p - fee, 0: 0}[x.action]
        assert gain == best_worth(prices, levels, fee, first)
    assert not [x for x in got if x.r == 7]
    earned = {x.r: x.worth for x in schedule.worth(spark.createDataFrame(got), "r", "p", fee).collect()}
    assert earned[1] == best_worth([p for k, t, p in sorted(data, key=lambda x: x[1]) if k == 1], levels, fee, first)


def test_no_prices_no_schedule(spark):
    df = spark.createDataFrame([], "r INT, t TIMESTAMP_NTZ, p BIGINT")
    assert schedule.charging(df, "r", "t", "p").collect() == [] and schedule.best_blocks(df, "r", "t", "p", 2, 2).collect() == []


def test_composition_is_associative():
    rng = np.random.default_rng(1)
    a, b, c = (schedule.compose(schedule.slot_matrix(int(p), 3, 5), schedule.slot_matrix(int(q), 3, 5)) for p, q in rng.integers(0, 90, (3, 2)))
    left, right = schedule.compose(schedule.compose(a, b), c), schedule.compose(a, schedule.compose(b, c))
    assert np.array_equal(left > schedule.NEVER // 2, right > schedule.NEVER // 2) and np.array_equal(left[left > 0], right[left > 0])


# -- blocks -----------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("length,count", [(1, 1), (2, 2), (3, 3), (4, 2)])
def test_blocks_equal_exhaustive_search(spark, length, count):
    rng = random.Random(length)
    data = [(r, t, rng.choice([None, *range(1, 7)]) if r else 3) for r in range(4) for t in half_hours(18) if rng.random() < 0.9 or r < 2]
    df = spark.createDataFrame(data, "r INT, t TIMESTAMP_NTZ, p BIGINT")
    got = schedule.best_blocks(df, "r", "t", "p", length, count).collect()
    step = timedelta(minutes=30)
    for r in range(4):
        price = {t: p for k, t, p in data if k == r and p is not None}
        blocks = [(t, t + length * step, sum(price[t + i * step] for i in range(length))) for t in sorted(price)
                  if all(t + i * step in price for i in range(length))]
        choices = [c for m in range(count + 1) for c in itertools.combinations(blocks, m) if all(a[1] <= b[0] for a, b in zip(c, c[1:]))]
        best = min(choices, key=lambda c: (-len(c), sum(b[2] for b in c), [b[0] for b in c]))
        rows = sorted((x for x in got if x.r == r), key=lambda x: x.block)
        assert [(x.start, x.end, x.cost) for x in rows] == list(best) and [x.block for x in rows] == list(range(1, len(best) + 1))
