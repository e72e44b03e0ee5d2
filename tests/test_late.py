"""Late-data stream: equal to the reduction of what arrived in time, whatever the micro-batches; state stays bounded."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from halfhourly.streaming import late

T0 = datetime(2024, 1, 1)


def reading(n, region, slot, arrives, forecast, actual=None):
    start = T0 + timedelta(minutes=30 * slot)
    return (region, start, start + timedelta(minutes=30), forecast, actual, "low", arrives, n)


def rows():
    """Five days of half-hours in three regions: each half-hour is read at its end, corrected a day later, and now and then
    three days later, which is too late."""
    out, n = [], 0
    for slot in range(48 * 5):
        end = T0 + timedelta(minutes=30 * (slot + 1))
        for region in range(3):
            n += 1
            out.append(reading(n, region, slot, end - timedelta(minutes=1), slot, slot if slot % 5 == 0 else None))
            if slot % 4 == 0:
                out.append(reading(n + 100_000, region, slot, end + timedelta(days=1), slot + 1000, slot + 7 if slot % 8 == 0 else None))
            if slot % 6 == 0:
                out.append(reading(n + 200_000, region, slot, end + timedelta(days=3), -1, -1))
    edge = T0 + timedelta(minutes=30)
    return out + [reading(900_001, 0, 0, edge + timedelta(days=2), 5, 5), reading(900_002, 0, 0, edge + timedelta(days=2, microseconds=-1), 77)]


def land(spark, data, folder, mode="append"):
    spark.createDataFrame(data, late.LANDED_SCHEMA).coalesce(1).write.mode(mode).parquet(folder)


def expected(data):
    held: dict = {}
    for r in sorted(data, key=lambda r: (r[6], r[7])):
        if r[6] >= r[2] + timedelta(days=2):
            continue
        old = held.get((r[0], r[1]), (None,) * 7)
        held[r[0], r[1]] = (r[0], r[1], r[2], r[3], old[4] if r[4] is None else r[4], r[5], r[6], (old[7] if len(old) > 7 else 0) + 1)
    closes = max(r[2] for r in data if r[6] < r[2] + timedelta(days=2)) - timedelta(days=2, minutes=30)
    return sorted(v for v in held.values() if v[2] <= closes)


def got(spark, out):
    return sorted(tuple(r) for r in late.read_closed(spark, out).collect())


@pytest.mark.parametrize("polls,files", [(1, None), (6, None), (6, 1)])
def test_closed_rows_do_not_depend_on_batches(spark, tmpdir_path, polls, files):
    data = sorted(rows(), key=lambda r: r[6])
    out = f"{tmpdir_path}/out"
    size = -(-len(data) // polls)
    largest = 0
    for k in range(polls):
        land(spark, data[k * size:(k + 1) * size], f"{tmpdir_path}/in")
        closed, _ = late.run(spark, f"{tmpdir_path}/in", out, files_per_batch=files)
        largest = max([largest, *(op["numRowsTotal"] for p in closed.recentProgress for op in p["stateOperators"])])
        assert all(op["numRowsDroppedByWatermark"] == 0 for p in closed.recentProgress for op in p["stateOperators"])
    assert got(spark, out) == expected(data)
    kept = sorted(tuple(r) for r in late.read_late(spark, out).collect())
    assert kept == sorted(r for r in data if r[6] >= r[2] + timedelta(days=2)) and len(kept) > 100
    if polls > 1:  # three regions, the half-hours of a poll and of two days and a half
        assert largest <= 3 * 48 * (2.1 + 8 / polls + 1)
    assert closed.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3 * (48 * 2 + 2)


def test_a_closed_half_hour_never_reopens_and_a_poll_without_files_changes_nothing(spark, tmpdir_path):
    data, out = sorted(rows(), key=lambda r: r[6]), f"{tmpdir_path}/out"
    land(spark, data, f"{tmpdir_path}/in")
    late.run(spark, f"{tmpdir_path}/in", out)
    before = got(spark, out)
    late.run(spark, f"{tmpdir_path}/in", out)
    assert got(spark, out) == before
    land(spark, [reading(999_999, 1, 3, T0 + timedelta(days=30), 1, 1)], f"{tmpdir_path}/in")
    late.run(spark, f"{tmpdir_path}/in", out)
    assert got(spark, out) == before
    counts = late.late_counts(late.read_late(spark, out)).filter("region_id = 1 AND period_day = DATE'2024-01-01'").first()
    assert (counts.late, counts.longest_delay_s) == (9, 30 * 86_400 - 7_200)  # eight of the day's own and this one


def test_empty_folder(spark, tmpdir_path):
    land(spark, [], f"{tmpdir_path}/in")
    late.run(spark, f"{tmpdir_path}/in", f"{tmpdir_path}/out")
    assert got(spark, f"{tmpdir_path}/out") == [] and late.read_late(spark, f"{tmpdir_path}/out").count() == 0


def test_static_reduction_is_the_same_expression(spark):
    data = rows()
    df = late.closed_half_hours(spark.createDataFrame(data, late.LANDED_SCHEMA))
    closes = max(r[2] for r in data if r[6] < r[2] + timedelta(days=2)) - timedelta(days=2, minutes=30)
    assert sorted(tuple(r) for r in df.filter(F.col("period_end_utc") <= F.lit(closes).cast("timestamp_ntz")).collect()) == expected(data)
