"""Hourly states: a merge equals the recomputation; only touched days are written again."""

import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from halfhourly.operators import rollups

SCHEMA = "region_id INT, period_start_utc TIMESTAMP_NTZ, reading BIGINT, sender BIGINT"


def readings(spark, days=4, extra=()):
    t0 = datetime(2024, 2, 27)
    data = [(k % 3, t0 + timedelta(minutes=7 * k), (k * 37) % 201 if k % 11 else None, k % 50) for k in range(days * 205)]
    return spark.createDataFrame(data + list(extra), SCHEMA)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names
            if "period_day=" in d and f.endswith(".parquet")}


def exact(df, *grain):
    return {tuple(r[:len(grain)]): tuple(r[len(grain):]) for r in df.groupBy(*grain).agg(
        F.count("reading"), F.sum("reading"), F.min("reading"), F.max("reading"), F.count_distinct("sender")).collect()}


@pytest.mark.parametrize("grain", [("region_id", "period_day"), ("period_day",), ("region_id",), ()])
def test_merge_equals_recomputation(spark, grain):
    rows = readings(spark).withColumn("period_day", F.to_date("period_start_utc"))
    got = rollups.measures(rollups.merge_states(rollups.hourly_states(rows, "reading", "sender"), *grain)).collect()
    want = exact(rows, *grain)
    assert len(got) == len(want)
    for r in got:
        n, total, least, greatest, senders = want[tuple(r[g] for g in grain)]
        assert (r.n, r.total, r.least, r.greatest, r.senders) == (n, total, least, greatest, senders)  # HLL is exact for few
        assert r["mean"] == total / n


def test_quantiles_are_close(spark):
    rows = spark.range(20_000).select(F.lit(1).alias("region_id"), (F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz")
                                      + F.make_dt_interval(mins=(F.col("id") % 1440).cast("int"))).alias("period_start_utc"),
                                      F.col("id").alias("reading"), F.col("id").alias("sender"))
    r = rollups.measures(rollups.merge_states(rollups.hourly_states(rows, "reading", "sender"), "region_id"), (0.1, 0.5, 0.9)).first()
    assert abs(r.p10 - 2000) < 700 and abs(r.p50 - 10_000) < 700 and abs(r.p90 - 18_000) < 700 and abs(r.senders - 20_000) < 1500


def test_late_batch_rewrites_exactly_its_days(spark, tmpdir_path):
    path = f"{tmpdir_path}/states"
    first = readings(spark)
    assert len(rollups.rebuild(first, path, rollups.touched_days(first), "reading", "sender", 0)) == 4
    before = files(path)
    batch = [(0, datetime(2024, 2, 28, 5), 1000, 7), (2, datetime(2024, 3, 1, 23, 59), -5, 999)]
    days = rollups.touched_days(spark.createDataFrame(batch, SCHEMA))
    assert days == [date(2024, 2, 28), date(2024, 3, 1)]
    every = readings(spark, extra=batch)
    rollups.rebuild(every, path, days, "reading", "sender", 1)
    after = files(path)
    same = {f for f in before if "2024-02-28" not in f and "2024-03-01" not in f}
    assert same and {f: after.get(f) for f in same} == {f: before[f] for f in same}
    assert not {f for f in before if f not in same} & set(after)
    got = rollups.merge_states(rollups.read_states(spark, path), "region_id", "period_day")
    want = exact(every.withColumn("period_day", F.to_date("period_start_utc")), "region_id", "period_day")
    assert {(r.region_id, r.period_day): (r.n, r.total, r.least, r.greatest) for r in got.collect()} == {k: v[:4] for k, v in want.items()}
    assert {r.period_day for r in got.filter("build = 1").collect()} == set(days)
    assert rollups.rebuild(every, path, [], "reading", "sender", 2) == {} and files(path) == after


def test_reads_prune_days_and_a_day_without_rows_ends_empty(spark, tmpdir_path):
    path = f"{tmpdir_path}/states"
    rows = readings(spark)
    rollups.rebuild(rows, path, rollups.touched_days(rows), "reading", "sender", 0)
    day = rollups.read_states(spark, path, datetime(2024, 2, 28), datetime(2024, 2, 28))
    assert "PartitionFilters: [isnotnull(period_day" in day._jdf.queryExecution().toString()
    assert {r.period_day for r in day.collect()} == {date(2024, 2, 28)}
    gone = rows.filter(F.to_date("period_start_utc") != F.lit(date(2024, 2, 28)))
    assert rollups.rebuild(gone, path, [date(2024, 2, 28)], "reading", "sender", 1) == {date(2024, 2, 28): 0}
    assert rollups.read_states(spark, path, datetime(2024, 2, 28), datetime(2024, 2, 28)).count() == 0
