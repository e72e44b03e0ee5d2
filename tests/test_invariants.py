"""Grid invariants: UTC days always have 48 half-hours; a 50-row payload
spills into the next day; the grid check finds holes and off-grid starts."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from halfhourly.operators import quality


def _periods(spark, start, n, region=1):
    rows = [(region, start + timedelta(minutes=30 * i)) for i in range(n)]
    return spark.createDataFrame(rows, "region_id int, period_start_utc timestamp_ntz")


@pytest.mark.parametrize("start,n,full_days", [
    (datetime(2026, 3, 29), 48, 1), (datetime(2026, 10, 25), 48, 1),
    (datetime(2026, 6, 1), 48, 1), (datetime(2026, 10, 25), 50, 1)])
def test_48_per_utc_day(spark, start, n, full_days):
    g = quality.grid_gaps(_periods(spark, start, n)).first()
    assert g.gaps == 0 and g.off_grid == 0 and g.periods == n
    assert g.short_days == (0 if n == 48 else 1)


def test_grid_gap_and_off_grid(spark):
    df = _periods(spark, datetime(2026, 6, 1), 10).filter(
        F.col("period_start_utc") != F.lit("2026-06-01 02:00:00").cast("timestamp_ntz"))
    extra = spark.createDataFrame([(1, datetime(2026, 6, 1, 7, 10))], df.schema)
    g = quality.grid_gaps(df.unionByName(extra)).first()
    assert g.gaps == 2 and g.off_grid == 1


def test_plan_windows_clips_last(spark):
    from halfhourly.sources.payloads import plan_windows
    span = spark.createDataFrame([(datetime(2024, 1, 1), datetime(2024, 2, 5))], "start timestamp_ntz, end timestamp_ntz")
    w = plan_windows(span).orderBy("window_start_utc").collect()
    assert [r.window_end_utc for r in w] == [datetime(2024, 1, 15), datetime(2024, 1, 29), datetime(2024, 2, 5)]
    assert w[0].from_param == "2024-01-01T00:00Z"
