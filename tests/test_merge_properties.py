"""Property test: the one-aggregation merge equals an ordered row-by-row
upsert (last row wins, actual = COALESCE(new, old)), for any batch split."""

from datetime import datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from halfhourly.functions.columns import sequence_of
from halfhourly.operators import merge
from halfhourly.schemas import CARBON_SCHEMA, INTENSITY_BANDS

T0 = datetime(2027, 7, 11)
NOW = "2027-07-12 00:00:00"

row = st.tuples(st.integers(0, 2), st.integers(0, 3), st.integers(0, 400),
                st.one_of(st.none(), st.integers(0, 400)), st.sampled_from(INTENSITY_BANDS))


def model(batches):
    """Reference semantics: each batch applied row by row in list order."""
    state = {}
    for batch in batches:
        for region, slot, forecast, actual, band in batch:
            key = (region, slot)
            old = state.get(key)
            keep = actual if actual is not None else (old[1] if old else None)
            state[key] = (forecast, keep, band)
    return state


def spark_batch(spark, batch, offset):
    data = [(r, T0 + timedelta(minutes=30 * s), T0 + timedelta(minutes=30 * s + 30), f, a, b, offset + i)
            for i, (r, s, f, a, b) in enumerate(batch)]
    df = spark.createDataFrame(data, "region_id int, period_start_utc timestamp_ntz, period_end_utc timestamp_ntz, "
                                     "forecast_gco2_per_kwh int, actual_gco2_per_kwh int, intensity_index string, pos long")
    return df.withColumn("_s", sequence_of(F.lit(T0).cast("timestamp_ntz"), F.col("pos"))).drop("pos")


@settings(max_examples=8, deadline=None)
@given(rows=st.lists(row, min_size=1, max_size=25), cut=st.integers(0, 25))
def test_merge_matches_row_by_row_upsert(spark, rows, cut):
    cut = min(cut, len(rows))
    state = spark.createDataFrame([], CARBON_SCHEMA)
    for i, part in enumerate([rows[:cut], rows[cut:]]):
        if part:
            state = merge.upsert_carbon(state, spark_batch(spark, part, 1000 * i), NOW, F.col("_s"))
    got = {(r.region_id, int((r.period_start_utc - T0).total_seconds() // 1800)):
           (r.forecast_gco2_per_kwh, r.actual_gco2_per_kwh, r.intensity_index) for r in state.collect()}
    assert got == model([rows[:cut], rows[cut:]])


obs_row = st.tuples(st.integers(0, 1), st.integers(0, 2), st.integers(0, 300),
                    st.one_of(st.none(), st.integers(0, 300)), st.integers(0, 20 * 24 * 60))


@settings(max_examples=5, deadline=None)
@given(rows=st.lists(obs_row, min_size=1, max_size=30), keep_days=st.integers(0, 15))
def test_compaction_preserves_reduced_state(spark, rows, keep_days):
    data = [(r, T0 + timedelta(minutes=30 * s), T0 + timedelta(minutes=30 * s + 30), f, a, "low",
             T0 + timedelta(minutes=m), i) for i, (r, s, f, a, m) in enumerate(rows)]
    log = spark.createDataFrame(data, "region_id int, period_start_utc timestamp_ntz, period_end_utc timestamp_ntz, "
                                      "forecast_gco2_per_kwh int, actual_gco2_per_kwh int, intensity_index string, "
                                      "ingested_at_utc timestamp_ntz, event_id long")
    as_of = (T0 + timedelta(days=20)).strftime("%Y-%m-%d %H:%M:%S")
    full = sorted(tuple(r) for r in merge.carbon_from_log(log).collect())
    compacted = merge.compact_log(log, as_of, keep_days)
    assert sorted(tuple(r) for r in merge.carbon_from_log(compacted).collect()) == full
