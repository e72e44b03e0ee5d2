"""Upsert laws: idempotent, batch-split invariant, sticky actual, last-wins,
compaction and time travel preserve the reduced state."""

from datetime import datetime

from pyspark.sql import functions as F

from halfhourly.functions.columns import sequence_of
from halfhourly.operators import merge
from halfhourly.schemas import CARBON_SCHEMA
from halfhourly.sources import adapters

SF = "/root/testdata/sf0.001"
NOW = "2027-07-11 15:00:00"
T0 = datetime(2027, 7, 11, 14, 30)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _batch(spark, rows):
    """rows: (region, start, forecast, actual, band, position)"""
    data = [(r, s, s.replace(minute=s.minute + 30) if s.minute == 0 else s.replace(hour=s.hour + 1, minute=0),
             f, a, b, p) for r, s, f, a, b, p in rows]
    df = spark.createDataFrame(data, "region_id int, period_start_utc timestamp_ntz, period_end_utc timestamp_ntz, "
                                     "forecast_gco2_per_kwh int, actual_gco2_per_kwh int, intensity_index string, pos long")
    return df.withColumn("_s", sequence_of(F.lit(T0).cast("timestamp_ntz"), F.col("pos"))).drop("pos")


def _empty(spark):
    return spark.createDataFrame([], CARBON_SCHEMA)


def test_insert_then_idempotent_rerun(spark):
    b = _batch(spark, [(0, T0, 89, 92, "low", 1), (1, T0, 40, None, "very low", 2)])
    once = merge.upsert_carbon(_empty(spark), b, NOW, F.col("_s"))
    twice = merge.upsert_carbon(once, b, NOW, F.col("_s"))
    assert once.count() == 2
    assert _rows(once) == _rows(twice)


def test_actual_is_sticky(spark):
    realised = _batch(spark, [(0, T0, 89, 92, "low", 1)])
    forecast_only = _batch(spark, [(0, T0, 95, None, "moderate", 2)])
    s1 = merge.upsert_carbon(_empty(spark), realised, NOW, F.col("_s"))
    s2 = merge.upsert_carbon(s1, forecast_only, "2027-07-11 16:00:00", F.col("_s")).first()
    assert (s2.forecast_gco2_per_kwh, s2.actual_gco2_per_kwh, s2.intensity_index) == (95, 92, "moderate")
    assert s2.ingested_at_utc == datetime(2027, 7, 11, 16, 0)


def test_duplicates_inside_batch_last_wins_and_last_non_null_actual(spark):
    b = _batch(spark, [(0, T0, 80, 70, "low", 1), (0, T0, 81, None, "low", 2), (0, T0, 82, None, "high", 3)])
    r = merge.upsert_carbon(_empty(spark), b, NOW, F.col("_s")).first()
    assert (r.forecast_gco2_per_kwh, r.actual_gco2_per_kwh, r.intensity_index) == (82, 70, "high")


def test_batch_split_invariant(spark):
    log = adapters.carbon_log(spark.read.parquet(f"{SF}/events.parquet"))
    seq = sequence_of(F.col("ingested_at_utc"), F.col("event_id"))
    inc = log.withColumn("_s", seq).drop("event_id")
    whole = merge.upsert_carbon(_empty(spark), inc, NOW, F.col("_s"))
    cut = F.lit("2024-01-12 00:00:00").cast("timestamp_ntz")
    first = merge.upsert_carbon(_empty(spark), inc.filter(F.col("ingested_at_utc") < cut), NOW, F.col("_s"))
    both = merge.upsert_carbon(first, inc.filter(F.col("ingested_at_utc") >= cut), NOW, F.col("_s"))
    assert _rows(whole) == _rows(both)


def test_compaction_and_time_travel_preserve_state(spark):
    log = adapters.carbon_log(spark.read.parquet(f"{SF}/events.parquet"))
    full = merge.carbon_from_log(log)
    compacted = merge.compact_log(log, "2024-01-20 00:00:00", keep_days=5)
    assert compacted.count() < log.count()
    assert _rows(merge.carbon_from_log(compacted)) == _rows(full)
    assert _rows(merge.as_known_at(log, "2030-01-01 00:00:00")) == _rows(full)
    early = merge.as_known_at(log, "2024-01-05 00:00:00")
    assert early.filter(F.col("ingested_at_utc") > F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")).count() == 0


def test_merge_combines_before_the_shuffle(spark):
    """Partial max_by runs map-side, below the only exchange of the merge."""
    log = adapters.carbon_log(spark.read.parquet(f"{SF}/events.parquet"))
    plan = merge.carbon_from_log(log)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("partial_max_by") > plan.index("Exchange hashpartitioning")


def test_dimension_reseed_replaces_by_key(spark):
    """K5: re-running the seed with an amended row replaces it; others stay."""
    from halfhourly.sources import payloads
    dim = payloads.region_seed(spark)
    amended = dim.filter(F.col("region_id") == 13).withColumn("name", F.lit("Greater London"))
    seq = sequence_of(F.lit(T0).cast("timestamp_ntz"), F.col("region_id"))
    out = merge.upsert_replace(dim, amended.withColumn("_s", seq), ["region_id"], NOW, F.col("_s"))
    rows = {r.region_id: r.name for r in out.collect()}
    assert len(rows) == 15 and rows[13] == "Greater London" and rows[1] == "North Scotland"
    again = merge.upsert_replace(out, amended.withColumn("_s", seq), ["region_id"], NOW, F.col("_s"))
    assert _rows(again) == _rows(out)


def test_same_instant_files_merge_deterministically(spark):
    """Two payload files landed in the same instant: the winner depends only on
    the files, not on task order, so a replay gives the same row."""
    from halfhourly.sources import payloads
    from payload_fixtures import NATIONAL, dumps
    import copy
    other = copy.deepcopy(NATIONAL)
    other["data"][0]["intensity"]["forecast"] = 111
    same = datetime(2027, 7, 11, 14, 31)
    docs = [(dumps(NATIONAL), same, "national", "/land/national/a.json"),
            (dumps(other), same, "national", "/land/national/b.json")]
    df = spark.createDataFrame(docs, "payload string, received_at timestamp_ntz, source string, file string")
    results = set()
    for order in (docs, list(reversed(docs))):
        d = spark.createDataFrame(order, df.schema).repartition(2)
        rows = payloads.parse_national(d)
        out = merge.upsert_carbon(spark.createDataFrame([], CARBON_SCHEMA), rows, NOW, F.col("_seq"))
        results.add(out.first().forecast_gco2_per_kwh)
    assert len(results) == 1
