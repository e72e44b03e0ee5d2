"""Build layer, backfill, ad-hoc SQL, read-query guards."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from halfhourly.operators import lake, quality
from halfhourly.plans import build, reads
from halfhourly.sources import adapters, payloads
from payload_fixtures import NATIONAL, NATIONAL_NULL_ACTUAL, dumps

SF = "/root/testdata/sf0.001"
AS_OF = "2024-01-15 12:00:00"


def _raw(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    return {"carbon_intensity": adapters.carbon_table(ev), "agile_price": adapters.price_table(ev),
            "generation_mix": adapters.generation_mix_wide(ev)}


def test_build_writes_marts_and_reports(spark, tmpdir_path):
    raw = _raw(spark)
    dim = adapters.region_dim(spark.read.parquet(f"{SF}/nation.parquet"))
    built, report = build.build(spark, raw, dim, AS_OF, out_root=tmpdir_path)
    assert spark.sql("SELECT count(*) FROM stg_carbon_intensity").first()[0] == raw["carbon_intensity"].count()
    rows = {(r.check, r.table_name, r.column_name): r.violations for r in report.collect()}
    assert rows[("unique_combination_of_columns", "mart_half_hourly", "region_id,period_start_utc")] == 0
    assert rows[("unique_combination_of_columns", "dno_region", "region_id")] == 0
    assert rows[("accepted_values", "mart_generation_mix_long", "fuel")] == 0
    summary = {r.status: r.checks for r in quality.check_summary(report).collect()}
    assert summary.get("PASS", 0) > 0
    written = spark.read.parquet(os.path.join(tmpdir_path, "mart_best_slots_24h"))
    assert written.count() == built["mart_best_slots_24h"].count()
    assert build.layer_table("marts", "best_slots_24h") == "marts_best_slots_24h"


def test_backfill_is_rerunnable(spark, tmpdir_path):
    docs = [(dumps(NATIONAL), datetime(2027, 7, 11, 14, 31), "national"),
            (dumps(NATIONAL_NULL_ACTUAL), datetime(2027, 7, 11, 15, 1), "national")]
    p = spark.createDataFrame(docs, "payload string, received_at timestamp_ntz, source string")
    rows = payloads.parse_national(p)
    root = os.path.join(tmpdir_path, "lake")
    first = lake.backfill(rows, root)
    second = lake.backfill(rows, root)
    assert first == second
    assert lake.scan_lake(spark, root, "carbon_intensity").count() == 2


def test_archive_from_hot_tables(spark, tmpdir_path):
    raw = _raw(spark)
    state = os.path.join(tmpdir_path, "state")
    for name in ("carbon_intensity", "agile_price"):
        lake.with_day(raw[name]).write.partitionBy("period_day").parquet(os.path.join(state, name))
    counts = lake.archive_tables(spark, state, os.path.join(tmpdir_path, "lake"), AS_OF)
    got = {(r.table_name, str(r.period_day)): r.rows for r in counts.collect()}
    exp = {(r.table_name, str(r.period_day)): r.rows for r in lake.archive_day_counts(
        {k: raw[k] for k in ("carbon_intensity", "agile_price")}, AS_OF).collect()}
    assert {k: v for k, v in got.items() if k[0] != "generation_mix"} == exp


def test_ad_hoc_binds_parameters(spark):
    c = _raw(spark)["carbon_intensity"]
    df, secs = reads.ad_hoc(spark, "SELECT count(*) AS n FROM carbon WHERE region_id = ${REGION}",
                            {"carbon": c}, REGION=0)
    assert df.first().n == c.filter(F.col("region_id") == 0).count() and secs >= 0


def test_guards():
    with pytest.raises(ValueError):
        reads.check_window("2024-01-01 00:00:00Z", "2024-01-16 00:00:01Z")
    with pytest.raises(ValueError):
        reads.check_window("2024-01-02 00:00:00Z", "2024-01-01 00:00:00Z")
    reads.check_window("2024-01-01 00:00:00Z", "2024-01-15T01:00:00+01:00")
    with pytest.raises(ValueError, match="offset"):
        reads.check_window("2024-01-01 00:00:00", "2024-01-02 00:00:00Z")
    with pytest.raises(ValueError):
        reads.require_dno(0)
    assert reads.price_region(0) == 13 and reads.price_region(4) == 4


def test_region_lookups(spark):
    dim = payloads.region_seed(spark)
    assert reads.region_by_slug(dim, "london").first().region_id == 13
    assert reads.region_by_code(dim, "london").first().region_id == 13
    assert reads.region_by_slug(dim, "atlantis").count() == 0
    assert [r.octopus_code for r in reads.regions_with_code(dim).collect()][:2] == ["P", "N"]


def test_tariff_code_round_trip(spark):
    from halfhourly.functions.columns import tariff_code, tariff_letter
    df = spark.createDataFrame([("C",), ("J",)], "letter string")
    out = df.select(tariff_letter(tariff_code("AGILE-24-10-01", F.col("letter"))).alias("l")).collect()
    assert [r.l for r in out] == ["C", "J"]


def test_prices_at_handles_long_intervals_and_boundaries(spark):
    price = spark.createDataFrame(
        [(1, datetime(2027, 7, 11, 10, 0), datetime(2027, 7, 11, 11, 15), 20.0, 19.0),
         (1, datetime(2027, 7, 11, 11, 15), datetime(2027, 7, 11, 11, 30), 30.0, 28.0)],
        "region_id int, period_start_utc timestamp_ntz, period_end_utc timestamp_ntz, "
        "price_pence_per_kwh_inc_vat double, price_pence_per_kwh_exc_vat double")
    pts = spark.createDataFrame(
        [(1, datetime(2027, 7, 11, 10, 59), 1), (2, datetime(2027, 7, 11, 11, 15), 1),
         (3, datetime(2027, 7, 11, 11, 30), 1), (4, datetime(2027, 7, 11, 10, 5), 2)],
        "event_id long, ts timestamp_ntz, region_id int")
    got = {r.event_id: r.price_pence_per_kwh_inc_vat for r in reads.prices_at(price, pts).collect()}
    assert got == {1: 20.0, 2: 30.0}


def test_single_region_reads(spark):
    from halfhourly.plans.catalog import Tables
    t = Tables(spark, SF)
    hh = t.hh()
    one = reads.carbon_current(hh, 5).collect()
    every = {r.region_id: r for r in reads.carbon_current(hh).collect()}
    assert len(one) == 1 and one[0] == every[5]
    plan = reads.carbon_current(hh, 5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    with pytest.raises(ValueError):
        reads.best_slots(hh, 0)


def test_single_region_ranges_in_time_order(spark):
    from halfhourly.plans.catalog import Tables
    t = Tables(spark, SF)
    rows = reads.carbon_range(t.hh(), "2024-01-08 00:00:00Z", "2024-01-20 00:00:00Z", 3).collect()
    starts = [r.period_start_utc for r in rows]
    assert starts == sorted(starts) and {r.region_id for r in rows} <= {3}
    trend = reads.carbon_trend(t.hh(), "2024-01-15 12:00:00", 24, 3).collect()
    assert [r.period_start_utc for r in trend] == sorted(r.period_start_utc for r in trend)


def test_stored_reads_prune_by_day(spark, tmpdir_path):
    """Reads of a stored mart touch only the days they need."""
    raw = _raw(spark)
    build.build_marts(raw, AS_OF, out_root=tmpdir_path)
    path = os.path.join(tmpdir_path, "mart_half_hourly")
    hh = spark.read.parquet(path)
    pruned = lambda df: "period_day" in df._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert pruned(reads.carbon_range(hh, "2024-01-08T00:00Z", "2024-01-09T00:00Z"))
    assert pruned(reads.carbon_trend(hh, AS_OF))
    assert pruned(reads.price_range(hh, "2024-01-08T00:00Z", "2024-01-09T00:00Z"))
    assert pruned(reads.monthly_intensity(hh, AS_OF)) and pruned(lake.apply_retention(hh, AS_OF))
    schema = hh.drop("period_day").schema
    for region in (0, 5):
        one = reads.carbon_current_stored(spark, path, schema, region)
        assert pruned(one) and one.collect() == reads.carbon_current(hh.drop("period_day"), region).collect()
    long = os.path.join(tmpdir_path, "mart_generation_mix_long")
    whole = spark.read.parquet(long).drop("period_day")
    near = reads.generation_mix_stored(spark, long, whole.schema)
    assert sorted(map(str, near.collect())) == sorted(map(str, reads.generation_mix_current(whole).collect()))


def test_quoted_placeholders_are_refused(spark):
    with pytest.raises(ValueError, match="quotes"):
        reads.ad_hoc(spark, "SELECT '${R}' AS r", R=1)


def test_open_interval_is_cut_to_the_points(spark):
    schema = ("region_id int, period_start_utc timestamp_ntz, period_end_utc timestamp_ntz, "
              "price_pence_per_kwh_inc_vat double, price_pence_per_kwh_exc_vat double")
    price = spark.createDataFrame([(1, datetime(2000, 1, 1), datetime(2100, 1, 1), 20.0, 19.0)], schema)
    pts = spark.createDataFrame([(1, datetime(2027, 7, 11, 10, 59), 1), (2, datetime(2027, 7, 12), 1), (3, datetime(2027, 7, 12), 2)],
                                "event_id long, ts timestamp_ntz, region_id int")
    assert sorted(r.event_id for r in reads.prices_at(price, pts).collect()) == [1, 2]
    assert reads.prices_at(price, pts.limit(0)).count() == 0


def test_grid_breaks_between_months_count(spark):
    starts = [datetime(2027, 1, 31, 23, 0), datetime(2027, 1, 31, 23, 30), datetime(2027, 2, 1), datetime(2027, 4, 1), datetime(2027, 4, 1, 0, 45)]
    df = spark.createDataFrame([(1, s) for s in starts], "region_id int, period_start_utc timestamp_ntz")
    r = quality.grid_gaps(df).first()
    assert (r.periods, r.gaps, r.off_grid, r.short_days) == (5, 2, 1, 3)
