"""Archive laws: rerun leaves counts unchanged, an empty day clears its
partition, other days stay untouched; retention and table registration."""

import os
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from halfhourly.operators import lake
from halfhourly.schemas import CARBON_SCHEMA
from halfhourly.sources import adapters

SF = "/root/testdata/sf0.001"
AS_OF = "2024-01-15 12:00:00"


def _tables(spark):
    """Hot tables that satisfy the archive contract (the sparse stand-in mix
    has NULL fuels at this scale; see test_archive_rejects_nulls)."""
    ev = spark.read.parquet(f"{SF}/events.parquet")
    return {"carbon_intensity": adapters.carbon_table(ev), "agile_price": adapters.price_table(ev)}


def test_archive_rejects_nulls_in_required_columns(spark, tmpdir_path):
    import pytest
    from pyspark.errors import PySparkException
    ev = spark.read.parquet(f"{SF}/events.parquet")
    mix = adapters.generation_mix_wide(ev)
    assert mix.filter(F.col("coal_mw").isNull()).count() > 0
    with pytest.raises(PySparkException):
        lake.archive({"generation_mix": mix}, os.path.join(tmpdir_path, "lake"), AS_OF).collect()


def test_archive_rerun_and_empty_day(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "lake")
    t = _tables(spark)
    first = sorted(tuple(r) for r in lake.archive(t, root, AS_OF).collect())
    again = sorted(tuple(r) for r in lake.archive(t, root, AS_OF).collect())
    assert first == again
    expected = sorted(tuple(r) for r in lake.archive_day_counts(t, AS_OF).collect())
    assert first == expected
    # an older day archived separately must survive the next nightly run
    lake.archive(t, root, "2024-01-10 06:00:00")
    assert date(2024, 1, 9) in lake.list_days(spark, f"{root}/carbon_intensity")
    # rerun with no rows for the window clears both partitions of the window
    empty = {k: v.limit(0) for k, v in t.items()}
    cleared = lake.archive(empty, root, AS_OF).collect()
    assert all(r.rows == 0 for r in cleared)
    days = lake.list_days(spark, f"{root}/carbon_intensity")
    assert date(2024, 1, 13) not in days and date(2024, 1, 14) not in days
    assert date(2024, 1, 9) in days


def test_lake_schema_is_conformed(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "lake")
    lake.archive(_tables(spark), root, AS_OF)
    df = lake.scan_lake(spark, root, "agile_price", "2024-01-13 00:00:00", "2024-01-14 00:00:00")
    types = dict(df.dtypes)
    assert types["price_pence_per_kwh_inc_vat"] == "float" and "ingested_at_utc" not in types
    assert types["region_id"] == "int"
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "period_day" in plan


def test_retention_and_partition_expiry(spark, tmpdir_path):
    c = _tables(spark)["carbon_intensity"]
    kept = lake.apply_retention(c, "2024-01-20 00:00:00", days=5)
    assert kept.agg(F.min(F.to_date("period_start_utc"))).first()[0] == date(2024, 1, 15)
    path = os.path.join(tmpdir_path, "hot")
    lake.with_day(c).write.partitionBy("period_day").parquet(path)
    n_before = len(lake.list_days(spark, path))
    dropped = lake.expire_partitions(spark, path, "2024-01-20 00:00:00", days=5)
    assert dropped == n_before - len(lake.list_days(spark, path)) and min(lake.list_days(spark, path)) == date(2024, 1, 15)


def test_ensure_tables(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "lake")
    db = "lake_" + os.path.basename(tmpdir_path).replace("-", "_")
    assert lake.ensure_tables(spark, root, db) == 3
    assert lake.ensure_tables(spark, root, db) == 0


def test_lake_schemas():
    """Three archive tables, no ingest metadata, 32-bit floats, the required set."""
    from halfhourly.schemas import LAKE_TABLES, lake_schema
    assert sorted(LAKE_TABLES) == ["agile_price", "carbon_intensity", "generation_mix"]
    carbon = lake_schema("carbon_intensity")
    assert [f.name for f in carbon.fields if f.nullable] == ["actual_gco2_per_kwh"]
    assert "ingested_at_utc" not in carbon.fieldNames()
    mix = lake_schema("generation_mix")
    assert {f.dataType.simpleString() for f in mix.fields if f.name.endswith("_mw")} == {"float"}
    assert all(not f.nullable for f in lake_schema("agile_price").fields)
    for name in LAKE_TABLES:
        names = lake_schema(name).fieldNames()
        assert len(names) == len(set(names)) and names[0] in ("region_id", "period_start_utc")


def test_scan_day_is_one_utc_day(spark):
    c = _tables(spark)["carbon_intensity"]
    day = lake.scan_day(c, "2024-01-10")
    got = {r[0] for r in day.select(F.to_date("period_start_utc")).distinct().collect()}
    assert got == {date(2024, 1, 10)}
    assert day.count() == c.filter(F.to_date("period_start_utc") == F.lit(date(2024, 1, 10))).count()


def test_overwrite_long_day_list(spark, tmpdir_path):
    """Rows are counted for any number of days; empty days still clear."""
    c = lake.with_day(_tables(spark)["carbon_intensity"])
    path = os.path.join(tmpdir_path, "t")
    days = [date(2023, 12, 1) + timedelta(days=i) for i in range(70)]
    lake.with_day(c).write.partitionBy("period_day").parquet(path)  # includes Jan 2024 days
    written = lake.overwrite_days(c.filter(F.col("period_day") != F.lit(date(2024, 1, 3))), path, days)
    assert written[date(2024, 1, 3)] == 0
    assert written[date(2024, 1, 2)] == c.filter(F.col("period_day") == F.lit(date(2024, 1, 2))).count() > 0
    assert date(2024, 1, 3) not in lake.list_days(spark, path)
    assert date(2024, 1, 2) in lake.list_days(spark, path)


def test_catalog_tables_hold_what_the_paths_hold(spark, tmpdir_path):
    """Tables registered over archived days show their rows, and new days after a second call."""
    c = _tables(spark)["carbon_intensity"]
    root, db = os.path.join(tmpdir_path, "lake"), "lake_recover"
    first = lake.to_lake(c.filter(F.to_date("period_start_utc") < F.lit(date(2024, 1, 5))), "carbon_intensity")
    first.write.partitionBy("period_day").parquet(f"{root}/carbon_intensity")
    lake.ensure_tables(spark, root, db)
    assert spark.table(f"{db}.carbon_intensity").count() == first.count() > 0
    lake.to_lake(c, "carbon_intensity").write.mode("overwrite").partitionBy("period_day").parquet(f"{root}/carbon_intensity")
    lake.ensure_tables(spark, root, db)
    assert spark.table(f"{db}.carbon_intensity").count() == c.count()


def test_archive_counts_for_any_lookback(spark, tmpdir_path):
    tables = {"carbon_intensity": _tables(spark)["carbon_intensity"]}
    totals = {n: lake.archive(tables, os.path.join(tmpdir_path, f"l{n}"), "2024-02-01 00:00:00", n).agg(F.sum("rows")).collect()[0][0]
              for n in (62, 63, 400)}
    assert len(set(totals.values())) == 1 and totals[62] == tables["carbon_intensity"].count()


def test_offsets_are_kept():
    from datetime import datetime, timedelta, timezone
    from halfhourly.functions.columns import utc_naive
    assert utc_naive("2024-07-15T12:00:00+01:00") == datetime(2024, 7, 15, 11)
    assert utc_naive(datetime(2024, 7, 15, 12, 0, 0, 5, tzinfo=timezone(timedelta(hours=-2)))) == datetime(2024, 7, 15, 14, 0, 0, 5)
    assert utc_naive("2024-07-15 12:00:00") == datetime(2024, 7, 15, 12)


def test_catalog_takes_up_new_days_and_drops_gone_ones(spark, tmpdir_path):
    import uuid
    db, root = f"lake_{uuid.uuid4().hex[:8]}", f"{tmpdir_path}/lake"
    rows = [(1, datetime(2024, 5, d, 1), datetime(2024, 5, d, 1, 30), 10 + d, None, "low", datetime(2024, 6, 1)) for d in range(1, 6)]
    carbon = spark.createDataFrame(rows, CARBON_SCHEMA)
    first, later = (carbon.filter(F.col("period_start_utc") < F.lit(x).cast("timestamp_ntz")) for x in ("2024-05-04", "2024-05-09"))
    lake.overwrite_days(lake.to_lake(first, "carbon_intensity"), f"{root}/carbon_intensity", [date(2024, 5, d) for d in range(1, 4)])
    assert lake.ensure_tables(spark, root, db) == 3
    days = lambda: sorted(r[0].day for r in spark.sql(f"SELECT DISTINCT period_day FROM {db}.carbon_intensity").collect())
    assert days() == [1, 2, 3]
    lake.overwrite_days(lake.to_lake(later, "carbon_intensity"), f"{root}/carbon_intensity", [date(2024, 5, 4), date(2024, 5, 5)])
    lake.drop_partitions(spark, f"{root}/carbon_intensity", [date(2024, 5, 1)])
    assert lake.ensure_tables(spark, root, db) == 0 and days() == [2, 3, 4, 5]
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {db}.carbon_intensity").collect()] == [f"period_day=2024-05-0{d}" for d in range(2, 6)]
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_only_the_asked_days_are_listed(spark, tmpdir_path):
    rows = [(1, datetime(2024, 5, d, 1), datetime(2024, 5, d, 1, 30), 10 + d, None, "low", datetime(2024, 6, 1)) for d in range(1, 6)]
    table = lake.with_day(spark.createDataFrame(rows, CARBON_SCHEMA))
    assert lake.overwrite_days(table, tmpdir_path, [date(2024, 5, d) for d in range(1, 6)], count=False) == {}
    got = lake.read_days(spark, tmpdir_path, CARBON_SCHEMA, [date(2024, 5, 2), date(2024, 5, 4)])
    assert sorted(r.period_day.day for r in got.collect()) == [2, 4] and len(got.inputFiles()) == 2
    assert [r.forecast_gco2_per_kwh for r in lake.read_newest_day(spark, tmpdir_path, CARBON_SCHEMA).collect()] == [15]
