"""Days replaced at once, states at many instants, drift profile."""

import uuid
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from halfhourly.operators import instants, merge, versions
from halfhourly.sources import contracts, drift

T0 = datetime(2024, 1, 1)


def days_table(spark, days, value, per_day=3):
    rows = [(r, datetime(d.year, d.month, d.day, 3 * r), value, d) for d in days for r in range(per_day)]
    return spark.createDataFrame(rows, "region_id INT, period_start_utc TIMESTAMP_NTZ, v INT, period_day DATE")


def by_day(df):
    return {r.period_day: (r.n, r.v) for r in df.groupBy("period_day").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("v")).collect()}


DAYS = [date(2024, 1, k) for k in range(1, 7)]


@pytest.fixture()
def name(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS versions_test")
    return f"versions_test.t_{uuid.uuid4().hex[:10]}"


def test_readers_see_all_days_change_at_once(spark, tmpdir_path, name):
    assert versions.replace_days(days_table(spark, DAYS, 1), name, tmpdir_path, DAYS, "a") == 1
    old = {d: (3, 1) for d in DAYS}
    assert by_day(spark.table(name)) == old
    open_reader = spark.table(name).filter("v >= 0")  # planned before the change
    new = days_table(spark, DAYS[1:3], 2)
    staged = versions.stage(new, tmpdir_path, DAYS[1:4], "b")  # the fourth day gets no rows
    assert staged == DAYS[1:3] and by_day(spark.table(name)) == old
    version = versions.build(spark, name, tmpdir_path, new.schema, DAYS[1:4], staged, "b")
    assert by_day(spark.table(name)) == old and version == 2
    versions.switch(spark, name, version)
    after = {d: (3, 2 if d in DAYS[1:3] else 1) for d in DAYS if d != DAYS[3]}
    assert by_day(spark.table(name)) == after and by_day(open_reader) == old
    assert versions.current_version(spark, name) == 2


@pytest.mark.parametrize("killed_after", ["stage", "build", "half a build"])
def test_a_killed_run_repeats_cleanly(spark, tmpdir_path, name, killed_after):
    versions.replace_days(days_table(spark, DAYS, 1), name, tmpdir_path, DAYS, "a")
    new = days_table(spark, DAYS[:2], 5, per_day=4)
    staged = versions.stage(days_table(spark, DAYS[:2], 9), tmpdir_path, DAYS[:2], "b")
    if killed_after != "stage":
        versions.build(spark, name, tmpdir_path, new.schema, DAYS[:2], staged, "b")
    if killed_after == "half a build":
        spark.sql(f"ALTER TABLE {name}__v2 DROP PARTITION (period_day = DATE'2024-01-05', written = 'a')")
    assert by_day(spark.table(name)) == {d: (3, 1) for d in DAYS}
    assert versions.replace_days(new, name, tmpdir_path, DAYS[:2], "b") == 2
    assert by_day(spark.table(name)) == {d: (4, 5) if d in DAYS[:2] else (3, 1) for d in DAYS}


def test_vacuum_keeps_what_versions_name(spark, tmpdir_path, name):
    for k in range(4):
        versions.replace_days(days_table(spark, DAYS if k == 0 else DAYS[:1], k), name, tmpdir_path, DAYS if k == 0 else DAYS[:1], f"r{k}")
    assert versions.vacuum(spark, name, tmpdir_path, keep=2) == 2
    assert by_day(spark.table(f"{name}__v3"))[DAYS[0]] == (3, 2) and not spark.catalog.tableExists(f"{name}__v2")
    assert by_day(spark.table(name)) == {d: (3, 3 if d == DAYS[0] else 0) for d in DAYS}
    assert versions.vacuum(spark, name, tmpdir_path, keep=2) == 0


def test_days_are_pruned_through_the_view(spark, tmpdir_path, name):
    versions.replace_days(days_table(spark, DAYS, 1), name, tmpdir_path, DAYS, "a")
    df = spark.table(name).filter(F.col("period_day") == F.lit(DAYS[2]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period_day" in plan and df.count() == 3 and "written" not in df.columns


# -- states at many instants ------------------------------------------------------------------------------------------

def log(spark):
    rows = [(k % 3, T0 + timedelta(minutes=30 * (k % 5)), T0 + timedelta(minutes=30 * (k % 5 + 1)), k, k if k % 4 == 0 else None, "low",
             T0 + timedelta(hours=(k * 7) % 90), k) for k in range(200)]
    return spark.createDataFrame(rows, "region_id INT, period_start_utc TIMESTAMP_NTZ, period_end_utc TIMESTAMP_NTZ, forecast_gco2_per_kwh INT, "
                                 "actual_gco2_per_kwh INT, intensity_index STRING, ingested_at_utc TIMESTAMP_NTZ, event_id BIGINT")


def test_states_equal_one_question_at_a_time(spark):
    at = [T0 - timedelta(days=1), T0, T0 + timedelta(hours=7), T0 + timedelta(hours=7, microseconds=1), T0 + timedelta(hours=33),
          T0 + timedelta(days=30), T0]
    df = log(spark)
    got = instants.states_at(df, at)
    columns = [c for c in got.columns if c != "known_at"]
    want = sorted(((t, *(r[c] for c in columns)) for t in set(at) for r in merge.as_known_at(df, t).collect()), key=repr)
    assert sorted(map(tuple, got.collect()), key=repr) == want and len(want) > 40
    assert instants.states_at(df, []).collect() == [] and instants.states_at(df.limit(0), at).collect() == []


def test_log_is_reduced_before_it_moves(spark):
    plan = instants.states_at(log(spark), [T0, T0 + timedelta(days=1)])._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange "):]
    assert "partial_max" in below and plan.count("Join") == 0 and plan.count("Exchange ") <= 2
    assert plan.count("LocalTableScan") + plan.count("Scan ExistingRDD") == 1


# -- drift ------------------------------------------------------------------------------------------------------------

def test_shapes_are_taken_apart(spark):
    shape = spark.sql("""SELECT schema_of_variant(parse_json('{"a": 1, "b c": [{"d,<": "x"}, {"e": 2.5}], "f": [], "g": {}, "h": null, "i": [1, "x"]}')) s""").first().s
    assert drift.shape_paths(shape) == {
        "$": "OBJECT", "$.a": "BIGINT", "$.b c": "ARRAY", "$.b c[]": "OBJECT", "$.b c[].d,<": "STRING", "$.b c[].e": "DECIMAL",
        "$.f": "ARRAY", "$.f[]": "VOID", "$.g": "OBJECT", "$.h": "VOID", "$.i": "ARRAY", "$.i[]": "VARIANT"}


def test_profile_names_each_drift(spark):
    good = '{"data":[{"from":"x","to":"y","intensity":{"forecast":1,"actual":null,"index":"low"}}]}'
    docs = [(good, 1), (good, 2), (good.replace('"index"', '"idx"'), 2), (good.replace('"index"', '"idx"'), 4), (good.replace(":1,", ":1.5,"), 3),
            ("{", 3), (None, 4), ('{"data":[]}', 1), ('{"data":null}', 5), ('{"data":[], "more":{"x":{"y":1}}}', 6), ("[1]", 7)]
    df = spark.createDataFrame([("national", p, datetime(2024, 5, d)) for p, d in docs], "source STRING, payload STRING, received_at TIMESTAMP_NTZ")
    got = {(r.path, r.finding, r.type_seen): (r.first_day.day, r.last_day.day, r.documents) for r in drift.profile(df).collect()}
    own = "$.data[].intensity"
    assert got == {
        (f"{own}.idx", "unknown path", "STRING"): (2, 4, 2), (f"{own}.index", "missing path", None): (2, 4, 2),
        (f"{own}.forecast", "other type", "DECIMAL"): (3, 3, 1), ("$", "not json", None): (3, 4, 2),
        ("$.data", "other type", "VOID"): (5, 5, 1), ("$.more", "unknown path", "OBJECT"): (6, 6, 1), ("$", "other type", "ARRAY"): (7, 7, 1)}
    assert drift.profile(df.filter("payload = 'nothing'")).collect() == []


def test_contract_paths_cover_the_contracts():
    paths = drift.contract_paths(contracts.GENERATION_MIX)
    assert paths["$"][3] and paths["$.result.records[]"][0] == {"OBJECT"} and not paths["$.result.total"][2]
    assert len(paths) == 1 + 1 + 1 + 1 + 1 + 1 + 35
