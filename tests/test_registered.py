"""Every registered query against its DuckDB oracle on the driver tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from halfhourly.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)  # exact, like the driver's value hash
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


# the operators of halfhourly/llm have their own tests in tests/llm
OWN = sorted(catalog.queries())


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    srows = [r.asDict() for r in sdf.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    assert cols == sorted(rel.columns)
    orows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert _rows(srows, cols) == _rows(orows, cols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["region_id", "computed_at_utc", "period_start_utc", "period_end_utc",
                          "price_pence_per_kwh_inc_vat", "forecast_gco2_per_kwh", "cheapest_rank",
                          "greenest_rank"]
    rows = df.collect()
    assert len(rows) > 0
    # ranks are a permutation 1..n within each region
    by_region = {}
    for r in rows:
        by_region.setdefault(r.region_id, []).append(r)
    for rs in by_region.values():
        assert sorted(r.cheapest_rank for r in rs) == list(range(1, len(rs) + 1))
        assert sorted(r.greenest_rank for r in rs) == list(range(1, len(rs) + 1))


@pytest.mark.parametrize("name", ["best_slots_24h", "monthly_rollup", "monthly_rollup_carbon", "dq_staleness",
                                  "backfill_windows", "archive_day_counts", "carbon_trend_24h", "dq_grid_gaps"])
def test_query_does_not_depend_on_session_zone(spark, duck, name):
    """Run without the UTC pinning, in a session set to New York."""
    from halfhourly.plans import catalog
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        sdf = catalog.queries()[name](spark, SF)
        cols = sorted(sdf.columns)
        srows = [r.asDict() for r in sdf.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    rel = duck.sql(E.oracle_sql()[name])
    orows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert _rows(srows, cols) == _rows(orows, cols)
