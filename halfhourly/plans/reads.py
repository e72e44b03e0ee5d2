"""Read queries.  Each takes tables (DataFrames) and explicit parameters.

Every query has an all-regions form (``region=None``) — the form that
scales; passing a region adds one equality filter that Catalyst pushes to
the scan.  "Latest per region" is a ``max_by`` aggregate (partial, one
shuffle of one row per region per task), never a global sort.
"""

from __future__ import annotations

import re
import time
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from halfhourly.functions.columns import (
    band_class, band_code, band_from_code, display_value, is_forecast, ts_lit, utc_naive,
)
from halfhourly.operators.lake import DAY, day_bounds, list_days, read_days, read_newest_day
from halfhourly.schemas import (
    DEFAULT_PRICE_REGION_ID, FIRST_DNO_REGION_ID, LAST_DNO_REGION_ID, MAX_RANGE_DAYS,
    NATIONAL_REGION_ID,
)

CARBON_POINT = ["region_id", "period_start_utc", "period_end_utc", "forecast_gco2_per_kwh",
                "actual_gco2_per_kwh", "intensity_index"]
PRICE_POINT = ["region_id", "period_start_utc", "period_end_utc",
               "price_pence_per_kwh_inc_vat", "price_pence_per_kwh_exc_vat"]
REGION_COLS = ["region_id", "canonical_code", "slug", "name", "octopus_code"]


# ---------------------------------------------------------------------------
# guards (driver side, before planning)
# ---------------------------------------------------------------------------

def _to_dt(v) -> datetime:
    return utc_naive(v)


def check_window(from_ts, to_ts, max_days: int = MAX_RANGE_DAYS) -> None:
    """Both bounds with an offset, ``to > from`` and at most ``max_days`` long, else ``ValueError``."""
    for v in (from_ts, to_ts):
        if (v if isinstance(v, datetime) else datetime.fromisoformat(str(v))).tzinfo is None:
            raise ValueError(f"{v}: a range bound needs an offset, Z or +00:00 for UTC")
    a, b = _to_dt(from_ts), _to_dt(to_ts)
    if b <= a:
        raise ValueError("range end must be after its start")
    if b - a > timedelta(days=max_days):
        raise ValueError(f"a window may span {max_days} days, not more")


def require_dno(region_id: int | None) -> None:
    """Price queries refuse the national sentinel (no tariff there)."""
    if region_id is not None and not (FIRST_DNO_REGION_ID <= region_id <= LAST_DNO_REGION_ID):
        raise ValueError("prices exist only for regions 1..14")


def price_region(region_id: int) -> int:
    """National selection falls back to London for price cards."""
    return DEFAULT_PRICE_REGION_ID if region_id == NATIONAL_REGION_ID else region_id


def _between(df: DataFrame, from_ts, to_ts) -> DataFrame:
    """Rows of ``[from, to)``; a stored table that still carries its day column is pruned by day too."""
    if DAY in df.columns:
        return df.filter(day_bounds(from_ts, to_ts))
    return df.filter((F.col("period_start_utc") >= ts_lit(from_ts)) & (F.col("period_start_utc") < ts_lit(to_ts)))


def _region(df: DataFrame, region_id: int | None) -> DataFrame:
    return df if region_id is None else df.filter(F.col("region_id") == F.lit(region_id))


# ---------------------------------------------------------------------------
# region dimension
# ---------------------------------------------------------------------------

def _sorted_small(df: DataFrame, *order) -> DataFrame:
    """Order a result whose size is bounded by construction (a dimension, the
    fuels of one period): one small shuffle to a single partition and a local
    sort, instead of a range-partitioned global sort with its sampling job."""
    return df.repartition(1).sortWithinPartitions(*order)


def regions(dim: DataFrame) -> DataFrame:
    return _sorted_small(dim.select(*REGION_COLS), "region_id")


def region_by_slug(dim: DataFrame, slug: str) -> DataFrame:
    return dim.filter(F.col("slug") == F.lit(slug)).select(*REGION_COLS)


def region_by_code(dim: DataFrame, code: str) -> DataFrame:
    return dim.filter(F.col("canonical_code") == F.upper(F.lit(code))).select(*REGION_COLS)


def with_region(df: DataFrame, dim: DataFrame, code_col: str | None = None) -> DataFrame:
    """Attach region codes/slug to fact rows: by ``region_id`` or, when
    ``code_col`` is given, by a source code (tariff letter).  The dimension
    is broadcast only after its size is checked."""
    from halfhourly.operators.quality import broadcast_if_small
    d = dim.select("region_id", "canonical_code", "slug", "octopus_code")
    if code_col is None:
        return df.join(broadcast_if_small(d), "region_id", "inner")
    d = d.withColumnRenamed("octopus_code", code_col)
    return df.join(broadcast_if_small(d), code_col, "inner")


def regions_with_code(dim: DataFrame) -> DataFrame:
    """Regions that carry a tariff letter, ordered by id."""
    return _sorted_small(dim.filter(F.col("octopus_code").isNotNull())
                         .select("region_id", "octopus_code"), "region_id")


# ---------------------------------------------------------------------------
# carbon
# ---------------------------------------------------------------------------

def latest_per_region(df: DataFrame, cols: list[str], order_col: str = "period_start_utc") -> DataFrame:
    """Newest row per region by ``order_col`` (unique per region).

    One ``max_by`` per column so every buffer is fixed-width (hash
    aggregation, partial before the shuffle); the band travels as its code.
    """
    order = F.col(order_col)
    aggs = []
    for c in cols:
        if c == "region_id":
            continue
        if c == "intensity_index":
            aggs.append(band_from_code(F.max_by(band_code(F.col(c)), order)).alias(c))
        else:
            aggs.append(F.max_by(F.col(c), order).alias(c))
    return df.groupBy("region_id").agg(*aggs).select(*cols)


def carbon_current(hh: DataFrame, region_id: int | None = None) -> DataFrame:
    """Newest stored half-hour (possibly in the future) with a band, per region.

    One region: ``orderBy(desc).limit(1)`` (``TakeOrderedAndProject``: a
    per-task top-1 and no shuffle); all regions: ``max_by`` per region.
    """
    rows = _region(hh, region_id).filter(F.col("intensity_index").isNotNull()).select(*CARBON_POINT)
    if region_id is not None:
        return rows.orderBy(F.col("period_start_utc").desc()).limit(1)
    return latest_per_region(rows, CARBON_POINT)


def carbon_current_stored(spark: SparkSession, path: str, schema, region_id: int) -> DataFrame:
    """``carbon_current`` of one region on a stored mart: the newest stored day has a row of it as a rule;
    else one top-1 over the days before."""
    days = list_days(spark, path)
    if not days:
        return carbon_current(spark.createDataFrame([], schema), region_id)
    newest = carbon_current(read_days(spark, path, schema, days[-1:]), region_id)
    if len(days) == 1 or not newest.isEmpty():
        return newest
    return carbon_current(read_days(spark, path, schema, days[:-1]), region_id)


def generation_mix_stored(spark: SparkSession, path: str, schema) -> DataFrame:
    """``generation_mix_current`` on a stored mart: the newest period lies in the newest stored day, whose 528 rows
    at most fit one task, so the newest period is found without a second job or a shuffle."""
    day = read_newest_day(spark, path, schema).coalesce(1)
    newest = day.withColumn("_p", F.max("period_start_utc").over(Window.partitionBy()))
    return _sorted_small(newest.filter(F.col("period_start_utc") == F.col("_p")).drop("_p"), F.col("mw").desc())


def carbon_range(hh: DataFrame, from_ts, to_ts, region_id: int | None = None) -> DataFrame:
    check_window(from_ts, to_ts)
    rows = _between(_region(hh, region_id), from_ts, to_ts).filter(F.col("intensity_index").isNotNull())
    rows = rows.select(*CARBON_POINT)
    # one region: at most 14 days x 48 rows (guarded), returned in time order
    return _sorted_small(rows, "period_start_utc") if region_id is not None else rows


def carbon_trend(hh: DataFrame, as_of, hours: int = 24, region_id: int | None = None) -> DataFrame:
    """Trailing ``hours`` (as many as a range may have) before ``as_of``: forecast and actual per half-hour."""
    if not 0 < hours <= 24 * MAX_RANGE_DAYS:
        raise ValueError(f"a trend covers 1 to {24 * MAX_RANGE_DAYS} hours")
    end = utc_naive(as_of)
    rows = _between(_region(hh, region_id), end - timedelta(hours=hours), end).filter(F.col("intensity_index").isNotNull())
    rows = rows.select("region_id", "period_start_utc", "forecast_gco2_per_kwh", "actual_gco2_per_kwh",
                       F.date_format("period_start_utc", "HH:mm").alias("label"))
    return _sorted_small(rows, "period_start_utc") if region_id is not None else rows


def current_conditions(hh: DataFrame, region_id: int | None = None) -> DataFrame:
    cur = carbon_current(hh, region_id)
    return cur.select(
        "region_id", "period_start_utc", "intensity_index",
        display_value(F.col("actual_gco2_per_kwh"), F.col("forecast_gco2_per_kwh")).alias("display_gco2_per_kwh"),
        is_forecast(F.col("actual_gco2_per_kwh")).alias("is_forecast"),
        band_class(F.col("intensity_index")).alias("band_class"))


# ---------------------------------------------------------------------------
# price
# ---------------------------------------------------------------------------

def price_current(price: DataFrame, as_of, region_id: int | None = None) -> DataFrame:
    """The interval containing ``as_of`` (``start <= t < end``), newest start."""
    require_dno(region_id)
    t = ts_lit(as_of)
    rows = _region(price, region_id).filter(
        F.col("region_id").between(FIRST_DNO_REGION_ID, LAST_DNO_REGION_ID)
        & (F.col("period_start_utc") <= t) & (F.col("period_end_utc") > t)).select(*PRICE_POINT)
    if region_id is not None:
        return rows.orderBy(F.col("period_start_utc").desc()).limit(1)
    return latest_per_region(rows, PRICE_POINT)


def prices_at(price: DataFrame, points: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Batch interval containment: the newest tariff interval containing each distinct
    point (``start <= t < end``) of the same region.

    A range join rewritten as an equi-join: each interval is expanded into
    the half-hour buckets it covers (one bucket for a half-hourly tariff),
    each point gets its bucket, and the join is on ``(region_id, bucket)``
    with the exact containment test as a residual filter — no cross product,
    no nested-loop join.  An interval is first cut to the span of the points (one row), so one that
    is open for decades yields no more buckets than the points have.  A hot region on
    the point side is handled by AQE's
    skew-join splitting (the interval side has one row per key).
    """
    half = lambda c: F.window(c, "30 minutes").start
    span = points.agg(F.min(ts_col).alias("_lo"), F.max(ts_col).alias("_hi")).withColumn("_all", F.lit(1))
    last = F.col("period_end_utc") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0.000001))
    cut = (price.withColumn("_all", F.lit(1)).join(F.broadcast(span), "_all")
           .filter((F.col("period_start_utc") <= F.col("_hi")) & (F.col("period_end_utc") > F.col("_lo")))
           .withColumn("_from", F.greatest("period_start_utc", "_lo")).withColumn("_to", F.least(last, "_hi")))
    buckets = cut.select(
        "region_id", "period_start_utc", "period_end_utc", "price_pence_per_kwh_inc_vat",
        "price_pence_per_kwh_exc_vat", half("_from").alias("_from"), "_to").select(
        "region_id", "period_start_utc", "period_end_utc", "price_pence_per_kwh_inc_vat",
        "price_pence_per_kwh_exc_vat", "_from", half("_to").alias("_to")).select(
        "region_id", "period_start_utc", "period_end_utc", "price_pence_per_kwh_inc_vat",
        "price_pence_per_kwh_exc_vat",
        F.explode(F.sequence("_from", "_to", F.expr("INTERVAL 30 MINUTES"))).alias("_bucket"))
    pts = points.withColumn("_bucket", F.window(ts_col, "30 minutes").start)
    joined = pts.join(buckets, ["region_id", "_bucket"], "inner").filter(
        (F.col("period_start_utc") <= F.col(ts_col)) & (F.col(ts_col) < F.col("period_end_utc")))
    tariff = ["period_start_utc", "period_end_utc", "price_pence_per_kwh_inc_vat", "price_pence_per_kwh_exc_vat"]
    newest = F.max_by(F.struct(*tariff), F.struct("period_start_utc", "period_end_utc")).alias("_t")
    return joined.groupBy(*points.columns).agg(newest).select(*points.columns, "_t.*")


def price_range(price: DataFrame, from_ts, to_ts, region_id: int | None = None) -> DataFrame:
    check_window(from_ts, to_ts)
    require_dno(region_id)
    rows = _between(_region(price, region_id), from_ts, to_ts).select(*PRICE_POINT)
    return _sorted_small(rows, "period_start_utc") if region_id is not None else rows


# ---------------------------------------------------------------------------
# generation mix
# ---------------------------------------------------------------------------

def generation_mix_current(mix_long: DataFrame, latest_source: DataFrame | None = None) -> DataFrame:
    """Fuels of the newest period, largest first.

    The newest period is a one-row global ``max`` (size bound: 1 row, so the
    broadcast is safe at any scale).  ``latest_source`` may be the wide table
    (11x fewer rows to scan for the max).
    """
    src = latest_source if latest_source is not None else mix_long
    latest = src.agg(F.max("period_start_utc").alias("_p"))
    fuels = mix_long.join(F.broadcast(latest), F.col("period_start_utc") == F.col("_p")).drop("_p")
    return _sorted_small(fuels, F.col("mw").desc())  # one period: at most 11 rows


# ---------------------------------------------------------------------------
# best slots
# ---------------------------------------------------------------------------

def best_slots(mart: DataFrame, region_id: int | None = None, rank_col: str | None = None,
               k: int | None = None) -> DataFrame:
    """Ranked slots of the 24-hour mart for one region (or all), optionally
    only the top ``k`` by ``rank_col``."""
    require_dno(region_id)
    rows = _region(mart, region_id)
    if rank_col is not None:
        rows = rows.filter(F.col(rank_col) <= k)
    if region_id is not None:  # one region: at most 48 rows, in time order
        return _sorted_small(rows, "period_start_utc")
    return rows


# ---------------------------------------------------------------------------
# status, rollups, ad-hoc
# ---------------------------------------------------------------------------

def source_status(tables: dict[str, DataFrame]) -> DataFrame:
    """Per source: newest period, newest ingest, row count (one scan each)."""
    parts = [df.agg(F.max("period_start_utc").alias("last_period_utc"),
                    F.max("ingested_at_utc").alias("last_ingest_utc"),
                    F.count(F.lit(1)).cast("bigint").alias("row_count"))
             .select(F.lit(name).alias("source"), "*")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def monthly_intensity(lake_carbon: DataFrame, as_of, months: int = 24,
                      region_id: int = NATIONAL_REGION_ID) -> DataFrame:
    """Average actual/forecast and half-hour count per month, newest first."""
    since = ts_lit(as_of) - F.make_ym_interval(F.lit(0), F.lit(months))
    rows = lake_carbon.filter((F.col("region_id") == region_id) & (F.col("period_start_utc") >= since))
    if DAY in lake_carbon.columns:  # prunes partitions
        rows = rows.filter(F.col(DAY) >= F.to_date(since))
    # via DATE: zone-free for TIMESTAMP_NTZ (date_trunc would go through the session zone)
    month = F.trunc(F.to_date("period_start_utc"), "month").cast("timestamp_ntz")
    return (rows.groupBy(month.alias("month"))
            .agg(F.avg("actual_gco2_per_kwh").alias("avg_actual_gco2_per_kwh"),
                 F.avg("forecast_gco2_per_kwh").alias("avg_forecast_gco2_per_kwh"),
                 F.count(F.lit(1)).cast("bigint").alias("half_hours"))
            .orderBy(F.col("month").desc()).limit(months))


def ad_hoc(spark: SparkSession, sql: str, views: dict[str, DataFrame] | None = None,
           **params) -> tuple[DataFrame, float]:
    """Run SQL over registered views with ``${NAME}`` substitution.

    Values are bound as named parameters (``:name``), never spliced into the
    text, so they cannot change the statement; a placeholder inside quotes would become
    plain text and is refused.  Returns the result and the
    planning time; the caller decides how many rows to show.
    """
    quoted = re.findall(r"'(?:[^']|'')*'", sql)
    if any("${" + k + "}" in q for q in quoted for k in params):
        raise ValueError("a ${NAME} placeholder stands for a whole value: write it without quotes")
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    text = sql
    for k in params:
        text = text.replace("${" + k + "}", f":{k}")
    t0 = time.perf_counter()
    df = spark.sql(text, args=params or None)
    return df, time.perf_counter() - t0
