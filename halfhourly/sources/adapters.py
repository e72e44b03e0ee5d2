"""Driver tables -> half-hourly inputs (stand-ins; see FIXTURES.md §3).

``events`` plays the ingest log: each event is one observation landed at
``ts``.  The rules (all rows used, nothing sampled):

* region ``user_id % 15`` (0 = national); half-hour = 30-minute bucket of ``ts``
* carbon: forecast ``floor(value)``; actual ``floor(value * 1.1)`` for
  purchases, else NULL; band from the forecast; order ``(ts, event_id)``
* price: ``view``/``click`` events in regions 1..14; inc = value, exc = value / 1.05
* generation mix: per half-hour, fuel ``i`` = sum of ``round(value * 100)`` over
  events with ``event_id % 11 = i`` (storage negated), integer-valued MW
* region dimension: ``nation`` (key, ``NATION_i``)

Every builder takes optional ``period_from``/``period_to`` bounds.  They are
applied twice: as a necessary condition on the raw ``ts`` (which reaches the
Parquet scan as a pushed filter; Catalyst cannot derive it through the
bucket expression) and exactly on the derived period.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halfhourly.functions.columns import (
    band_of_forecast, half_hour, plus_minutes, slugify, ts_lit,
)
from halfhourly.operators.merge import carbon_from_log, price_from_log
from halfhourly.schemas import FIRST_DNO_REGION_ID, FUELS, LAST_DNO_REGION_ID

N_REGIONS = 15
PRICE_EVENT_TYPES = ["view", "click"]
VAT_DIVISOR = 1.05


# Declared schemas of the driver tables the stand-ins read (no inference job
# per read; a file that disagrees fails loudly instead of drifting).
DRIVER_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def bound_periods(df: DataFrame, ts: str, period: str, period_from=None, period_to=None) -> DataFrame:
    """Filter rows whose half-hour lies in ``[period_from, period_to)``.

    ``half_hour(ts) >= lo`` implies ``ts >= lo`` and ``half_hour(ts) < hi``
    implies ``ts < hi + 30 min``; those two go to the scan, the exact test
    on the period follows.
    """
    cond = None
    if period_from is not None:
        cond = F.col(ts) >= ts_lit(period_from)
    if period_to is not None:
        upper = F.col(ts) < plus_minutes(ts_lit(period_to), 30)
        cond = upper if cond is None else cond & upper
    return df if cond is None else df.filter(cond)


def _exact(df: DataFrame, period: str, period_from=None, period_to=None) -> DataFrame:
    cond = None
    if period_from is not None:
        cond = F.col(period) >= ts_lit(period_from)
    if period_to is not None:
        upper = F.col(period) < ts_lit(period_to)
        cond = upper if cond is None else cond & upper
    return df if cond is None else df.filter(cond)


def _bucket():
    """Start and end of the half-hour of ``ts`` from ONE tumbling window."""
    w = F.window("ts", "30 minutes")
    return w.start.alias("period_start_utc"), w.end.alias("period_end_utc")


def carbon_log(events: DataFrame, period_from=None, period_to=None) -> DataFrame:
    """Observation log: carbon columns + ``ingested_at_utc`` + ``event_id``."""
    ev = bound_periods(events, "ts", "p", period_from, period_to)
    forecast = F.floor(F.col("value")).cast("int")
    start, end = _bucket()
    obs = ev.select(
        (F.col("user_id") % N_REGIONS).cast("int").alias("region_id"),
        start, end,
        forecast.alias("forecast_gco2_per_kwh"),
        F.when(F.col("event_type") == "purchase",
               F.floor(F.col("value") * 1.1).cast("int")).alias("actual_gco2_per_kwh"),
        band_of_forecast(forecast).alias("intensity_index"),
        F.col("ts").alias("ingested_at_utc"),
        F.col("event_id"),
    )
    return _exact(obs, "period_start_utc", period_from, period_to)


def carbon_table(events: DataFrame, period_from=None, period_to=None) -> DataFrame:
    """Newest observation per (region, half-hour); actual = newest non-NULL."""
    return carbon_from_log(carbon_log(events, period_from, period_to))


def price_log(events: DataFrame, period_from=None, period_to=None) -> DataFrame:
    region = (F.col("user_id") % N_REGIONS).cast("int")
    ev = bound_periods(events, "ts", "p", period_from, period_to).filter(
        F.col("event_type").isin(*PRICE_EVENT_TYPES)
        & region.between(FIRST_DNO_REGION_ID, LAST_DNO_REGION_ID))
    start, end = _bucket()
    obs = ev.select(region.alias("region_id"), start, end,
                    F.col("value").alias("price_pence_per_kwh_inc_vat"),
                    (F.col("value") / F.lit(VAT_DIVISOR)).alias("price_pence_per_kwh_exc_vat"),
                    F.col("ts").alias("ingested_at_utc"),
                    F.col("event_id"))
    return _exact(obs, "period_start_utc", period_from, period_to)


def price_table(events: DataFrame, period_from=None, period_to=None) -> DataFrame:
    return price_from_log(price_log(events, period_from, period_to))


def generation_mix_wide(events: DataFrame, period_from=None, period_to=None) -> DataFrame:
    """Wide national mix, one row per half-hour (one shuffle, map-side combined)."""
    ev = bound_periods(events, "ts", "p", period_from, period_to)
    mw = F.round(F.col("value") * 100).cast("bigint")
    slot = F.col("event_id") % len(FUELS)
    aggs = []
    for i, (col, label, _) in enumerate(FUELS):
        signed = -mw if label == "storage" else mw
        aggs.append(F.sum(F.when(slot == i, signed)).cast("double").alias(col))
    wide = (ev.select(half_hour("ts").alias("period_start_utc"), "event_id", "value", "ts")
            .groupBy("period_start_utc")
            .agg(*aggs,
                 F.sum(F.when(slot == len(FUELS) - 1, -mw).otherwise(mw)).cast("double")
                 .alias("total_generation_mw"),
                 F.max(F.floor(F.col("value"))).cast("double").alias("neso_carbon_intensity_gco2_per_kwh"),
                 F.max("ts").alias("ingested_at_utc")))
    return _exact(wide, "period_start_utc", period_from, period_to)


def region_dim(nation: DataFrame) -> DataFrame:
    """Region dimension from ``nation``: id = nation key, code = name, slug =
    lower-kebab name; ids 1..14 carry source codes (id and letter A..N)."""
    key = F.col("n_nationkey").cast("int")
    dno = key.between(FIRST_DNO_REGION_ID, LAST_DNO_REGION_ID)
    return nation.select(
        key.alias("region_id"),
        F.upper(F.col("n_name")).alias("canonical_code"),
        slugify(F.col("n_name")).alias("slug"),
        F.col("n_name").alias("name"),
        F.when(dno, key).alias("carbon_intensity_id"),
        F.when(dno, F.substring(F.lit("ABCDEFGHIJKLMN"), key, 1)).alias("octopus_code"),
        F.lit(None).cast("string").alias("notes"),
    )


def lake_carbon_from_orders(orders: DataFrame) -> DataFrame:
    """Multi-year archive stand-in: one national-or-regional reading per order.

    region ``o_custkey % 15``; period = ``o_orderdate``; forecast
    ``floor(o_totalprice / 1000)``; actual ``floor(o_totalprice / 900)`` when
    the order is finished (``F``), else NULL.
    """
    forecast = F.floor(F.col("o_totalprice") / 1000).cast("int")
    return orders.select(
        (F.col("o_custkey") % N_REGIONS).cast("int").alias("region_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("period_start_utc"),
        forecast.alias("forecast_gco2_per_kwh"),
        F.when(F.col("o_orderstatus") == "F",
               F.floor(F.col("o_totalprice") / 900).cast("int")).alias("actual_gco2_per_kwh"),
    )
