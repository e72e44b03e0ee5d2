"""Staging views and marts (the transform layer).

``stg_*`` are lazy projections; marts are DataFrames the caller may persist.
Plan notes (see ``.explain``):

* ``half_hourly``: both inputs come out of aggregations hash-partitioned on
  ``(region_id, period_start_utc)``, so the left join reuses that
  partitioning; no extra exchange.  Each side stays a sort-merge/shuffled
  join at scale; AQE may switch to broadcast only from runtime sizes.
* ``generation_mix_long``: the per-period total is a row-wise sum over the
  wide row, so the long mart is scan -> Expand -> project: no shuffle and no
  self-join, where the SQL formulation needs a group-by and a join.
* ``best_slots_24h``: the 24-hour filter runs before the windows; both
  ``row_number`` windows share one ``region_id`` partitioning (one exchange)
  and each region holds at most 48 rows after the filter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from halfhourly.functions.columns import plus_hours, share_pct, ts_lit
from halfhourly.schemas import FUELS


def stg_carbon(raw: DataFrame) -> DataFrame:
    return raw.select("region_id", "period_start_utc", "period_end_utc", "forecast_gco2_per_kwh",
                      "actual_gco2_per_kwh", F.lower("intensity_index").alias("intensity_index"),
                      "ingested_at_utc")


def stg_price(raw: DataFrame) -> DataFrame:
    return raw.select("region_id", "period_start_utc", "period_end_utc",
                      "price_pence_per_kwh_inc_vat", "price_pence_per_kwh_exc_vat",
                      "ingested_at_utc")


def _fuel_label() -> F.Column:
    """Wide column name -> long-form fuel label."""
    return reduce(lambda acc, f: acc.when(F.col("fuel_col") == f[0], F.lit(f[1])),
                  FUELS[1:], F.when(F.col("fuel_col") == FUELS[0][0], F.lit(FUELS[0][1])))


def _is_renewable() -> F.Column:
    return F.col("fuel_col").isin(*[c for c, _, ren in FUELS if ren])


def stg_generation_mix(raw: DataFrame) -> DataFrame:
    """Wide -> long: one row per (period, fuel) with the fuel label and the
    renewable flag.  One scan (``Expand``), not eleven unioned scans."""
    cols = [c for c, _, _ in FUELS]
    long = raw.select("period_start_utc", *cols).unpivot(
        ["period_start_utc"], cols, "fuel_col", "mw")
    return long.select("period_start_utc", _fuel_label().alias("fuel"),
                       F.col("mw").cast("double").alias("mw"), _is_renewable().alias("is_renewable"))


def _period_total(raw: DataFrame) -> F.Column:
    """Sum of the fuel columns of one wide row, skipping NULLs (NULL if all are)."""
    cols = [F.col(c).cast("double") for c, _, _ in FUELS]
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in cols])
    return F.when(F.coalesce(*cols).isNotNull(), total)


def generation_mix_long(raw_wide: DataFrame) -> DataFrame:
    """Long mart: ``share = 100 * mw / total`` when the period total (storage
    included, signed) is positive, else NULL."""
    with_total = raw_wide.select("period_start_utc", *[c for c, _, _ in FUELS],
                                 _period_total(raw_wide).alias("_total"))
    cols = [c for c, _, _ in FUELS]
    long = with_total.unpivot(["period_start_utc", "_total"], cols, "fuel_col", "mw")
    return long.select(
        "period_start_utc", _fuel_label().alias("fuel"), F.col("mw").cast("double").alias("mw"),
        _is_renewable().alias("is_renewable"),
        share_pct(F.col("mw"), F.col("_total")).alias("share_of_generation_pct"))


def period_totals(mix_long: DataFrame) -> DataFrame:
    """``SUM(mw)`` per period over the long form (partial aggregation first)."""
    return mix_long.groupBy("period_start_utc").agg(F.sum("mw").alias("total_mw"))


def half_hourly(carbon: DataFrame, price: DataFrame) -> DataFrame:
    """Carbon LEFT JOIN price on the natural key; carbon drives the rows, so
    prices without a carbon row vanish and national rows have NULL price."""
    c = stg_carbon(carbon).drop("ingested_at_utc")
    p = stg_price(price).select("region_id", "period_start_utc",
                                "price_pence_per_kwh_inc_vat", "price_pence_per_kwh_exc_vat")
    return c.join(p, ["region_id", "period_start_utc"], "left").select(
        "region_id", "period_start_utc", "period_end_utc", "forecast_gco2_per_kwh",
        "actual_gco2_per_kwh", "intensity_index", "price_pence_per_kwh_inc_vat",
        "price_pence_per_kwh_exc_vat")


def cheapest_rank() -> F.Column:
    w = Window.partitionBy("region_id").orderBy(
        F.col("price_pence_per_kwh_inc_vat").asc_nulls_last(), F.col("period_start_utc"))
    return F.row_number().over(w).cast("bigint")


def greenest_rank() -> F.Column:
    w = Window.partitionBy("region_id").orderBy(
        F.col("forecast_gco2_per_kwh").asc_nulls_last(), F.col("period_start_utc"))
    return F.row_number().over(w).cast("bigint")


def forward_window(hh: DataFrame, as_of, hours: int = 24) -> DataFrame:
    start = ts_lit(as_of)
    return hh.filter((F.col("period_start_utc") >= start)
                     & (F.col("period_start_utc") < plus_hours(start, hours)))


def best_slots_24h(hh: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """Rank the coming ``hours`` per region by price and by forecast carbon.

    Ranks are never NULL (NULL keys sort last) and ties break on the period.
    Every region, the national one included, is ranked.
    """
    ranked = forward_window(hh, as_of, hours).select(
        "region_id", "period_start_utc", "period_end_utc", "price_pence_per_kwh_inc_vat",
        "forecast_gco2_per_kwh", cheapest_rank().alias("cheapest_rank"),
        greenest_rank().alias("greenest_rank"))
    return ranked.select(
        "region_id", ts_lit(as_of).alias("computed_at_utc"), "period_start_utc", "period_end_utc",
        "price_pence_per_kwh_inc_vat", "forecast_gco2_per_kwh", "cheapest_rank", "greenest_rank")
