"""The transform build: staging views -> materialised marts -> data checks.

Mirrors the reference's layered build (raw -> staging -> marts, with tests
on every table) as DataFrame functions:

* ``build_staging`` registers lazy temp views (no data moves);
* ``build_marts`` writes the three marts as Parquet, the long mix and the
  joined mart partitioned by day, the 24-hour ranking as one small table;
* ``run_checks`` evaluates every data check of every table (one aggregate
  per table for the row-level ones) and returns one report DataFrame;
  ``quality.check_summary`` turns it into PASS/ERROR counts.
"""

from __future__ import annotations

import os
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession

from halfhourly.functions.columns import utc_naive
from halfhourly.operators import lake, marts, quality
from halfhourly.schemas import FUELS, INTENSITY_BANDS

LAYERS = ("raw", "staging", "marts", "ref")


def layer_table(layer: str, name: str, database_prefix: str = "") -> str:
    """Literal layer names (``raw.carbon_intensity``), optionally prefixed."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer}")
    return f"{database_prefix}{layer}_{name}" if database_prefix else f"{layer}_{name}"


def build_staging(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``raw`` has ``carbon_intensity``, ``agile_price``, ``generation_mix``.
    Returns the staging frames and registers them as temp views."""
    stg = {
        "stg_carbon_intensity": marts.stg_carbon(raw["carbon_intensity"]),
        "stg_agile_price": marts.stg_price(raw["agile_price"]),
        "stg_generation_mix": marts.stg_generation_mix(raw["generation_mix"]),
    }
    for name, df in stg.items():
        df.createOrReplaceTempView(name)
    return stg


def build_marts(raw: dict[str, DataFrame], as_of, out_root: str | None = None) -> dict[str, DataFrame]:
    """Mart frames; with ``out_root`` they are written (overwrite) and read back, so that the
    checks and the 24-hour ranking do not compute them again."""
    hh = marts.half_hourly(raw["carbon_intensity"], raw["agile_price"])
    out = {
        "mart_half_hourly": hh,
        "mart_generation_mix_long": marts.generation_mix_long(raw["generation_mix"]),
        "mart_best_slots_24h": marts.best_slots_24h(hh, as_of),
    }
    if out_root:
        for name in ("mart_half_hourly", "mart_generation_mix_long"):
            (lake.with_day(out[name]).hint("rebalance", lake.DAY).write.mode("overwrite")
             .option("partitionOverwriteMode", "static").partitionBy(lake.DAY)
             .parquet(os.path.join(out_root, name)))
            out[name] = lake.read_table(hh.sparkSession, os.path.join(out_root, name), out[name].schema)
        # the 24-hour mart reads the days it needs from the mart just written
        start = utc_naive(as_of)
        near = lake.read_table(hh.sparkSession, os.path.join(out_root, "mart_half_hourly"), hh.schema,
                               start, start + timedelta(hours=24))
        out["mart_best_slots_24h"] = marts.best_slots_24h(near, as_of)
        (out["mart_best_slots_24h"].hint("rebalance").write.mode("overwrite")
         .parquet(os.path.join(out_root, "mart_best_slots_24h")))
        out["mart_best_slots_24h"] = (hh.sparkSession.read.schema(out["mart_best_slots_24h"].schema)
                                      .parquet(os.path.join(out_root, "mart_best_slots_24h")))
    return out


def run_checks(raw: dict[str, DataFrame], built: dict[str, DataFrame], dim: DataFrame) -> DataFrame:
    """All data checks of the build as one report: one aggregate per table for the row-level
    checks, one grouped count per key, one anti-join per foreign key."""
    carbon, price, mix = raw["carbon_intensity"], raw["agile_price"], raw["generation_mix"]
    hh, long, best = (built[n] for n in ("mart_half_hourly", "mart_generation_mix_long", "mart_best_slots_24h"))
    not_null, key = quality.not_null_checks, ["region_id", "period_start_utc"]
    parts = [
        quality.carbon_row_checks(carbon, more=[quality.regional_actual_null_check()]),
        quality.price_row_checks(price),
        quality.row_checks(mix, "generation_mix", not_null(
            ["period_start_utc", "total_generation_mw", "neso_carbon_intensity_gco2_per_kwh"]) + [quality.component_sum_check()]),
        quality.row_checks(dim, "dno_region", not_null(["region_id", "canonical_code", "slug"])),
        quality.row_checks(hh, "mart_half_hourly", not_null(
            ["region_id", "period_start_utc", "period_end_utc", "forecast_gco2_per_kwh", "intensity_index"])
            + [quality.accepted_values_check("intensity_index", INTENSITY_BANDS), quality.period_order_check()]),
        quality.row_checks(long, "mart_generation_mix_long", not_null(["period_start_utc", "fuel", "mw", "is_renewable"])
                           + [quality.accepted_values_check("fuel", [f for _, f, _ in FUELS])]),
        quality.row_checks(best, "mart_best_slots_24h", not_null([*key, "cheapest_rank", "greenest_rank"])),
        quality.unique_key(carbon, "carbon_intensity", key),
        quality.unique_key(price, "agile_price", key),
        quality.unique_key(mix, "generation_mix", ["period_start_utc"]),
        *[quality.unique_key(dim, "dno_region", [c]) for c in ("region_id", "canonical_code", "slug")],
        quality.unique_key(hh, "mart_half_hourly", key),
        quality.unique_key(long, "mart_generation_mix_long", ["period_start_utc", "fuel"]),
        quality.unique_key(best, "mart_best_slots_24h", key),
        _fk_row(quality.orphans(carbon.select("region_id"), dim, "region_id"), "carbon_intensity"),
        _fk_row(quality.orphans(price.select("region_id"), dim, "region_id"), "agile_price"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _fk_row(orphans: DataFrame, table: str) -> DataFrame:
    from pyspark.sql import functions as F
    return orphans.agg(F.coalesce(F.sum("violations"), F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit("relationships").alias("check"), F.lit(table).alias("table_name"),
        F.lit("region_id").alias("column_name"), "violations")


def build(spark: SparkSession, raw: dict[str, DataFrame], dim: DataFrame, as_of,
          out_root: str | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Staging, marts, checks; returns (marts, check report)."""
    build_staging(raw)
    built = build_marts(raw, as_of, out_root)
    return built, run_checks(raw, built, dim)
