"""Registered queries of data checks that have something to find, of the whole build's check report,
and of the single-region reads in the order in which they are returned.

The faults are planted by event id on the whole log; the DuckDB twins write labels, flags and limits out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from halfhourly.functions.columns import minute_label, weekday_label
from halfhourly.operators import lake, marts, quality
from halfhourly.plans import build, reads
from halfhourly.plans.catalog import (
    A, AS_OF, CARBON_POINT_SQL, PRICE_POINT_SQL, RANGE_FROM, RANGE_TO, RF, RT, Tables, _best_slots, _dt, _report_sql, _with, timedelta,
)
from halfhourly.sources import adapters

REGION = 5
RETAIN_AS_OF = "2024-04-10 00:00:00"   # 90 days before it lies inside the data


# ---------------------------------------------------------------------------
# planted faults
# ---------------------------------------------------------------------------

def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def _faulty_carbon(t: Tables) -> DataFrame:
    log = adapters.carbon_log(t.events)
    return log.withColumns({
        "forecast_gco2_per_kwh": F.when(~_every(101), F.col("forecast_gco2_per_kwh")),
        "intensity_index": F.when(_every(103), F.lit("extreme")).when(~_every(107), F.col("intensity_index")),
        "period_end_utc": F.when(_every(109), F.col("period_start_utc")).otherwise(F.col("period_end_utc")),
        "ingested_at_utc": F.when(~_every(113), F.col("ingested_at_utc"))})


def _faulty_price(t: Tables) -> DataFrame:
    log = adapters.price_log(t.events)
    return log.withColumns({
        "region_id": F.when(_every(23), F.lit(0)).when(~_every(29), F.col("region_id")).cast("int"),
        "period_end_utc": F.when(_every(31), F.col("period_start_utc")).otherwise(F.col("period_end_utc")),
        "price_pence_per_kwh_exc_vat": F.when(_every(37), F.col("price_pence_per_kwh_inc_vat"))
        .when(~_every(41), F.col("price_pence_per_kwh_exc_vat"))})


def q_dq_faulty_carbon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.carbon_row_checks(_faulty_carbon(Tables(spark, sf_dir)), "carbon_log",
                                     more=[quality.regional_actual_null_check()])


def q_dq_faulty_price(spark, sf_dir):
    return quality.price_row_checks(_faulty_price(Tables(spark, sf_dir)), "price_log")


def q_dq_faulty_summary(spark, sf_dir):
    return quality.check_summary(q_dq_faulty_carbon(spark, sf_dir).unionByName(q_dq_faulty_price(spark, sf_dir)))


def q_dq_faulty_total(spark, sf_dir):
    """Published totals off by 4 % (tolerated) at 02:00 and by 6 % at 03:00."""
    mix, hour = Tables(spark, sf_dir).mix_wide(), F.hour("period_start_utc")
    off = F.when(hour == 3, 1.06).when(hour == 2, 1.04).otherwise(1.0)
    return quality.row_checks(mix.withColumn("total_generation_mw", F.col("total_generation_mw") * off),
                              "generation_mix", [quality.component_sum_check()])


def q_dq_faulty_fuels(spark, sf_dir):
    """Wind is missing at 05:00 and solar doubled at 06:00."""
    long = marts.generation_mix_long(Tables(spark, sf_dir).mix_wide())
    hour = F.hour("period_start_utc")
    times = (F.when((hour == 5) & (F.col("fuel") == "wind"), 0).when((hour == 6) & (F.col("fuel") == "solar"), 2).otherwise(1))
    copies = long.withColumn("copy", F.explode(F.array_repeat(F.lit(1), times))).drop("copy")
    return quality.fuels_per_period(copies)


def q_dq_faulty_labels(spark, sf_dir):
    """Gas goes by another name at 07:00."""
    long = marts.generation_mix_long(Tables(spark, sf_dir).mix_wide())
    named = F.when((F.hour("period_start_utc") == 7) & (F.col("fuel") == "gas"), "methane").otherwise(F.col("fuel"))
    from halfhourly.schemas import FUELS
    return quality.row_checks(long.withColumn("fuel", named), "mart_generation_mix_long",
                              [quality.accepted_values_check("fuel", [f for _, f, _ in FUELS])])


def q_dq_faulty_dimension(spark, sf_dir):
    """One-column keys of the dimension; the slug cut to its first letter repeats."""
    dim = Tables(spark, sf_dir).dim().withColumn("slug", F.substring("slug", 1, 1))
    parts = [quality.unique_key(dim, "dno_region", [c]) for c in ("region_id", "canonical_code", "slug")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_retention_inside(spark, sf_dir):
    return lake.apply_retention(Tables(spark, sf_dir).carbon(), RETAIN_AS_OF)


def q_build_checks(spark, sf_dir):
    """Every check of the transform build in one report."""
    t = Tables(spark, sf_dir)
    raw = {"carbon_intensity": t.carbon(), "agile_price": t.price(), "generation_mix": t.mix_wide()}
    return build.run_checks(raw, build.build_marts(raw, AS_OF), t.dim())


def q_batch_profile_price(spark, sf_dir):
    return quality.batch_profile(Tables(spark, sf_dir).price(), "price_pence_per_kwh_inc_vat")


def q_batch_profile_mix(spark, sf_dir):
    return quality.batch_profile(Tables(spark, sf_dir).mix_wide(), "total_generation_mw")


# ---------------------------------------------------------------------------
# one region, in the order returned
# ---------------------------------------------------------------------------

def _placed(df: DataFrame) -> DataFrame:
    """Adds the row's place; the reads return one region's rows in one ordered partition."""
    return df.withColumn("place", F.monotonically_increasing_id())


def q_carbon_current_region(spark, sf_dir):
    return reads.carbon_current(Tables(spark, sf_dir).hh(), REGION)


def q_carbon_range_region(spark, sf_dir):
    hh = Tables(spark, sf_dir).hh(RANGE_FROM, RANGE_TO)
    return _placed(reads.carbon_range(hh, f"{RANGE_FROM}Z", f"{RANGE_TO}Z", REGION))


def q_carbon_range_offset(spark, sf_dir):
    """The same range asked for in another zone's wall clock."""
    lo, hi = ((_dt(x) + timedelta(hours=1)).isoformat() + "+01:00" for x in (RANGE_FROM, RANGE_TO))
    return reads.carbon_range(Tables(spark, sf_dir).hh(lo, hi), lo, hi)


def q_price_range_region(spark, sf_dir):
    price = Tables(spark, sf_dir).price(RANGE_FROM, RANGE_TO)
    return _placed(reads.price_range(price, f"{RANGE_FROM}Z", f"{RANGE_TO}Z", REGION))


def q_price_current_default(spark, sf_dir):
    """The national page shows the default region's price."""
    return reads.price_current(Tables(spark, sf_dir).price(), AS_OF, reads.price_region(0))


def q_carbon_trend_region(spark, sf_dir):
    lo = _dt(AS_OF) - timedelta(hours=72)
    return _placed(reads.carbon_trend(Tables(spark, sf_dir).hh(lo, AS_OF), AS_OF, 72, REGION))


def q_best_slots_region(spark, sf_dir):
    return _placed(reads.best_slots(_best_slots(Tables(spark, sf_dir)), REGION))


def q_best_slots_offset(spark, sf_dir):
    """The flagship asked for at the same instant with another offset."""
    as_of = "2024-01-15T14:00:00+02:00"
    hi = _dt(AS_OF) + timedelta(hours=24)
    return marts.best_slots_24h(Tables(spark, sf_dir).hh(as_of, hi), as_of)


def q_slot_labels(spark, sf_dir):
    start = F.col("period_start_utc")
    return _best_slots(Tables(spark, sf_dir)).select(
        "region_id", "period_start_utc", weekday_label(start).alias("weekday_label"), minute_label(start).alias("minute_label"))


# ---------------------------------------------------------------------------
# DuckDB twins
# ---------------------------------------------------------------------------

_BANDS = "'very low', 'low', 'moderate', 'high', 'very high'"
_LABELS = "'gas', 'coal', 'nuclear', 'wind', 'wind_emb', 'hydro', 'imports', 'biomass', 'other', 'solar', 'storage'"
_PARTS = " + ".join(f"coalesce({c}_mw, 0.0)" for c in (
    "gas", "coal", "nuclear", "wind", "wind_embedded", "hydro", "imports", "biomass", "other", "solar", "storage"))

_FAULTY = """
faulty_carbon AS (
  SELECT * REPLACE (
    CASE WHEN event_id % 101 <> 0 THEN forecast_gco2_per_kwh END AS forecast_gco2_per_kwh,
    CASE WHEN event_id % 103 = 0 THEN 'extreme' WHEN event_id % 107 <> 0 THEN intensity_index END AS intensity_index,
    CASE WHEN event_id % 109 = 0 THEN period_start_utc ELSE period_end_utc END AS period_end_utc,
    CASE WHEN event_id % 113 <> 0 THEN ingested_at_utc END AS ingested_at_utc) FROM carbon_log),
faulty_price AS (
  SELECT * REPLACE (
    CASE WHEN event_id % 23 = 0 THEN 0 WHEN event_id % 29 <> 0 THEN region_id END AS region_id,
    CASE WHEN event_id % 31 = 0 THEN period_start_utc ELSE period_end_utc END AS period_end_utc,
    CASE WHEN event_id % 37 = 0 THEN price_pence_per_kwh_inc_vat
         WHEN event_id % 41 <> 0 THEN price_pence_per_kwh_exc_vat END AS price_pence_per_kwh_exc_vat) FROM price_log)"""


def _nulls(table: str, src: str, *cols: str) -> list[str]:
    return [_report_sql("not_null", table, c, f"{c} IS NULL", src) for c in cols]


def _order(table: str, src: str) -> str:
    return _report_sql("period_order", table, "period_end_utc", "period_end_utc <= period_start_utc", src)


def _bands(table: str, src: str) -> str:
    return _report_sql("accepted_values", table, "intensity_index", f"intensity_index NOT IN ({_BANDS})", src)


def _labels(src: str) -> str:
    return _report_sql("accepted_values", "mart_generation_mix_long", "fuel", f"fuel NOT IN ({_LABELS})", src)


def _carbon_checks(table: str, src: str) -> list[str]:
    return [*_nulls(table, src, "region_id", "period_start_utc", "period_end_utc", "forecast_gco2_per_kwh", "intensity_index",
                    "ingested_at_utc"),
            _bands(table, src), _order(table, src),
            _report_sql("regional_actual_null", table, "actual_gco2_per_kwh", "region_id <> 0 AND actual_gco2_per_kwh IS NOT NULL", src)]


def _price_checks(table: str, src: str) -> list[str]:
    return [*_nulls(table, src, "region_id", "period_start_utc", "period_end_utc", "price_pence_per_kwh_inc_vat",
                    "price_pence_per_kwh_exc_vat", "ingested_at_utc"),
            _order(table, src),
            _report_sql("region_bounds", table, "region_id", "NOT (region_id BETWEEN 1 AND 14)", src),
            _report_sql("vat_order", table, "price_pence_per_kwh_inc_vat",
                        "price_pence_per_kwh_inc_vat <= price_pence_per_kwh_exc_vat", src)]


def _unique(table: str, src: str, *cols: str) -> str:
    names = ", ".join(cols)
    return (f"SELECT 'unique_combination_of_columns' AS \"check\", '{table}' AS table_name, '{','.join(cols)}' AS column_name, "
            f"CAST(count(*) AS BIGINT) AS violations FROM (SELECT {names} FROM {src} GROUP BY {names} HAVING count(*) > 1)")


def _relation(table: str, src: str) -> str:
    return (f"SELECT 'relationships' AS \"check\", '{table}' AS table_name, 'region_id' AS column_name, "
            f"CAST(count(*) AS BIGINT) AS violations FROM {src} f WHERE NOT EXISTS (SELECT 1 FROM dim d WHERE d.region_id = f.region_id)")


def _component(src: str) -> str:
    return _report_sql("component_sum", "generation_mix", "total_generation_mw",
                       f"abs(({_PARTS}) - total_generation_mw) > 0.05 * abs(total_generation_mw)", src)


_KEY = ("region_id", "period_start_utc")
_BUILD = [
    *_carbon_checks("carbon_intensity", "carbon"), *_price_checks("agile_price", "price"),
    *_nulls("generation_mix", "mix", "period_start_utc", "total_generation_mw", "neso_carbon_intensity_gco2_per_kwh"),
    _component("mix"),
    *_nulls("dno_region", "dim", "region_id", "canonical_code", "slug"),
    *_nulls("mart_half_hourly", "hh", "region_id", "period_start_utc", "period_end_utc", "forecast_gco2_per_kwh", "intensity_index"),
    _bands("mart_half_hourly", "hh"), _order("mart_half_hourly", "hh"),
    *_nulls("mart_generation_mix_long", "mix_long", "period_start_utc", "fuel", "mw", "is_renewable"), _labels("mix_long"),
    *_nulls("mart_best_slots_24h", "best", *_KEY, "cheapest_rank", "greenest_rank"),
    _unique("carbon_intensity", "carbon", *_KEY), _unique("agile_price", "price", *_KEY),
    _unique("generation_mix", "mix", "period_start_utc"),
    *[_unique("dno_region", "dim", c) for c in ("region_id", "canonical_code", "slug")],
    _unique("mart_half_hourly", "hh", *_KEY), _unique("mart_generation_mix_long", "mix_long", "period_start_utc", "fuel"),
    _unique("mart_best_slots_24h", "best", *_KEY),
    _relation("carbon_intensity", "carbon"), _relation("agile_price", "price"),
]
_FAULTY_CARBON = " UNION ALL ".join(_carbon_checks("carbon_log", "faulty_carbon"))
_FAULTY_PRICE = " UNION ALL ".join(_price_checks("price_log", "faulty_price"))
_PLACE = "CAST(row_number() OVER (ORDER BY period_start_utc) - 1 AS BIGINT) AS place"


def _profile(src: str, col: str, regions: bool) -> str:
    more = ", CAST(count(DISTINCT region_id) AS BIGINT) AS distinct_regions" if regions else ""
    return (f"SELECT CAST(count(*) AS BIGINT) AS rows, max(period_start_utc) AS latest_period_utc, min({col}) AS min_{col}, "
            f"max({col}) AS max_{col}{more} FROM {src}")


ORACLE: dict[str, str] = {
    "dq_faulty_carbon": _with(f"{_FAULTY}\n{_FAULTY_CARBON}"),
    "dq_faulty_price": _with(f"{_FAULTY}\n{_FAULTY_PRICE}"),
    "dq_faulty_summary": _with(f"""{_FAULTY},
report AS ({_FAULTY_CARBON} UNION ALL {_FAULTY_PRICE})
SELECT CASE WHEN violations = 0 THEN 'PASS' ELSE 'ERROR' END AS status, CAST(count(*) AS BIGINT) AS checks FROM report GROUP BY 1"""),
    "dq_faulty_total": _with(f"""
off AS (SELECT * REPLACE (total_generation_mw * CASE hour(period_start_utc) WHEN 3 THEN CAST(1.06 AS DOUBLE)
                          WHEN 2 THEN CAST(1.04 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS total_generation_mw) FROM mix)
{_component("off")}"""),
    "dq_faulty_fuels": _with("""
copies AS (
  SELECT * FROM mix_long WHERE NOT (hour(period_start_utc) = 5 AND fuel = 'wind')
  UNION ALL SELECT * FROM mix_long WHERE hour(period_start_utc) = 6 AND fuel = 'solar')
SELECT period_start_utc, CAST(count(*) AS BIGINT) AS fuels FROM copies GROUP BY 1 HAVING count(*) <> 11"""),
    "dq_faulty_labels": _with(f"""
named AS (SELECT * REPLACE (CASE WHEN hour(period_start_utc) = 7 AND fuel = 'gas' THEN 'methane' ELSE fuel END AS fuel) FROM mix_long)
{_labels("named")}"""),
    "dq_faulty_dimension": _with(
        "short AS (SELECT * REPLACE (substr(slug, 1, 1) AS slug) FROM dim)\n"
        + " UNION ALL ".join(_unique("dno_region", "short", c) for c in ("region_id", "canonical_code", "slug"))),
    "retention_inside": _with("SELECT * FROM carbon WHERE period_start_utc >= TIMESTAMP '2024-01-11 00:00:00'"),
    "build_checks": _with(" UNION ALL ".join(_BUILD)),
    "batch_profile_price": _with(_profile("price", "price_pence_per_kwh_inc_vat", True)),
    "batch_profile_mix": _with(_profile("mix", "total_generation_mw", False)),
    "carbon_current_region": _with(
        f"SELECT {CARBON_POINT_SQL} FROM hh WHERE region_id = {REGION} AND intensity_index IS NOT NULL "
        "ORDER BY period_start_utc DESC LIMIT 1"),
    "carbon_range_region": _with(
        f"SELECT {CARBON_POINT_SQL}, {_PLACE} FROM hh WHERE region_id = {REGION} AND period_start_utc >= {RF} AND period_start_utc < {RT} "
        "AND intensity_index IS NOT NULL"),
    "carbon_range_offset": _with(
        f"SELECT {CARBON_POINT_SQL} FROM hh WHERE period_start_utc >= {RF} AND period_start_utc < {RT} AND intensity_index IS NOT NULL"),
    "price_range_region": _with(
        f"SELECT {PRICE_POINT_SQL}, {_PLACE} FROM price WHERE region_id = {REGION} AND period_start_utc >= {RF} AND period_start_utc < {RT}"),
    "price_current_default": _with(
        f"SELECT {PRICE_POINT_SQL} FROM price WHERE region_id = 13 AND period_start_utc <= {A} AND period_end_utc > {A} "
        "ORDER BY period_start_utc DESC LIMIT 1"),
    "carbon_trend_region": _with(
        f"SELECT region_id, period_start_utc, forecast_gco2_per_kwh, actual_gco2_per_kwh, "
        f"strftime(period_start_utc, '%H:%M') AS label, {_PLACE} FROM hh WHERE region_id = {REGION} "
        f"AND period_start_utc >= {A} - INTERVAL '72 hours' AND period_start_utc < {A} AND intensity_index IS NOT NULL"),
    "best_slots_region": _with(f"SELECT *, {_PLACE} FROM best WHERE region_id = {REGION}"),
    "best_slots_offset": _with("SELECT * FROM best"),
    "slot_labels": _with("SELECT region_id, period_start_utc, strftime(period_start_utc, '%a %H:%M') AS weekday_label, "
                         "strftime(period_start_utc, '%Y-%m-%d %H:%M') AS minute_label FROM best"),
}

QUERIES = {name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_")}
