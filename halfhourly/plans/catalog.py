"""Registered queries over the driver tables, each with an oracle SQL twin.

Spark side: the library functions applied to the stand-in tables built by
``sources.adapters`` — whole tables, no sampling.  SQL side: the same
semantics written independently in DuckDB SQL, in the textbook form the
reference uses (``row_number`` dedup, ``UNION ALL`` unpivot, group-by +
join for the share), so a match checks the Spark formulation against a
different one.  Column names and types agree: ranks/counts BIGINT,
instants timestamp_ntz, measures DOUBLE, ids/gCO2 INTEGER.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halfhourly.functions.columns import BAND_THRESHOLDS, sequence_of, ts_lit
from halfhourly.operators import lake, marts, merge, quality
from halfhourly.plans import reads
from halfhourly.schemas import (
    FUELS, HOT_RETENTION_DAYS, INTENSITY_BANDS, PRICE_KEY, ROW_FLOORS, STALENESS_LIMITS_S,
)
from halfhourly.sources import adapters, contracts

AS_OF = "2024-01-15 12:00:00"
ORDERS_AS_OF = "2001-09-01 00:00:00"
RANGE_FROM = "2024-01-08 12:00:00"
RANGE_TO = "2024-01-22 12:00:00"
REFRESH_HOURS = 6          # forecast-only re-read overlapping the stored state
COMPACT_KEEP_DAYS = 7
REGION_CODE = "nation_13"
REGION_SLUG = "nation-7"
LATEST_N = 96


def _dt(s: str) -> datetime:
    return datetime.fromisoformat(s)


def _sql_ts(s: str | datetime) -> str:
    if isinstance(s, datetime):
        s = s.strftime("%Y-%m-%d %H:%M:%S")
    return f"TIMESTAMP '{s}'"


AS_OF_DAY = _dt(AS_OF).replace(hour=0, minute=0, second=0)
A = _sql_ts(AS_OF)


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

class Tables:
    """Lazy DataFrames over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._reads: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """One read (file listing + footer) per table per query."""
        if name not in self._reads:
            self._reads[name] = adapters.table(self.spark, self.sf_dir, name)
        return self._reads[name]

    @property
    def events(self) -> DataFrame:
        return self.raw("events")

    def carbon(self, lo=None, hi=None) -> DataFrame:
        return adapters.carbon_table(self.events, lo, hi)

    def price(self, lo=None, hi=None) -> DataFrame:
        return adapters.price_table(self.events, lo, hi)

    def hh(self, lo=None, hi=None) -> DataFrame:
        return marts.half_hourly(self.carbon(lo, hi), self.price(lo, hi))

    def mix_wide(self) -> DataFrame:
        return adapters.generation_mix_wide(self.events)

    def dim(self) -> DataFrame:
        return adapters.region_dim(self.raw("nation"))


def _best_slots(t: Tables) -> DataFrame:
    hi = _dt(AS_OF) + timedelta(hours=24)
    return marts.best_slots_24h(t.hh(AS_OF, hi), AS_OF)


def q_best_slots_24h(spark, sf_dir):
    return _best_slots(Tables(spark, sf_dir))


def q_cheapest_top3(spark, sf_dir):
    return reads.best_slots(_best_slots(Tables(spark, sf_dir)), rank_col="cheapest_rank", k=3)


def q_greenest_top3(spark, sf_dir):
    return reads.best_slots(_best_slots(Tables(spark, sf_dir)), rank_col="greenest_rank", k=3)


def q_half_hourly_mart(spark, sf_dir):
    return Tables(spark, sf_dir).hh()


def q_generation_mix_long(spark, sf_dir):
    return marts.generation_mix_long(Tables(spark, sf_dir).mix_wide())


def q_generation_mix_current(spark, sf_dir):
    t = Tables(spark, sf_dir)
    wide = t.mix_wide()
    return reads.generation_mix_current(marts.generation_mix_long(wide), latest_source=wide)


def q_period_totals(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return marts.period_totals(marts.stg_generation_mix(t.mix_wide()))


def q_carbon_current(spark, sf_dir):
    return reads.carbon_current(Tables(spark, sf_dir).hh())


def q_carbon_range(spark, sf_dir):
    return reads.carbon_range(Tables(spark, sf_dir).hh(RANGE_FROM, RANGE_TO), f"{RANGE_FROM}Z", f"{RANGE_TO}Z")


def q_price_current(spark, sf_dir):
    return reads.price_current(Tables(spark, sf_dir).price(), AS_OF)


def q_price_range(spark, sf_dir):
    return reads.price_range(Tables(spark, sf_dir).price(RANGE_FROM, RANGE_TO), f"{RANGE_FROM}Z", f"{RANGE_TO}Z")


def q_carbon_trend_24h(spark, sf_dir):
    lo = _dt(AS_OF) - timedelta(hours=24)
    return reads.carbon_trend(Tables(spark, sf_dir).hh(lo, AS_OF), AS_OF, 24)


def q_current_conditions(spark, sf_dir):
    return reads.current_conditions(Tables(spark, sf_dir).hh())


def q_monthly_rollup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return reads.monthly_intensity(adapters.lake_carbon_from_orders(t.raw("orders")), ORDERS_AS_OF)


def q_monthly_rollup_carbon(spark, sf_dir):
    return reads.monthly_intensity(Tables(spark, sf_dir).carbon(), AS_OF)


def q_source_status(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return reads.source_status({"carbon_intensity": t.carbon(), "generation_mix": t.mix_wide(),
                                "agile_price": t.price()})


def _refresh_lo() -> datetime:
    return _dt(AS_OF) - timedelta(hours=REFRESH_HOURS)


def q_upsert_carbon(spark, sf_dir):
    """Stored state = log before ``as_of``; batch = forecast-only re-read of
    the last 6 hours onward (regional feeds carry no actual)."""
    t = Tables(spark, sf_dir)
    log = adapters.carbon_log(t.events)
    current = merge.carbon_from_log(log.filter(F.col("ingested_at_utc") < ts_lit(AS_OF)))
    batch = (log.filter(F.col("ingested_at_utc") >= ts_lit(_refresh_lo()))
             .withColumn("actual_gco2_per_kwh", F.lit(None).cast("int")))
    seq = sequence_of(F.col("ingested_at_utc"), F.col("event_id"))
    return merge.upsert_carbon(current, batch.withColumn("_s", seq).drop("event_id"),
                               AS_OF, F.col("_s"))


def q_upsert_price(spark, sf_dir):
    t = Tables(spark, sf_dir)
    log = adapters.price_log(t.events)
    current = merge.price_from_log(log.filter(F.col("ingested_at_utc") < ts_lit(AS_OF)))
    batch = log.filter(F.col("ingested_at_utc") >= ts_lit(_refresh_lo()))
    seq = sequence_of(F.col("ingested_at_utc"), F.col("event_id"))
    return merge.upsert_replace(current, batch.withColumn("_s", seq).drop("event_id"),
                                PRICE_KEY, AS_OF, F.col("_s"))


def q_as_known_at(spark, sf_dir):
    return merge.as_known_at(adapters.carbon_log(Tables(spark, sf_dir).events), AS_OF)


def q_compact_log(spark, sf_dir):
    return merge.compact_log(adapters.carbon_log(Tables(spark, sf_dir).events), AS_OF,
                             COMPACT_KEEP_DAYS)


def q_archive_day_counts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return lake.archive_day_counts({"carbon_intensity": t.carbon(), "generation_mix": t.mix_wide(),
                                    "agile_price": t.price()}, AS_OF)


def q_retention_90d(spark, sf_dir):
    return lake.apply_retention(Tables(spark, sf_dir).carbon(), AS_OF, HOT_RETENTION_DAYS)


def q_backfill_windows(spark, sf_dir):
    c = Tables(spark, sf_dir).carbon()
    span = c.agg(F.to_date(F.min("period_start_utc")).cast("timestamp_ntz").alias("start"),
                 (F.to_date(F.max("period_start_utc")).cast("timestamp_ntz")
                  + F.expr("INTERVAL 1 DAY")).alias("end"))
    from halfhourly.sources.payloads import plan_windows
    return plan_windows(span)


def q_regions_list(spark, sf_dir):
    return reads.regions(Tables(spark, sf_dir).dim())


def q_region_by_code(spark, sf_dir):
    return reads.region_by_code(Tables(spark, sf_dir).dim(), REGION_CODE)


def q_region_by_slug(spark, sf_dir):
    return reads.region_by_slug(Tables(spark, sf_dir).dim(), REGION_SLUG)


def q_regions_with_code(spark, sf_dir):
    return reads.regions_with_code(Tables(spark, sf_dir).dim())


def q_stg_carbon(spark, sf_dir):
    return marts.stg_carbon(Tables(spark, sf_dir).carbon())


def q_stg_price(spark, sf_dir):
    return marts.stg_price(Tables(spark, sf_dir).price())


def q_dq_not_null(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return quality.carbon_row_checks(t.carbon()).unionByName(quality.price_row_checks(t.price()))


def q_dq_unique_key(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return (quality.unique_key(t.carbon(), "carbon_intensity", ["region_id", "period_start_utc"])
            .unionByName(quality.unique_key(t.price(), "agile_price", ["region_id", "period_start_utc"]))
            .unionByName(quality.unique_key(adapters.carbon_log(t.events), "carbon_log",
                                            ["region_id", "period_start_utc"])))


def q_dq_accepted_values(spark, sf_dir):
    t = Tables(spark, sf_dir)
    long = marts.generation_mix_long(t.mix_wide())
    return (quality.row_checks(t.carbon(), "carbon_intensity",
                               [quality.accepted_values_check("intensity_index", INTENSITY_BANDS)])
            .unionByName(quality.row_checks(long, "mart_generation_mix_long",
                                            [quality.accepted_values_check("fuel", [f for _, f, _ in FUELS])])))


def q_dq_foreign_key(spark, sf_dir):
    t = Tables(spark, sf_dir)
    fact = t.events.select((F.col("user_id") % 30).cast("int").alias("region_id"))
    return quality.orphans(fact, t.dim(), "region_id")


def q_dq_period_order(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return (quality.row_checks(t.carbon(), "carbon_intensity", [quality.period_order_check()])
            .unionByName(quality.row_checks(t.price(), "agile_price",
                                            [quality.period_order_check(), quality.region_bounds_check(),
                                             quality.vat_order_check()])))


def q_dq_grid_gaps(spark, sf_dir):
    return quality.grid_gaps(Tables(spark, sf_dir).carbon())


def q_dq_staleness(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return quality.staleness({"carbon_intensity": t.carbon(), "generation_mix": t.mix_wide(),
                              "agile_price": t.price()}, AS_OF, STALENESS_LIMITS_S)


def q_dq_row_floors(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return quality.row_floors({"carbon_intensity": t.carbon(), "generation_mix": t.mix_wide(),
                               "agile_price": t.price()}, ROW_FLOORS)


def q_dq_component_sum(spark, sf_dir):
    return quality.row_checks(Tables(spark, sf_dir).mix_wide(), "generation_mix",
                              [quality.component_sum_check()])


def q_dq_regional_actual(spark, sf_dir):
    return quality.row_checks(Tables(spark, sf_dir).carbon(), "carbon_intensity",
                              [quality.regional_actual_null_check()])


def q_dq_region_coverage(spark, sf_dir):
    return quality.region_coverage(Tables(spark, sf_dir).price())


def q_dq_fuels_per_period(spark, sf_dir):
    return quality.fuels_per_period(marts.generation_mix_long(Tables(spark, sf_dir).mix_wide()))


def q_batch_profile(spark, sf_dir):
    return quality.batch_profile(Tables(spark, sf_dir).carbon(), "forecast_gco2_per_kwh")


def q_rows_per_day(spark, sf_dir):
    return lake.rows_per_day(Tables(spark, sf_dir).carbon())


def q_json_props_contract(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    return contracts.props_contract(ev, allowed=["k"], required=["k"], id_col="event_id")


def q_latest_generation_rows(spark, sf_dir):
    from halfhourly.sources.payloads import latest_n
    return latest_n(Tables(spark, sf_dir).mix_wide(), LATEST_N)


def q_price_with_region(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return reads.with_region(t.price().select("region_id", "period_start_utc",
                                              "price_pence_per_kwh_inc_vat"), t.dim())


def q_price_at_events(spark, sf_dir):
    """Tariff in force at every event (whole events table)."""
    t = Tables(spark, sf_dir)
    pts = t.events.select(
        "event_id", "ts", (F.col("user_id") % 15).cast("int").alias("region_id"))
    return reads.prices_at(t.price(), pts).select(
        "event_id", "ts", "region_id", "period_start_utc", "price_pence_per_kwh_inc_vat")


def q_dq_check_summary(spark, sf_dir):
    return quality.check_summary(q_dq_not_null(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "best_slots_24h": q_best_slots_24h,
    "cheapest_top3": q_cheapest_top3,
    "greenest_top3": q_greenest_top3,
    "half_hourly_mart": q_half_hourly_mart,
    "generation_mix_long": q_generation_mix_long,
    "generation_mix_current": q_generation_mix_current,
    "period_totals": q_period_totals,
    "carbon_current": q_carbon_current,
    "carbon_range": q_carbon_range,
    "price_current": q_price_current,
    "price_range": q_price_range,
    "carbon_trend_24h": q_carbon_trend_24h,
    "current_conditions": q_current_conditions,
    "monthly_rollup": q_monthly_rollup,
    "monthly_rollup_carbon": q_monthly_rollup_carbon,
    "source_status": q_source_status,
    "upsert_carbon": q_upsert_carbon,
    "upsert_price": q_upsert_price,
    "as_known_at": q_as_known_at,
    "compact_log": q_compact_log,
    "archive_day_counts": q_archive_day_counts,
    "retention_90d": q_retention_90d,
    "backfill_windows": q_backfill_windows,
    "regions_list": q_regions_list,
    "region_by_code": q_region_by_code,
    "region_by_slug": q_region_by_slug,
    "regions_with_code": q_regions_with_code,
    "stg_carbon": q_stg_carbon,
    "stg_price": q_stg_price,
    "dq_not_null": q_dq_not_null,
    "dq_unique_key": q_dq_unique_key,
    "dq_accepted_values": q_dq_accepted_values,
    "dq_foreign_key": q_dq_foreign_key,
    "dq_period_order": q_dq_period_order,
    "dq_grid_gaps": q_dq_grid_gaps,
    "dq_staleness": q_dq_staleness,
    "dq_row_floors": q_dq_row_floors,
    "dq_component_sum": q_dq_component_sum,
    "dq_regional_actual": q_dq_regional_actual,
    "dq_region_coverage": q_dq_region_coverage,
    "dq_fuels_per_period": q_dq_fuels_per_period,
    "batch_profile": q_batch_profile,
    "rows_per_day": q_rows_per_day,
    "json_props_contract": q_json_props_contract,
    "latest_generation_rows": q_latest_generation_rows,
    "price_with_region": q_price_with_region,
    "dq_check_summary": q_dq_check_summary,
    "price_at_events": q_price_at_events,
}


# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB)
# ---------------------------------------------------------------------------

def _band_sql(x: str) -> str:
    b, n = BAND_THRESHOLDS, INTENSITY_BANDS
    return (f"CASE WHEN {x} < {b[0]} THEN '{n[0]}' WHEN {x} < {b[1]} THEN '{n[1]}' "
            f"WHEN {x} < {b[2]} THEN '{n[2]}' WHEN {x} < {b[3]} THEN '{n[3]}' ELSE '{n[4]}' END")


HH = "time_bucket(INTERVAL '30 minutes', ts)"

CARBON_LOG_SQL = f"""
  SELECT CAST(user_id % 15 AS INTEGER) AS region_id,
         {HH} AS period_start_utc,
         {HH} + INTERVAL '30 minutes' AS period_end_utc,
         CAST(floor(value) AS INTEGER) AS forecast_gco2_per_kwh,
         CASE WHEN event_type = 'purchase' THEN CAST(floor(value * CAST(1.1 AS DOUBLE)) AS INTEGER) END
           AS actual_gco2_per_kwh,
         {_band_sql('floor(value)')} AS intensity_index,
         ts AS ingested_at_utc,
         event_id
  FROM events"""

PRICE_LOG_SQL = f"""
  SELECT CAST(user_id % 15 AS INTEGER) AS region_id,
         {HH} AS period_start_utc,
         {HH} + INTERVAL '30 minutes' AS period_end_utc,
         value AS price_pence_per_kwh_inc_vat,
         value / CAST(1.05 AS DOUBLE) AS price_pence_per_kwh_exc_vat,
         ts AS ingested_at_utc,
         event_id
  FROM events
  WHERE event_type IN ('view', 'click') AND user_id % 15 BETWEEN 1 AND 14"""


def _carbon_reduce_sql(log: str) -> str:
    """Newest row per key + newest non-NULL actual, in window-function form."""
    return f"""
  (SELECT r.region_id, r.period_start_utc, r.period_end_utc, r.forecast_gco2_per_kwh,
          a.actual_gco2_per_kwh, r.intensity_index, r.ingested_at_utc
   FROM (SELECT *, row_number() OVER (PARTITION BY region_id, period_start_utc
                                      ORDER BY ingested_at_utc DESC, event_id DESC) AS rn
         FROM {log}) r
   LEFT JOIN (SELECT region_id, period_start_utc, actual_gco2_per_kwh,
                     row_number() OVER (PARTITION BY region_id, period_start_utc
                                        ORDER BY ingested_at_utc DESC, event_id DESC) AS rn
              FROM {log} WHERE actual_gco2_per_kwh IS NOT NULL) a
     ON a.region_id = r.region_id AND a.period_start_utc = r.period_start_utc AND a.rn = 1
   WHERE r.rn = 1)"""


def _price_reduce_sql(log: str) -> str:
    return f"""
  (SELECT region_id, period_start_utc, period_end_utc, price_pence_per_kwh_inc_vat,
          price_pence_per_kwh_exc_vat, ingested_at_utc
   FROM (SELECT *, row_number() OVER (PARTITION BY region_id, period_start_utc
                                      ORDER BY ingested_at_utc DESC, event_id DESC) AS rn
         FROM {log}) WHERE rn = 1)"""


FUEL_SLOTS = ", ".join(
    f"CAST(sum(CASE WHEN event_id % 11 = {i} THEN {'-' if lbl == 'storage' else ''}"
    f"CAST(round(value * 100) AS BIGINT) END) AS DOUBLE) AS {col}"
    for i, (col, lbl, _) in enumerate(FUELS))

BASE_CTES = f"""
carbon_log AS ({CARBON_LOG_SQL}),
carbon AS {_carbon_reduce_sql('carbon_log')},
price_log AS ({PRICE_LOG_SQL}),
price AS {_price_reduce_sql('price_log')},
hh AS (
  SELECT c.region_id, c.period_start_utc, c.period_end_utc, c.forecast_gco2_per_kwh,
         c.actual_gco2_per_kwh, lower(c.intensity_index) AS intensity_index,
         p.price_pence_per_kwh_inc_vat, p.price_pence_per_kwh_exc_vat
  FROM carbon c LEFT JOIN price p
    ON c.region_id = p.region_id AND c.period_start_utc = p.period_start_utc),
mix AS (
  SELECT {HH} AS period_start_utc, {FUEL_SLOTS},
         CAST(sum(CASE WHEN event_id % 11 = 10 THEN -CAST(round(value * 100) AS BIGINT)
                       ELSE CAST(round(value * 100) AS BIGINT) END) AS DOUBLE) AS total_generation_mw,
         CAST(max(floor(value)) AS DOUBLE) AS neso_carbon_intensity_gco2_per_kwh,
         max(ts) AS ingested_at_utc
  FROM events GROUP BY 1),
stg_mix AS (
  {' UNION ALL '.join(f"SELECT period_start_utc, '{lbl}' AS fuel, {col} AS mw, {'true' if ren else 'false'} AS is_renewable FROM mix" for col, lbl, ren in FUELS)}),
mix_totals AS (SELECT period_start_utc, sum(mw) AS total_mw FROM stg_mix GROUP BY 1),
mix_long AS (
  SELECT m.period_start_utc, m.fuel, CAST(m.mw AS DOUBLE) AS mw, m.is_renewable,
         CASE WHEN t.total_mw > 0 THEN 100.0 * CAST(m.mw AS DOUBLE) / t.total_mw END
           AS share_of_generation_pct
  FROM stg_mix m LEFT JOIN mix_totals t USING (period_start_utc)),
dim AS (
  SELECT CAST(n_nationkey AS INTEGER) AS region_id, upper(n_name) AS canonical_code,
         trim(regexp_replace(lower(n_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug,
         n_name AS name,
         CASE WHEN n_nationkey BETWEEN 1 AND 14 THEN CAST(n_nationkey AS INTEGER) END AS carbon_intensity_id,
         CASE WHEN n_nationkey BETWEEN 1 AND 14 THEN substr('ABCDEFGHIJKLMN', n_nationkey, 1) END AS octopus_code
  FROM nation),
best AS (
  SELECT region_id, {A} AS computed_at_utc, period_start_utc, period_end_utc,
         price_pence_per_kwh_inc_vat, forecast_gco2_per_kwh,
         row_number() OVER (PARTITION BY region_id ORDER BY price_pence_per_kwh_inc_vat ASC NULLS LAST,
                            period_start_utc) AS cheapest_rank,
         row_number() OVER (PARTITION BY region_id ORDER BY forecast_gco2_per_kwh ASC NULLS LAST,
                            period_start_utc) AS greenest_rank
  FROM hh
  WHERE period_start_utc >= {A} AND period_start_utc < {A} + INTERVAL '24 hours')
"""


def _with(body: str) -> str:
    """Prefix the shared CTEs; a body that opens with more CTEs extends the list."""
    sep = ",\n" if re.match(r"^\s*[a-z_]+ AS\b", body) else "\n"
    return f"WITH {BASE_CTES}{sep}{body}"


CARBON_POINT_SQL = ("region_id, period_start_utc, period_end_utc, forecast_gco2_per_kwh, "
                    "actual_gco2_per_kwh, intensity_index")
PRICE_POINT_SQL = ("region_id, period_start_utc, period_end_utc, price_pence_per_kwh_inc_vat, "
                   "price_pence_per_kwh_exc_vat")
RF, RT = _sql_ts(RANGE_FROM), _sql_ts(RANGE_TO)
REFRESH = _sql_ts(_refresh_lo())
D1 = _sql_ts(AS_OF_DAY - timedelta(days=2))
D2 = _sql_ts(AS_OF_DAY - timedelta(days=1))


def _status_sql(name: str, tbl: str) -> str:
    return (f"SELECT '{name}' AS source, max(period_start_utc) AS last_period_utc, "
            f"max(ingested_at_utc) AS last_ingest_utc, CAST(count(*) AS BIGINT) AS row_count FROM {tbl}")


def _day_counts_sql(name: str, tbl: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, CAST({d} AS DATE) AS period_day, "
        f"CAST(count(*) FILTER (WHERE period_start_utc >= {d} AND period_start_utc < {d} + INTERVAL 1 DAY) AS BIGINT) AS rows "
        f"FROM {tbl}" for d in (D1, D2))


def _report_sql(check: str, table: str, column: str, pred: str, src: str) -> str:
    return (f"SELECT '{check}' AS \"check\", '{table}' AS table_name, '{column}' AS column_name, "
            f"CAST(count(*) FILTER (WHERE coalesce({pred}, false)) AS BIGINT) AS violations FROM {src}")


def _not_null_sql(table: str, src: str, cols: list[str]) -> list[str]:
    return [_report_sql("not_null", table, c, f"{c} IS NULL", src) for c in cols]


BANDS_SQL = ", ".join(f"'{b}'" for b in INTENSITY_BANDS)
FUEL_LABELS_SQL = ", ".join(f"'{lbl}'" for _, lbl, _ in FUELS)
COMPONENTS_SQL = " + ".join(f"coalesce({c}, 0.0)" for c, _, _ in FUELS)


ORACLE: dict[str, str] = {
    "best_slots_24h": _with("SELECT * FROM best"),
    "cheapest_top3": _with("SELECT * FROM best WHERE cheapest_rank <= 3"),
    "greenest_top3": _with("SELECT * FROM best WHERE greenest_rank <= 3"),
    "half_hourly_mart": _with("SELECT * FROM hh"),
    "generation_mix_long": _with("SELECT * FROM mix_long"),
    "generation_mix_current": _with(
        "SELECT m.* FROM mix_long m, (SELECT max(period_start_utc) AS p FROM mix_long) latest "
        "WHERE m.period_start_utc = latest.p ORDER BY mw DESC"),
    "period_totals": _with("SELECT period_start_utc, sum(mw) AS total_mw FROM stg_mix GROUP BY 1"),
    "carbon_current": _with(
        f"SELECT {CARBON_POINT_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY region_id "
        f"ORDER BY period_start_utc DESC) AS rn FROM hh WHERE intensity_index IS NOT NULL) WHERE rn = 1"),
    "carbon_range": _with(
        f"SELECT {CARBON_POINT_SQL} FROM hh WHERE period_start_utc >= {RF} AND period_start_utc < {RT} "
        f"AND intensity_index IS NOT NULL ORDER BY region_id, period_start_utc"),
    "price_current": _with(
        f"SELECT {PRICE_POINT_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY region_id "
        f"ORDER BY period_start_utc DESC) AS rn FROM price WHERE region_id BETWEEN 1 AND 14 "
        f"AND period_start_utc <= {A} AND period_end_utc > {A}) WHERE rn = 1"),
    "price_range": _with(
        f"SELECT {PRICE_POINT_SQL} FROM price WHERE period_start_utc >= {RF} AND period_start_utc < {RT}"),
    "carbon_trend_24h": _with(
        f"SELECT region_id, period_start_utc, forecast_gco2_per_kwh, actual_gco2_per_kwh, "
        f"strftime(period_start_utc, '%H:%M') AS label FROM hh "
        f"WHERE period_start_utc >= {A} - INTERVAL '24 hours' AND period_start_utc < {A} "
        f"AND intensity_index IS NOT NULL"),
    "current_conditions": _with(
        "SELECT region_id, period_start_utc, intensity_index, "
        "coalesce(actual_gco2_per_kwh, forecast_gco2_per_kwh) AS display_gco2_per_kwh, "
        "actual_gco2_per_kwh IS NULL AS is_forecast, "
        "CASE WHEN intensity_index IN ('very low', 'low') THEN 'ok' WHEN intensity_index = 'moderate' "
        "THEN 'warn' ELSE 'bad' END AS band_class "
        "FROM (SELECT *, row_number() OVER (PARTITION BY region_id ORDER BY period_start_utc DESC) AS rn "
        "FROM hh WHERE intensity_index IS NOT NULL) WHERE rn = 1"),
    "monthly_rollup": f"""
SELECT CAST(date_trunc('month', period_start_utc) AS TIMESTAMP) AS month,
       avg(actual_gco2_per_kwh) AS avg_actual_gco2_per_kwh,
       avg(forecast_gco2_per_kwh) AS avg_forecast_gco2_per_kwh,
       CAST(count(*) AS BIGINT) AS half_hours
FROM (SELECT CAST(o_custkey % 15 AS INTEGER) AS region_id, CAST(o_orderdate AS TIMESTAMP) AS period_start_utc,
             CAST(floor(o_totalprice / 1000) AS INTEGER) AS forecast_gco2_per_kwh,
             CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice / 900) AS INTEGER) END AS actual_gco2_per_kwh
      FROM orders)
WHERE region_id = 0 AND period_start_utc >= {_sql_ts(ORDERS_AS_OF)} - INTERVAL 24 MONTH
GROUP BY 1 ORDER BY 1 DESC LIMIT 24""",
    "monthly_rollup_carbon": _with(f"""
SELECT CAST(date_trunc('month', period_start_utc) AS TIMESTAMP) AS month,
       avg(actual_gco2_per_kwh) AS avg_actual_gco2_per_kwh,
       avg(forecast_gco2_per_kwh) AS avg_forecast_gco2_per_kwh,
       CAST(count(*) AS BIGINT) AS half_hours
FROM carbon WHERE region_id = 0 AND period_start_utc >= {A} - INTERVAL 24 MONTH
GROUP BY 1 ORDER BY 1 DESC LIMIT 24"""),
    "source_status": _with(" UNION ALL ".join([
        _status_sql("carbon_intensity", "carbon"), _status_sql("generation_mix", "mix"),
        _status_sql("agile_price", "price")])),
    "upsert_carbon": _with(f"""
cur AS {_carbon_reduce_sql(f'(SELECT * FROM carbon_log WHERE ingested_at_utc < {A})')},
inc AS (SELECT region_id, period_start_utc, period_end_utc, forecast_gco2_per_kwh,
               CAST(NULL AS INTEGER) AS actual_gco2_per_kwh, intensity_index, ingested_at_utc, event_id
        FROM carbon_log WHERE ingested_at_utc >= {REFRESH}),
inc_new AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY region_id, period_start_utc
                           ORDER BY ingested_at_utc DESC, event_id DESC) AS rn FROM inc) WHERE rn = 1),
inc_act AS (SELECT * FROM (SELECT region_id, period_start_utc, actual_gco2_per_kwh,
                           row_number() OVER (PARTITION BY region_id, period_start_utc
                           ORDER BY ingested_at_utc DESC, event_id DESC) AS rn
                           FROM inc WHERE actual_gco2_per_kwh IS NOT NULL) WHERE rn = 1)
SELECT coalesce(i.region_id, c.region_id) AS region_id,
       coalesce(i.period_start_utc, c.period_start_utc) AS period_start_utc,
       CASE WHEN i.region_id IS NOT NULL THEN i.period_end_utc ELSE c.period_end_utc END AS period_end_utc,
       CASE WHEN i.region_id IS NOT NULL THEN i.forecast_gco2_per_kwh ELSE c.forecast_gco2_per_kwh END
         AS forecast_gco2_per_kwh,
       coalesce(ia.actual_gco2_per_kwh, c.actual_gco2_per_kwh) AS actual_gco2_per_kwh,
       CASE WHEN i.region_id IS NOT NULL THEN i.intensity_index ELSE c.intensity_index END AS intensity_index,
       CASE WHEN i.region_id IS NOT NULL THEN {A} ELSE c.ingested_at_utc END AS ingested_at_utc
FROM cur c
FULL OUTER JOIN inc_new i ON c.region_id = i.region_id AND c.period_start_utc = i.period_start_utc
LEFT JOIN inc_act ia ON ia.region_id = coalesce(i.region_id, c.region_id)
                    AND ia.period_start_utc = coalesce(i.period_start_utc, c.period_start_utc)"""),
    "upsert_price": _with(f"""
cur AS {_price_reduce_sql(f'(SELECT * FROM price_log WHERE ingested_at_utc < {A})')},
inc AS {_price_reduce_sql(f'(SELECT * FROM price_log WHERE ingested_at_utc >= {REFRESH})')}
SELECT coalesce(i.region_id, c.region_id) AS region_id,
       coalesce(i.period_start_utc, c.period_start_utc) AS period_start_utc,
       CASE WHEN i.region_id IS NOT NULL THEN i.period_end_utc ELSE c.period_end_utc END AS period_end_utc,
       CASE WHEN i.region_id IS NOT NULL THEN i.price_pence_per_kwh_inc_vat ELSE c.price_pence_per_kwh_inc_vat END
         AS price_pence_per_kwh_inc_vat,
       CASE WHEN i.region_id IS NOT NULL THEN i.price_pence_per_kwh_exc_vat ELSE c.price_pence_per_kwh_exc_vat END
         AS price_pence_per_kwh_exc_vat,
       CASE WHEN i.region_id IS NOT NULL THEN {A} ELSE c.ingested_at_utc END AS ingested_at_utc
FROM cur c FULL OUTER JOIN inc i ON c.region_id = i.region_id AND c.period_start_utc = i.period_start_utc"""),
    "as_known_at": _with(f"SELECT * FROM {_carbon_reduce_sql(f'(SELECT * FROM carbon_log WHERE ingested_at_utc <= {A})')}"),
    "compact_log": _with(f"""
old AS (SELECT * FROM carbon_log WHERE ingested_at_utc < {A} - INTERVAL {COMPACT_KEEP_DAYS} DAY),
old_new AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY region_id, period_start_utc
            ORDER BY ingested_at_utc DESC, event_id DESC) AS rn FROM old) WHERE rn = 1),
old_act AS (SELECT * FROM (SELECT region_id, period_start_utc, actual_gco2_per_kwh, row_number() OVER
            (PARTITION BY region_id, period_start_utc ORDER BY ingested_at_utc DESC, event_id DESC) AS rn
            FROM old WHERE actual_gco2_per_kwh IS NOT NULL) WHERE rn = 1)
SELECT n.region_id, n.period_start_utc, n.period_end_utc, n.forecast_gco2_per_kwh, a.actual_gco2_per_kwh,
       n.intensity_index, n.ingested_at_utc, n.event_id
FROM old_new n LEFT JOIN old_act a USING (region_id, period_start_utc)
UNION ALL
SELECT * FROM carbon_log WHERE ingested_at_utc >= {A} - INTERVAL {COMPACT_KEEP_DAYS} DAY"""),
    "archive_day_counts": _with(" UNION ALL ".join([
        _day_counts_sql("carbon_intensity", "carbon"), _day_counts_sql("generation_mix", "mix"),
        _day_counts_sql("agile_price", "price")])),
    "retention_90d": _with(
        f"SELECT * FROM carbon WHERE CAST(period_start_utc AS DATE) >= CAST({A} AS DATE) - INTERVAL {HOT_RETENTION_DAYS} DAY"),
    "backfill_windows": _with(f"""
span AS (SELECT date_trunc('day', min(period_start_utc)) AS s,
                date_trunc('day', max(period_start_utc)) + INTERVAL 1 DAY AS e FROM carbon),
k AS (SELECT s, e, unnest(range(0, CAST(ceil((epoch(e) - epoch(s)) / (14 * 86400.0)) AS BIGINT))) AS i
      FROM span),
w AS (SELECT s + to_days(CAST(i * 14 AS INTEGER)) AS ws, least(s + to_days(CAST((i + 1) * 14 AS INTEGER)), e) AS we
      FROM k)
SELECT CAST(ws AS TIMESTAMP) AS window_start_utc, CAST(we AS TIMESTAMP) AS window_end_utc,
       strftime(ws, '%Y-%m-%dT%H:%MZ') AS from_param, strftime(we, '%Y-%m-%dT%H:%MZ') AS to_param
FROM w"""),
    "regions_list": _with("SELECT region_id, canonical_code, slug, name, octopus_code FROM dim ORDER BY region_id"),
    "region_by_code": _with(
        f"SELECT region_id, canonical_code, slug, name, octopus_code FROM dim WHERE canonical_code = upper('{REGION_CODE}')"),
    "region_by_slug": _with(
        f"SELECT region_id, canonical_code, slug, name, octopus_code FROM dim WHERE slug = '{REGION_SLUG}'"),
    "regions_with_code": _with(
        "SELECT region_id, octopus_code FROM dim WHERE octopus_code IS NOT NULL ORDER BY region_id"),
    "stg_carbon": _with(
        "SELECT region_id, period_start_utc, period_end_utc, forecast_gco2_per_kwh, actual_gco2_per_kwh, "
        "lower(intensity_index) AS intensity_index, ingested_at_utc FROM carbon"),
    "stg_price": _with("SELECT * FROM price"),
    "dq_not_null": _with(" UNION ALL ".join(
        _not_null_sql("carbon_intensity", "carbon",
                      ["region_id", "period_start_utc", "period_end_utc", "forecast_gco2_per_kwh",
                       "intensity_index", "ingested_at_utc"])
        + [_report_sql("accepted_values", "carbon_intensity", "intensity_index",
                       f"intensity_index IS NOT NULL AND intensity_index NOT IN ({BANDS_SQL})", "carbon"),
           _report_sql("period_order", "carbon_intensity", "period_end_utc",
                       "period_end_utc <= period_start_utc", "carbon")]
        + _not_null_sql("agile_price", "price",
                        ["region_id", "period_start_utc", "period_end_utc", "price_pence_per_kwh_inc_vat",
                         "price_pence_per_kwh_exc_vat", "ingested_at_utc"])
        + [_report_sql("period_order", "agile_price", "period_end_utc", "period_end_utc <= period_start_utc", "price"),
           _report_sql("region_bounds", "agile_price", "region_id", "NOT (region_id BETWEEN 1 AND 14)", "price"),
           _report_sql("vat_order", "agile_price", "price_pence_per_kwh_inc_vat",
                       "price_pence_per_kwh_inc_vat <= price_pence_per_kwh_exc_vat", "price")])),
    "dq_unique_key": _with(" UNION ALL ".join(
        f"SELECT 'unique_combination_of_columns' AS \"check\", '{name}' AS table_name, "
        f"'region_id,period_start_utc' AS column_name, CAST(count(*) AS BIGINT) AS violations "
        f"FROM (SELECT region_id, period_start_utc FROM {src} GROUP BY 1, 2 HAVING count(*) > 1)"
        for name, src in [("carbon_intensity", "carbon"), ("agile_price", "price"), ("carbon_log", "carbon_log")])),
    "dq_accepted_values": _with(" UNION ALL ".join([
        _report_sql("accepted_values", "carbon_intensity", "intensity_index",
                    f"intensity_index IS NOT NULL AND intensity_index NOT IN ({BANDS_SQL})", "carbon"),
        _report_sql("accepted_values", "mart_generation_mix_long", "fuel",
                    f"fuel IS NOT NULL AND fuel NOT IN ({FUEL_LABELS_SQL})", "mix_long")])),
    "dq_foreign_key": _with(
        "SELECT f.region_id, CAST(count(*) AS BIGINT) AS violations "
        "FROM (SELECT CAST(user_id % 30 AS INTEGER) AS region_id FROM events) f "
        "WHERE NOT EXISTS (SELECT 1 FROM dim d WHERE d.region_id = f.region_id) GROUP BY 1"),
    "dq_period_order": _with(" UNION ALL ".join([
        _report_sql("period_order", "carbon_intensity", "period_end_utc", "period_end_utc <= period_start_utc", "carbon"),
        _report_sql("period_order", "agile_price", "period_end_utc", "period_end_utc <= period_start_utc", "price"),
        _report_sql("region_bounds", "agile_price", "region_id", "NOT (region_id BETWEEN 1 AND 14)", "price"),
        _report_sql("vat_order", "agile_price", "price_pence_per_kwh_inc_vat",
                    "price_pence_per_kwh_inc_vat <= price_pence_per_kwh_exc_vat", "price")])),
    "dq_grid_gaps": _with("""
s AS (SELECT region_id, period_start_utc,
             lead(period_start_utc) OVER (PARTITION BY region_id ORDER BY period_start_utc) AS nxt
      FROM (SELECT DISTINCT region_id, period_start_utc FROM carbon)),
d AS (SELECT region_id, CAST(count(*) FILTER (WHERE n <> 48) AS BIGINT) AS short_days
      FROM (SELECT region_id, CAST(period_start_utc AS DATE) AS dd, count(*) AS n FROM s GROUP BY 1, 2) GROUP BY 1)
SELECT s.region_id, CAST(count(*) AS BIGINT) AS periods,
       CAST(count(*) FILTER (WHERE nxt IS NOT NULL AND nxt <> period_start_utc + INTERVAL 30 MINUTE) AS BIGINT) AS gaps,
       CAST(count(*) FILTER (WHERE minute(period_start_utc) % 30 <> 0 OR second(period_start_utc) <> 0) AS BIGINT) AS off_grid,
       max(d.short_days) AS short_days
FROM s JOIN d USING (region_id) GROUP BY s.region_id"""),
    "dq_staleness": _with(" UNION ALL ".join(
        f"SELECT '{name}' AS source, max(ingested_at_utc) AS last_ingest_utc, "
        f"CAST(trunc(date_diff('microsecond', max(ingested_at_utc), {A}) / 1000000.0) AS BIGINT) AS age_s, "
        f"CAST({STALENESS_LIMITS_S[name]} AS BIGINT) AS limit_s, "
        f"coalesce(trunc(date_diff('microsecond', max(ingested_at_utc), {A}) / 1000000.0) > {STALENESS_LIMITS_S[name]}, true) AS is_stale "
        f"FROM {src}" for name, src in [("carbon_intensity", "carbon"), ("generation_mix", "mix"),
                                        ("agile_price", "price")])),
    "dq_row_floors": _with(" UNION ALL ".join(
        f"SELECT '{name}' AS table_name, CAST(count(*) AS BIGINT) AS row_count, CAST({ROW_FLOORS[name]} AS BIGINT) AS floor, "
        f"count(*) >= {ROW_FLOORS[name]} AS ok FROM {src}"
        for name, src in [("carbon_intensity", "carbon"), ("generation_mix", "mix"), ("agile_price", "price")])),
    "dq_component_sum": _with(_report_sql(
        "component_sum", "generation_mix", "total_generation_mw",
        f"abs(({COMPONENTS_SQL}) - total_generation_mw) > 0.05 * abs(total_generation_mw)", "mix")),
    "dq_regional_actual": _with(_report_sql(
        "regional_actual_null", "carbon_intensity", "actual_gco2_per_kwh",
        "region_id <> 0 AND actual_gco2_per_kwh IS NOT NULL", "carbon")),
    "dq_region_coverage": _with(
        "SELECT period_start_utc, CAST(count(DISTINCT CASE WHEN region_id BETWEEN 1 AND 14 THEN region_id END) AS BIGINT) AS regions, "
        "CAST(count(*) FILTER (WHERE NOT (region_id BETWEEN 1 AND 14)) AS BIGINT) AS outside, "
        "count(DISTINCT CASE WHEN region_id BETWEEN 1 AND 14 THEN region_id END) = 14 "
        "AND count(*) FILTER (WHERE NOT (region_id BETWEEN 1 AND 14)) = 0 AS complete "
        "FROM price GROUP BY 1"),
    "dq_fuels_per_period": _with(
        "SELECT period_start_utc, CAST(count(*) AS BIGINT) AS fuels FROM mix_long GROUP BY 1 HAVING count(*) <> 11"),
    "batch_profile": _with(
        "SELECT CAST(count(*) AS BIGINT) AS rows, max(period_start_utc) AS latest_period_utc, "
        "min(forecast_gco2_per_kwh) AS min_forecast_gco2_per_kwh, max(forecast_gco2_per_kwh) AS max_forecast_gco2_per_kwh, "
        "CAST(count(DISTINCT region_id) AS BIGINT) AS distinct_regions FROM carbon"),
    "rows_per_day": _with(
        "SELECT CAST(period_start_utc AS DATE) AS period_day, CAST(count(*) AS BIGINT) AS rows FROM carbon GROUP BY 1"),
    "json_props_contract": """
SELECT event_id, reason IS NULL AS contract_ok, reason
FROM (SELECT event_id,
             CASE WHEN props IS NULL OR NOT json_valid(props) THEN 'malformed'
                  WHEN json_type(props) <> 'OBJECT' THEN 'malformed'
                  WHEN len(list_filter(json_keys(props), lambda x: x NOT IN ('k'))) > 0 THEN 'unknown_key'
                  WHEN json_extract(props, '$.k') IS NULL OR json_type(json_extract(props, '$.k')) = 'NULL'
                    THEN 'missing_key'
             END AS reason
      FROM events)""",
    "latest_generation_rows": _with(f"SELECT * FROM mix ORDER BY period_start_utc DESC LIMIT {LATEST_N}"),
    "price_with_region": _with(
        "SELECT p.region_id, p.period_start_utc, p.price_pence_per_kwh_inc_vat, d.canonical_code, d.slug, "
        "d.octopus_code FROM price p JOIN dim d ON d.region_id = p.region_id"),
}

ORACLE["price_at_events"] = _with(
    "SELECT e.event_id, e.ts, CAST(e.user_id % 15 AS INTEGER) AS region_id, p.period_start_utc, "
    "p.price_pence_per_kwh_inc_vat FROM events e JOIN price p "
    "ON p.region_id = CAST(e.user_id % 15 AS INTEGER) AND p.period_start_utc <= e.ts AND e.ts < p.period_end_utc")

ORACLE["dq_check_summary"] = (
    ORACLE["dq_not_null"].replace("WITH ", "WITH report AS (WITH ", 1)
    + ")\nSELECT CASE WHEN violations = 0 THEN 'PASS' ELSE 'ERROR' END AS status, "
      "CAST(count(*) AS BIGINT) AS checks FROM report GROUP BY 1")


def _parts() -> list:
    from halfhourly.plans import catalog_analytics, catalog_checks, catalog_landing  # they build on this module
    return [catalog_landing, catalog_checks, catalog_analytics]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = dict(QUERIES)
    for part in _parts():
        out |= part.QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    out = dict(ORACLE)
    for part in _parts():
        out |= part.ORACLE
    return {k: v for k, v in out.items() if k in queries()}
