"""Data-quality checks.

Each check yields rows ``(check, table_name, column_name, violations BIGINT)``.
Checks that are row predicates (not-null, accepted values, period order,
bounds, VAT order, component sum, regional actual) are folded into ONE
aggregate per table, so a table is scanned once for all of them.  Checks that
need grouping (unique keys, grid, coverage) are a single partial-aggregated
``groupBy`` each; foreign keys are an anti-join against the dimension.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from halfhourly.functions.columns import plus_minutes, ts_lit
from halfhourly.schemas import (
    COMPONENT_SUM_TOLERANCE, FIRST_DNO_REGION_ID, FUELS, INTENSITY_BANDS, LAST_DNO_REGION_ID,
    NATIONAL_REGION_ID,
)

REPORT_COLS = ["check", "table_name", "column_name", "violations"]


def _report(df: DataFrame, table: str, checks: list[tuple[str, str, Column]]) -> DataFrame:
    """Evaluate ``(check, column, violation predicate)`` triples in one pass and
    return them as rows."""
    counts = df.agg(*[F.count_if(F.coalesce(pred, F.lit(False))).cast("bigint").alias(f"c{i}")
                      for i, (_, _, pred) in enumerate(checks)])
    stacked = F.inline(F.array(*[
        F.struct(F.lit(chk).alias("check"), F.lit(table).alias("table_name"),
                 F.lit(col).alias("column_name"), F.col(f"c{i}").alias("violations"))
        for i, (chk, col, _) in enumerate(checks)]))
    return counts.select(stacked)


def not_null_checks(cols: Sequence[str]) -> list[tuple[str, str, Column]]:
    return [("not_null", c, F.col(c).isNull()) for c in cols]


def accepted_values_check(col: str, values: Sequence[str]) -> tuple[str, str, Column]:
    return ("accepted_values", col, F.col(col).isNotNull() & ~F.col(col).isin(*values))


def period_order_check() -> tuple[str, str, Column]:
    return ("period_order", "period_end_utc", F.col("period_end_utc") <= F.col("period_start_utc"))


def region_bounds_check(lo: int = FIRST_DNO_REGION_ID, hi: int = LAST_DNO_REGION_ID):
    return ("region_bounds", "region_id", ~F.col("region_id").between(lo, hi))


def vat_order_check():
    return ("vat_order", "price_pence_per_kwh_inc_vat",
            F.col("price_pence_per_kwh_inc_vat") <= F.col("price_pence_per_kwh_exc_vat"))


def regional_actual_null_check():
    return ("regional_actual_null", "actual_gco2_per_kwh",
            (F.col("region_id") != NATIONAL_REGION_ID) & F.col("actual_gco2_per_kwh").isNotNull())


def component_sum_check(tol: float = COMPONENT_SUM_TOLERANCE):
    """Published total within ``tol`` (relative) of the sum of the 11 fuels."""
    parts = sum((F.coalesce(F.col(c), F.lit(0.0)) for c, _, _ in FUELS), F.lit(0.0))
    total = F.col("total_generation_mw")
    return ("component_sum", "total_generation_mw",
            F.abs(parts - total) > F.lit(tol) * F.abs(total))


def row_checks(df: DataFrame, table: str, checks: list[tuple[str, str, Column]]) -> DataFrame:
    return _report(df, table, checks)


def carbon_row_checks(carbon: DataFrame, table: str = "carbon_intensity", more: Sequence[tuple[str, str, Column]] = ()) -> DataFrame:
    cols = ["region_id", "period_start_utc", "period_end_utc", "forecast_gco2_per_kwh",
            "intensity_index", "ingested_at_utc"]
    return _report(carbon, table, not_null_checks(cols) + [
        accepted_values_check("intensity_index", INTENSITY_BANDS), period_order_check(), *more])


def price_row_checks(price: DataFrame, table: str = "agile_price") -> DataFrame:
    cols = ["region_id", "period_start_utc", "period_end_utc", "price_pence_per_kwh_inc_vat",
            "price_pence_per_kwh_exc_vat", "ingested_at_utc"]
    return _report(price, table, not_null_checks(cols) + [
        period_order_check(), region_bounds_check(), vat_order_check()])


def mix_row_checks(mix: DataFrame, table: str = "generation_mix") -> DataFrame:
    return _report(mix, table, not_null_checks(
        ["period_start_utc", *[c for c, _, _ in FUELS], "total_generation_mw", "neso_carbon_intensity_gco2_per_kwh",
         "ingested_at_utc"]) + [component_sum_check()])


def unique_key(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Number of key values that occur more than once."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).cast("bigint").alias("violations")).select(
        F.lit("unique_combination_of_columns").alias("check"), F.lit(table).alias("table_name"),
        F.lit(",".join(keys)).alias("column_name"), "violations")


def broadcast_if_small(df: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """Broadcast a dimension only after proving its size (one tiny count);
    above the bound the planner keeps a shuffled join."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Foreign-key violations: per missing key value, the number of fact rows."""
    d = broadcast_if_small(dim.select(key).distinct())
    return (fact.join(d, key, "left_anti").groupBy(key)
            .agg(F.count(F.lit(1)).cast("bigint").alias("violations")))


def grid_gaps(df: DataFrame, keys: Sequence[str] = ("region_id",), minutes: int = 30,
              per_day: int = 48) -> DataFrame:
    """Per series: periods, breaks in the 30-minute grid (consecutive periods
    not exactly ``minutes`` apart), off-grid starts, and UTC days whose
    period count is not ``per_day``.

    Plan: de-duplicate ``(key, period)`` (partial aggregation absorbs any raw
    duplicates), then one ``lead`` window per series and month, so a long archive spreads
    over series x months tasks and none holds more than a month's
    half-hours of one series; the breaks between months come from the first and last
    period of each month (twelve rows a year and series).
    """
    keys = list(keys)
    p = df.select(*keys, "period_start_utc").dropDuplicates()
    day = F.to_date("period_start_utc")
    month = F.trunc(day, "month")
    nxt = F.lead("period_start_utc").over(Window.partitionBy(*keys, month).orderBy("period_start_utc"))
    step = plus_minutes(F.col("period_start_utc"), minutes)
    off_grid = (F.minute("period_start_utc") % minutes != 0) | (F.second("period_start_utc") != 0)
    flagged = p.select(*keys, month.alias("_m"), day.alias("_d"), "period_start_utc",
                       (nxt.isNotNull() & (nxt != step)).alias("_break"), off_grid.alias("_off"))
    days = flagged.groupBy(*keys, "_m", "_d").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("_off").alias("og"), F.count_if("_break").alias("nb"),
        F.min("period_start_utc").alias("lo"), F.max("period_start_utc").alias("hi"))
    months = days.groupBy(*keys, "_m").agg(
        F.sum("n").alias("n"), F.sum("og").alias("og"), F.sum("nb").alias("nb"),
        F.count_if(F.col("n") != per_day).alias("short"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    following = F.lead("lo").over(Window.partitionBy(*keys).orderBy("_m"))
    edge = (following.isNotNull() & (following != plus_minutes(F.col("hi"), minutes))).cast("int")
    return months.withColumn("edge", edge).groupBy(*keys).agg(
        F.sum("n").cast("bigint").alias("periods"),
        F.sum(F.col("nb") + F.col("edge")).cast("bigint").alias("gaps"),
        F.sum("og").cast("bigint").alias("off_grid"),
        F.sum("short").cast("bigint").alias("short_days"))


def staleness(tables: dict[str, DataFrame], as_of, limits: dict[str, int]) -> DataFrame:
    """Seconds since the newest ingest per source at ``as_of`` vs its limit."""
    parts = []
    for name, df in tables.items():
        # seconds between two TIMESTAMP_NTZ values: no session time zone involved
        age = F.timestamp_diff("SECOND", F.max("ingested_at_utc"), ts_lit(as_of))
        parts.append(df.agg(F.max("ingested_at_utc").alias("last_ingest_utc"),
                            age.cast("bigint").alias("age_s"))
                     .select(F.lit(name).alias("source"), "last_ingest_utc", "age_s",
                             F.lit(limits[name]).cast("bigint").alias("limit_s")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("is_stale", F.coalesce(F.col("age_s") > F.col("limit_s"), F.lit(True)))


def row_floors(tables: dict[str, DataFrame], floors: dict[str, int]) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count",
                     F.lit(floors[name]).cast("bigint").alias("floor"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("ok", F.col("row_count") >= F.col("floor"))


def region_coverage(df: DataFrame, lo: int = FIRST_DNO_REGION_ID, hi: int = LAST_DNO_REGION_ID) -> DataFrame:
    """Per period: regions present in ``[lo, hi]`` and whether all are there."""
    inside = F.col("region_id").between(lo, hi)
    return (df.groupBy("period_start_utc")
            .agg(F.count_distinct(F.when(inside, F.col("region_id"))).cast("bigint").alias("regions"),
                 F.count_if(~inside).cast("bigint").alias("outside"))
            .withColumn("complete", (F.col("regions") == hi - lo + 1) & (F.col("outside") == 0)))


def fuels_per_period(mix_long: DataFrame, expected: int = len(FUELS)) -> DataFrame:
    """Periods of the long mart without exactly ``expected`` fuel rows."""
    return (mix_long.groupBy("period_start_utc").agg(F.count(F.lit(1)).cast("bigint").alias("fuels"))
            .filter(F.col("fuels") != expected))


def check_summary(report: DataFrame) -> DataFrame:
    """PASS/ERROR counts of a check report."""
    status = F.when(F.col("violations") == 0, "PASS").otherwise("ERROR")
    return report.groupBy(status.alias("status")).agg(F.count(F.lit(1)).cast("bigint").alias("checks"))


def batch_profile(df: DataFrame, value_col: str) -> DataFrame:
    """Rows, newest period, min/max of a value column, distinct regions."""
    aggs = [F.count(F.lit(1)).cast("bigint").alias("rows"),
            F.max("period_start_utc").alias("latest_period_utc"),
            F.min(value_col).alias(f"min_{value_col}"), F.max(value_col).alias(f"max_{value_col}")]
    if "region_id" in df.columns:
        aggs.append(F.count_distinct("region_id").cast("bigint").alias("distinct_regions"))
    return df.agg(*aggs)
