"""Registered queries of the late-data stream, the stored rollups and the analyses on top of the
marts, each with its DuckDB twin, over whole driver tables.
"""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halfhourly.functions.columns import half_hour, ts_lit
from halfhourly.operators import alerts, crosscheck, forecast, fuel_buckets, instants, lake, rollups, schedule, seasonal, versions
from halfhourly.plans.catalog import A, AS_OF, CARBON_LOG_SQL, HH, Tables, _carbon_reduce_sql, _dt, _with
from halfhourly.schemas import ALERT_HOLD_S, FUEL_BUCKETS, FUELS, STALENESS_LIMITS_S
from halfhourly.plans.catalog_landing import _MIX, _PRICES, _REGIONAL, _SLOT
from halfhourly.session import scratch_path
from halfhourly.sources import adapters, documents, drift
from halfhourly.streaming import late

WAVES = 3  # scheduled polls over the replayed month


# ---------------------------------------------------------------------------
# late data
# ---------------------------------------------------------------------------

#: Arrival of an observation after its instant, by ``event_id % 7``: a day late, past the deadline, ten minutes, at once.
DELAY_MINUTES = {0: 26 * 60, 1: 3 * 24 * 60, 2: 10}


def _arrival(instant: str):
    delay = F.lit(0)
    for k, minutes in DELAY_MINUTES.items():
        delay = F.when(F.col("event_id") % 7 == k, minutes).otherwise(delay)
    return F.timestamp_add("MINUTE", delay, F.col(instant))


def delayed_log(events: DataFrame) -> DataFrame:
    """The observation log as it would land if some senders were slow."""
    return adapters.carbon_log(events).withColumn("ingested_at_utc", _arrival("ingested_at_utc"))


def replay(t: Tables, waves: int = WAVES) -> str:
    """Land the delayed log wave by wave (a wave is a stretch of arrival days) and poll after each, the same
    checkpoint throughout; returns the streams' output folder."""
    root = scratch_path(t.spark, f"late-{uuid.uuid4().hex}")
    log = delayed_log(t.events)
    first, last = log.agg(F.min(F.to_date("ingested_at_utc")), F.max(F.to_date("ingested_at_utc"))).first()
    if first is None:
        log.write.parquet(f"{root}/landed")
        late.run(t.spark, f"{root}/landed", f"{root}/out")
        return f"{root}/out"
    step = -(-((last - first).days + 1) // waves)
    for k in range(waves):
        lo, hi = first + timedelta(days=step * k), first + timedelta(days=step * (k + 1))
        day = F.to_date("ingested_at_utc")
        log.filter((day >= F.lit(lo)) & (day < F.lit(hi))).write.mode("append").parquet(f"{root}/landed")
        late.run(t.spark, f"{root}/landed", f"{root}/out")
    return f"{root}/out"


def q_late_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return late.read_closed(spark, replay(t))


def q_late_rows(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return late.late_counts(late.read_late(spark, replay(t)))


_DELAY_SQL = "CASE event_id % 7 " + " ".join(
    f"WHEN {k} THEN INTERVAL '{m} minutes'" for k, m in DELAY_MINUTES.items()) + " ELSE INTERVAL '0 minutes' END"
_LANDED_SQL = f"""log AS (SELECT * REPLACE (ingested_at_utc + {_DELAY_SQL} AS ingested_at_utc) FROM ({CARBON_LOG_SQL})),
in_time AS (SELECT * FROM log WHERE ingested_at_utc < period_end_utc + INTERVAL '2 days')"""

LATE_CLOSED_SQL = f"""WITH {_LANDED_SQL},
mark AS (SELECT max(period_end_utc) - INTERVAL '2 days 30 minutes' AS at FROM in_time),
n AS (SELECT region_id, period_start_utc, CAST(count(*) AS BIGINT) AS versions FROM in_time GROUP BY 1, 2)
SELECT r.*, versions FROM {_carbon_reduce_sql("in_time")} r JOIN n USING (region_id, period_start_utc), mark
WHERE r.period_end_utc <= mark.at"""

LATE_ROWS_SQL = f"""WITH {_LANDED_SQL}
SELECT region_id, CAST(period_start_utc AS DATE) AS period_day, CAST(count(*) AS BIGINT) AS late,
       CAST(max(date_diff('second', period_end_utc, ingested_at_utc)) AS BIGINT) AS longest_delay_s
FROM log WHERE NOT (ingested_at_utc < period_end_utc + INTERVAL '2 days') GROUP BY 1, 2"""


# ---------------------------------------------------------------------------
# stored hourly states, refreshed in part
# ---------------------------------------------------------------------------

REFRESH_AT = "2024-01-20 06:00:00"  # what arrives from here on is the late batch


def sender_log(events: DataFrame) -> DataFrame:
    """Single readings with their sender and (delayed) arrival."""
    return events.select(
        (F.col("user_id") % adapters.N_REGIONS).cast("int").alias("region_id"), F.col("ts").alias("period_start_utc"),
        F.floor("value").cast("bigint").alias("reading"), F.col("user_id").alias("sender"), _arrival("ts").alias("ingested_at_utc"))


def _refreshed(t: Tables) -> str:
    """Hourly states of what had arrived by REFRESH_AT, then the days of the late batch rebuilt; the states' folder."""
    path = scratch_path(t.spark, f"rollup-{uuid.uuid4().hex}")
    log = sender_log(t.events)
    first, batch = (log.filter(c) for c in (F.col("ingested_at_utc") < ts_lit(REFRESH_AT), F.col("ingested_at_utc") >= ts_lit(REFRESH_AT)))
    rollups.rebuild(first, path, rollups.touched_days(first), "reading", "sender", build=0)
    rollups.rebuild(log, path, rollups.touched_days(batch), "reading", "sender", build=1)
    return path


def _daily(t: Tables) -> DataFrame:
    return rollups.merge_states(rollups.read_states(t.spark, _refreshed(t)), "region_id", "period_day")


def q_rollup_daily(spark, sf_dir):
    """Daily measures merged from hourly states after a partial refresh; ``build`` tells which days it rewrote."""
    return rollups.measures(_daily(Tables(spark, sf_dir))).drop("senders", "p50")


def q_rollup_monthly(spark, sf_dir):
    t = Tables(spark, sf_dir)
    month = F.date_trunc("month", "hour_utc").cast("timestamp_ntz").alias("month")
    return rollups.measures(rollups.merge_states(rollups.read_states(spark, _refreshed(t)), month)).drop("senders", "p50")


def q_rollup_sketches(spark, sf_dir):
    """The sketches' estimates of a day held against the raw rows: distinct senders within 8 %, the median's rank within 5 %."""
    t = Tables(spark, sf_dir)
    day = rollups.measures(_daily(t)).select("region_id", "period_day", "senders", "p50")
    raw = sender_log(t.events).select("region_id", F.to_date("period_start_utc").alias("period_day"), "sender", "reading")
    held = raw.join(day, ["region_id", "period_day"]).groupBy("region_id", "period_day").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.count_distinct("sender").alias("exact"), F.max("senders").alias("senders"),
        F.count_if(F.col("reading") < F.col("p50")).alias("below"), F.count_if(F.col("reading") <= F.col("p50")).alias("upto"))
    return held.select("region_id", "period_day", "n",
                       (F.abs(F.col("senders") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.08 * F.col("exact"))).alias("senders_close"),
                       ((F.col("below") <= 0.55 * F.col("n") + 1) & (F.col("upto") >= 0.45 * F.col("n") - 1)).alias("median_close"))


_SENDERS_SQL = f"""log AS (SELECT CAST(user_id % 15 AS INTEGER) AS region_id, CAST(ts AS DATE) AS period_day,
  date_trunc('month', ts) AS month, CAST(floor(value) AS BIGINT) AS reading, ts + {_DELAY_SQL} >= TIMESTAMP '{REFRESH_AT}' AS late
  FROM events), touched AS (SELECT DISTINCT period_day FROM log WHERE late)"""
_MEASURES_SQL = """CAST(count(reading) AS BIGINT) AS n, CAST(sum(reading) AS BIGINT) AS total, min(reading) AS least,
  max(reading) AS greatest, CAST(max(CASE WHEN period_day IN (SELECT period_day FROM touched) THEN 1 ELSE 0 END) AS INTEGER) AS build,
  CAST(sum(reading) AS DOUBLE) / count(reading) AS mean"""

ROLLUP_DAILY_SQL = f"WITH {_SENDERS_SQL} SELECT region_id, period_day, {_MEASURES_SQL} FROM log GROUP BY ALL"
ROLLUP_MONTHLY_SQL = f"WITH {_SENDERS_SQL} SELECT month, {_MEASURES_SQL} FROM log GROUP BY ALL"
ROLLUP_SKETCHES_SQL = f"""WITH {_SENDERS_SQL} SELECT region_id, period_day, CAST(count(*) AS BIGINT) AS n,
  true AS senders_close, true AS median_close FROM log GROUP BY ALL"""


# ---------------------------------------------------------------------------
# cross-check, fuel buckets, year over year, alerts
# ---------------------------------------------------------------------------

OUTAGE_HOUR = 3  # the mix feed is silent from three to four


def q_intensity_cross_check(spark, sf_dir):
    """National intensity against the one that the mix feed publishes; deviations are judged by hour of the day."""
    t = Tables(spark, sf_dir)
    national = t.carbon().filter("region_id = 0").select(
        "period_start_utc", F.coalesce("actual_gco2_per_kwh", "forecast_gco2_per_kwh").alias("v"))
    mix = adapters.generation_mix_wide(t.events.filter(F.hour("ts") != OUTAGE_HOUR))
    merged = crosscheck.merge_series(national, mix, "period_start_utc", "v", "neso_carbon_intensity_gco2_per_kwh")
    return crosscheck.cross_check(merged, F.hour("period_start_utc"))


def q_fuel_buckets(spark, sf_dir):
    return fuel_buckets.bucket_shares(Tables(spark, sf_dir).mix_wide())


def q_year_over_year(spark, sf_dir):
    """Daily order value a region against 52 weeks before, over all years of ``orders``."""
    orders = Tables(spark, sf_dir).raw("orders")
    daily = orders.groupBy(
        (F.col("o_custkey") % adapters.N_REGIONS).cast("int").alias("region_id"),
        F.date_trunc("day", "o_orderdate").cast("timestamp_ntz").alias("day")).agg(
        F.sum(F.floor("o_totalprice").cast("bigint")).alias("total"))
    return seasonal.against_earlier(daily, ["region_id"], "day", "total", seasonal.YEAR, 24 * 60, *seasonal.bounds(daily, "day"))


def q_week_over_week(spark, sf_dir):
    """Half-hourly intensity a region against the same weekday and slot a week before."""
    t = Tables(spark, sf_dir)
    carbon = t.carbon().select("region_id", "period_start_utc", "forecast_gco2_per_kwh")
    first, last = t.events.agg(F.min(half_hour("ts")), F.max(half_hour("ts"))).first()
    return seasonal.against_earlier(carbon, ["region_id"], "period_start_utc", "forecast_gco2_per_kwh", seasonal.WEEK, 30, first, last)


FEED_OF_TYPE = {"view": "carbon_intensity", "error": "carbon_intensity", "click": "generation_mix", "signup": "generation_mix",
                "purchase": "agile_price"}
ALERTS_AS_OF = "2024-01-29 12:02:30"


def q_alert_episodes(spark, sf_dir):
    """Staleness episodes of every feed and region over the whole ingest log."""
    feed = F.create_map(*(F.lit(x) for pair in FEED_OF_TYPE.items() for x in pair))[F.col("event_type")]
    log = Tables(spark, sf_dir).events.select(
        feed.alias("table_name"), (F.col("user_id") % adapters.N_REGIONS).cast("int").alias("region_id"), "ts")
    name = F.col("table_name")
    return alerts.episodes(log, ["table_name", "region_id"], "ts", alerts.rule(name, STALENESS_LIMITS_S),
                           alerts.rule(name, ALERT_HOLD_S), ALERTS_AS_OF)


CROSS_CHECK_SQL = _with(f"""
SELECT period_start_utc, c.v AS left_value, m.v AS right_value,
       CASE WHEN m.period_start_utc IS NULL THEN 'left_only' WHEN c.period_start_utc IS NULL THEN 'right_only' ELSE 'both' END AS status,
       c.v - m.v AS deviation
FROM (SELECT period_start_utc, CAST(coalesce(actual_gco2_per_kwh, forecast_gco2_per_kwh) AS BIGINT) AS v FROM carbon WHERE region_id = 0) c
FULL JOIN (SELECT {HH} AS period_start_utc, CAST(max(floor(value)) AS BIGINT) AS v FROM events
           WHERE hour(ts) <> {OUTAGE_HOUR} GROUP BY 1) m USING (period_start_utc)""")
CROSS_CHECK_SQL = f"""WITH merged AS ({CROSS_CHECK_SQL}),
middle AS (SELECT *, hour(period_start_utc) AS h, median(deviation) OVER (PARTITION BY hour(period_start_utc)) AS med FROM merged),
spread AS (SELECT *, median(abs(deviation - med)) OVER (PARTITION BY h) AS mad FROM middle)
SELECT period_start_utc, left_value, right_value, status, deviation, med AS median_deviation, mad,
       abs(deviation - med) > CAST(3 AS DOUBLE) * CAST(1.4826 AS DOUBLE) * mad AS outlier FROM spread"""


def _bucket_sql() -> str:
    column = {label: name for name, label, _ in FUELS}
    both = lambda names: " + ".join(f"coalesce({n}, 0)" for n in names)
    null = lambda names: " AND ".join(f"{n} IS NULL" for n in names)
    one = lambda names: f"CASE WHEN {null(names)} THEN NULL ELSE {both(names)} END"
    rows = " UNION ALL ".join(
        f"SELECT '{b}' AS bucket, period_start_utc AS period, {one([column[f] for f in fuels])} AS mw, "
        f"{one([n for n, _, _ in FUELS])} AS all_mw FROM mix" for b, fuels in FUEL_BUCKETS.items())
    return _with(f"""
SELECT CASE WHEN grouping(period) = 0 THEN 'period' WHEN grouping(day) = 0 THEN 'day' ELSE 'month' END AS grain, bucket,
       coalesce(period, day, month) AS start, CAST(count(*) AS BIGINT) AS half_hours, sum(mw) AS mw, sum(all_mw) AS total_mw,
       CASE WHEN sum(all_mw) > 0 THEN CAST(100 AS DOUBLE) * sum(mw) / sum(all_mw) END AS share_pct
FROM (SELECT *, CAST(date_trunc('day', period) AS TIMESTAMP) AS day, CAST(date_trunc('month', period) AS TIMESTAMP) AS month FROM ({rows}))
GROUP BY GROUPING SETS ((bucket, period), (bucket, day), (bucket, month))""")


def _earlier_sql(series: str, time: str, value: str, days: int, step: str) -> str:
    """``series``: region_id, ``time``, ``value``; the textbook form with a dense grid and two lookups."""
    return f"""
grid AS (SELECT region_id, unnest(generate_series(lo, hi, INTERVAL '{step}')) AS {time}
  FROM (SELECT DISTINCT region_id FROM {series}), (SELECT min({time}) AS lo, max({time}) AS hi FROM {series}))
SELECT g.region_id, g.{time}, g.{time} - INTERVAL '{days} days' AS earlier_period, n.{value} AS value, e.{value} AS earlier,
       n.{value} - e.{value} AS change,
       CASE WHEN e.{value} <> 0 THEN CAST(100 AS DOUBLE) * (n.{value} - e.{value}) / e.{value} END AS change_pct,
       CASE WHEN n.{value} IS NULL AND e.{value} IS NULL THEN 'missing_both' WHEN n.{value} IS NULL THEN 'missing_now'
            WHEN e.{value} IS NULL THEN 'missing_earlier' ELSE 'both' END AS status
FROM grid g LEFT JOIN {series} n ON n.region_id = g.region_id AND n.{time} = g.{time}
LEFT JOIN {series} e ON e.region_id = g.region_id AND e.{time} = g.{time} - INTERVAL '{days} days'"""


YEAR_OVER_YEAR_SQL = """WITH daily AS (SELECT CAST(o_custkey % 15 AS INTEGER) AS region_id,
  CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS day, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS total
  FROM orders GROUP BY 1, 2),""" + _earlier_sql("daily", "day", "total", 364, "1 day")
WEEK_OVER_WEEK_SQL = f"""WITH log AS ({CARBON_LOG_SQL}), series AS (SELECT region_id, period_start_utc, forecast_gco2_per_kwh
  FROM {_carbon_reduce_sql("log")}),""" + _earlier_sql("series", "period_start_utc", "forecast_gco2_per_kwh", 7, "30 minutes")


def _alerts_sql() -> str:
    """Every evaluation of every series, each looking up its newest ingest; then islands of stale evaluations."""
    case = lambda values: "CASE table_name " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + " END"
    feed = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FEED_OF_TYPE.items()) + " END"
    now = f"TIMESTAMP '{ALERTS_AS_OF}'"
    return f"""WITH log AS (SELECT {feed} AS table_name, CAST(user_id % 15 AS INTEGER) AS region_id, ts FROM events WHERE ts <= {now}),
series AS (SELECT table_name, region_id, min(ts) AS lo, {case(STALENESS_LIMITS_S)} AS limit_s, {case(ALERT_HOLD_S)} AS hold_s
  FROM log GROUP BY table_name, region_id),
ticks AS (SELECT table_name, region_id, limit_s, hold_s, unnest(generate_series(time_bucket(INTERVAL '5 minutes', lo), {now},
  INTERVAL '5 minutes')) AS tick FROM series),
judged AS (SELECT k.*, date_diff('microsecond', l.ts, k.tick) > CAST(limit_s AS BIGINT) * 1000000 AS stale
  FROM ticks k ASOF JOIN log l ON k.table_name = l.table_name AND k.region_id = l.region_id AND k.tick >= l.ts),
numbered AS (SELECT *, row_number() OVER w - row_number() OVER (PARTITION BY table_name, region_id, stale ORDER BY tick) AS island,
  lead(tick) OVER w AS following FROM judged WINDOW w AS (PARTITION BY table_name, region_id ORDER BY tick)),
runs AS (SELECT table_name, region_id, hold_s, min(tick) AS pending_at, max(tick) AS last_at, CASE WHEN count(*) = count(following) THEN max(following) END AS resolved_at
  FROM numbered WHERE stale GROUP BY table_name, region_id, hold_s, island),
fired AS (SELECT *, CASE WHEN last_at >= pending_at + hold_s * INTERVAL '1 second' THEN pending_at + hold_s * INTERVAL '1 second' END
  AS firing_at FROM runs)
SELECT table_name, region_id, pending_at, firing_at, resolved_at,
  CASE WHEN resolved_at IS NULL THEN CASE WHEN firing_at IS NULL THEN 'pending' ELSE 'firing' END
       WHEN firing_at IS NULL THEN 'cleared' ELSE 'resolved' END AS state,
  CAST(date_diff('microsecond', pending_at, coalesce(resolved_at, {now})) // 1000000 AS BIGINT) AS lasted_s
FROM fired"""


# ---------------------------------------------------------------------------
# forecast, charging schedule, best blocks
# ---------------------------------------------------------------------------

FORECAST_CUTOFF = "2024-01-24 00:00:00"
LEVELS, FEE = 4, 100      # of the store; the fee of a sale, in the prices' unit
BLOCK_SLOTS, BLOCKS, BLOCK_HORIZON_DAYS = 2, 3, 14


def _held_out(spark, sf_dir) -> DataFrame:
    t = Tables(spark, sf_dir)
    series = t.carbon().select("region_id", "period_start_utc", "forecast_gco2_per_kwh")
    first, last = t.events.agg(F.min(half_hour("ts")), F.max(half_hour("ts"))).first()
    return forecast.held_out(series, ["region_id"], "period_start_utc", "forecast_gco2_per_kwh", FORECAST_CUTOFF, first, last)


def q_forecast_check(spark, sf_dir):
    """Seasonal least squares against "as a week before" on the last days, over all regions in one row: counts, residuals
    that average out on the training rows, and the smaller error."""
    total = lambda c: F.sum(c).alias(c)
    return _held_out(spark, sf_dir).agg(
        total("n_train"), total("n_test"), total("n_compared"), (F.max(F.abs("train_bias")) < 1e-6).alias("unbiased"),
        (F.sum(F.col("model_mae") * F.col("n_compared")) < F.sum(F.col("week_before_mae") * F.col("n_compared"))).alias("better"))


def _whole_prices(t: Tables, lo=None, hi=None) -> DataFrame:
    """Prices in hundredths of a penny."""
    return t.price(lo, hi).select("region_id", "period_start_utc", F.round(F.col("price_pence_per_kwh_inc_vat") * 100).cast("bigint").alias("price"))


def q_charging_worth(spark, sf_dir):
    """What the best charging schedule of each region earns over all its prices, recounted from the schedule's actions."""
    plan = schedule.charging(_whole_prices(Tables(spark, sf_dir)), "region_id", "period_start_utc", "price", LEVELS, FEE)
    earned = schedule.worth(plan, "region_id", "price", FEE)
    return earned.select("region_id", "slots", "worth", ((F.col("least") >= 0) & (F.col("most") <= LEVELS)).alias("feasible"))


def q_best_blocks(spark, sf_dir):
    """The cheapest non-overlapping hours of each region in the two weeks ahead."""
    prices = _whole_prices(Tables(spark, sf_dir), AS_OF, _dt(AS_OF) + timedelta(days=BLOCK_HORIZON_DAYS))
    return schedule.best_blocks(prices, "region_id", "period_start_utc", "price", BLOCK_SLOTS, BLOCKS)


FORECAST_CHECK_SQL = f"""WITH log AS ({CARBON_LOG_SQL}), series AS (SELECT region_id, period_start_utc AS p FROM {_carbon_reduce_sql("log")})
SELECT CAST(count(*) FILTER (s.p < TIMESTAMP '{FORECAST_CUTOFF}') AS BIGINT) AS n_train,
       CAST(count(*) FILTER (s.p >= TIMESTAMP '{FORECAST_CUTOFF}') AS BIGINT) AS n_test,
       CAST(count(e.p) FILTER (s.p >= TIMESTAMP '{FORECAST_CUTOFF}') AS BIGINT) AS n_compared, true AS unbiased, true AS better
FROM series s LEFT JOIN series e ON e.region_id = s.region_id AND e.p = s.p - INTERVAL '7 days'"""


def _charging_sql() -> str:
    """The sequential programme: a list of the best worth at each level, carried from half-hour to half-hour."""
    def level(i: int) -> str:
        ways = [f"v[{i + 1}]"] + ([f"v[{i}] - x[1]"] if i else []) + ([f"v[{i + 2}] + x[1] - {FEE}"] if i < LEVELS else [])
        return f"greatest({', '.join(ways)})" if len(ways) > 1 else ways[0]
    start = "[0::BIGINT" + f", {schedule.NEVER}::BIGINT" * LEVELS + "]"
    return _with(f"""
SELECT region_id, CAST(count(*) AS BIGINT) AS slots, list_max(list_reduce(list_prepend({start}, list([price] ORDER BY period_start_utc)),
  lambda v, x: [{", ".join(level(i) for i in range(LEVELS + 1))}])) AS worth, true AS feasible
FROM (SELECT region_id, period_start_utc, CAST(round(price_pence_per_kwh_inc_vat * 100) AS BIGINT) AS price FROM price) GROUP BY region_id""")


BEST_BLOCKS_SQL = _with(f"""whole AS (SELECT region_id, period_start_utc AS s, CAST(round(price_pence_per_kwh_inc_vat * 100) AS BIGINT) AS p
  FROM price WHERE period_start_utc >= {A} AND period_start_utc < {A} + INTERVAL '{BLOCK_HORIZON_DAYS} days'),
blocks AS (SELECT a.region_id, a.s, b.s + INTERVAL '30 minutes' AS e, a.p + b.p AS cost
  FROM whole a JOIN whole b ON b.region_id = a.region_id AND b.s = a.s + INTERVAL '30 minutes'),
choices AS (
  SELECT region_id, [s] AS starts, [cost] AS costs FROM blocks
  UNION ALL SELECT a.region_id, [a.s, b.s], [a.cost, b.cost] FROM blocks a JOIN blocks b ON a.region_id = b.region_id AND b.s >= a.e
  UNION ALL SELECT a.region_id, [a.s, b.s, c.s], [a.cost, b.cost, c.cost] FROM blocks a
    JOIN blocks b ON a.region_id = b.region_id AND b.s >= a.e JOIN blocks c ON a.region_id = c.region_id AND c.s >= b.e),
placed AS (SELECT *, row_number() OVER (PARTITION BY region_id ORDER BY len(starts) DESC, list_sum(costs), starts) AS place FROM choices)
SELECT region_id, CAST(block AS INTEGER) AS block, starts[block] AS start, starts[block] + INTERVAL '1 hour' AS "end",
       costs[block] AS cost
FROM (SELECT *, unnest(range(1, len(starts) + 1)) AS block FROM placed WHERE place = 1)""")


# ---------------------------------------------------------------------------
# states at many instants, days replaced at once, drift of landed documents
# ---------------------------------------------------------------------------

INSTANTS = ["2024-01-03 07:15:00", "2024-01-09 00:00:00", "2024-01-15 12:00:00", "2024-01-15 12:00:30", "2024-01-22 23:59:59.5",
            "2024-02-20 00:00:00"]


def q_states_at_instants(spark, sf_dir):
    """The carbon table as it was known at each of several instants, one pass over the (delayed) log."""
    return instants.states_at(delayed_log(Tables(spark, sf_dir).events), INSTANTS)


REPLACED_DAYS = ["2024-01-05", "2024-01-06", "2024-01-20"]  # of these the last ends empty


def q_days_replaced_at_once(spark, sf_dir):
    """Rows and forecasts a day as three readers see them: before three days are replaced, with the new days staged and the new
    version built, and after the switch.  The new rows read one more; the third day gets none."""
    t = Tables(spark, sf_dir)
    run = uuid.uuid4().hex
    root, name = scratch_path(spark, f"versioned-{run}"), f"carbon_{run[:12]}"
    table = lake.with_day(t.carbon().select("region_id", "period_start_utc", "forecast_gco2_per_kwh"))
    days = sorted(r[0] for r in table.select(lake.DAY).distinct().collect())
    versions.replace_days(table, name, root, days, "first")

    def seen(df: DataFrame, reader: str) -> DataFrame:
        counted = df.groupBy(lake.DAY).agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                                           F.sum("forecast_gco2_per_kwh").cast("bigint").alias("total"))
        return spark.createDataFrame(counted.collect(), counted.schema).select(F.lit(reader).alias("reader"), "*")  # a row a day

    before = seen(spark.table(name), "before")
    corrected = table.withColumn("forecast_gco2_per_kwh", F.col("forecast_gco2_per_kwh") + 1).filter(
        F.col(lake.DAY) != F.lit(REPLACED_DAYS[-1]).cast("date"))
    replaced = [d for d in map(lake._as_date, map(_dt, REPLACED_DAYS))]
    staged = versions.stage(corrected, root, replaced, "second")
    version = versions.build(spark, name, root, table.schema, replaced, staged, "second")
    between = seen(spark.table(name), "between")
    versions.switch(spark, name, version)
    after = seen(spark.table(name), "after")
    versions.vacuum(spark, name, root, keep=1)
    kept = seen(spark.table(name), "vacuumed")
    spark.sql(f"DROP VIEW {name}")
    spark.sql(f"DROP TABLE {name}__v{version}")
    return before.unionByName(between).unionByName(after).unionByName(kept)


def q_drift_profile(spark, sf_dir):
    """Departures of the landed national documents from their contract: path, type, since when, how often."""
    return drift.profile(documents.national(Tables(spark, sf_dir).events))


def q_drift_profile_feeds(spark, sf_dir):
    """The same for the documents of the other feeds, where faults are planted by day."""
    t = Tables(spark, sf_dir)
    every = None
    for feed in (documents.regional, documents.generation_mix, documents.prices):
        docs = feed(t.events).select("source", "payload", "received_at")
        every = docs if every is None else every.unionByName(docs)
    return drift.profile(every)


STATES_AT_SQL = f"WITH {_LANDED_SQL.split('in_time AS')[0].rstrip().rstrip(',')},\n" + ",\n".join(
    f"log{k} AS (SELECT * FROM log WHERE ingested_at_utc <= TIMESTAMP '{i}')" for k, i in enumerate(INSTANTS)) + "\n" + "\nUNION ALL ".join(
    f"SELECT TIMESTAMP '{i}' AS known_at, * FROM {_carbon_reduce_sql(f'log{k}')}" for k, i in enumerate(INSTANTS))

_DAYS_SQL = ", ".join(f"DATE '{d}'" for d in REPLACED_DAYS)
DAYS_REPLACED_SQL = _with(f"""
SELECT reader, CAST(period_start_utc AS DATE) AS period_day, CAST(count(*) AS BIGINT) AS rows,
       CAST(sum(CASE WHEN reader IN ('after', 'vacuumed') AND CAST(period_start_utc AS DATE) IN ({_DAYS_SQL}) THEN 1 ELSE 0 END
           + forecast_gco2_per_kwh) AS BIGINT) AS total
FROM carbon, (SELECT unnest(['before', 'between', 'after', 'vacuumed']) AS reader)
WHERE NOT (reader IN ('after', 'vacuumed') AND CAST(period_start_utc AS DATE) = DATE '{REPLACED_DAYS[-1]}') GROUP BY 1, 2""")

#: Planted form of a national document -> what the profile should say of it.
_NATIONAL_DRIFT = {1: ("$.data[].intensity.forecast", "other type", "STRING"), 2: ("$.data[].intensity.forecast", "other type", "DECIMAL"),
                   5: ("$.data[].intensity.leftover", "unknown path", "BIGINT"), 6: ("$.data[].intensity.actual", "missing path", None),
                   10: ("$.data[].intensity.forecast", "other type", "DECIMAL"), 11: ("$.data[].intensity.forecast", "other type", "VOID"),
                   12: ("$", "not json", None)}
_quote = lambda x: "NULL" if x is None else f"'{x}'"
DRIFT_SQL = f"""SELECT 'national' AS source, path, finding, type_seen, min(CAST(ts AS DATE)) AS first_day, max(CAST(ts AS DATE)) AS last_day,
  CAST(count(*) AS BIGINT) AS documents FROM events JOIN (VALUES {", ".join(
    f"({k}, {', '.join(map(_quote, v))})" for k, v in _NATIONAL_DRIFT.items())}) AS planted(k, path, finding, type_seen)
  ON event_id % {documents.NATIONAL_FORMS} = k GROUP BY path, finding, type_seen"""


DRIFT_FEEDS_SQL = _with(f"""{_MIX},
{_PRICES},
{_REGIONAL},
drifted AS (
  SELECT 'regional' AS source, path, finding, type_seen, received_at FROM reg_docs JOIN (VALUES
      (3, '$.datum', 'unknown path', 'ARRAY'), (3, '$.data', 'missing path', NULL),
      (5, '$.data[].regions[].generationmix[].pct', 'unknown path', 'DECIMAL'),
      (5, '$.data[].regions[].generationmix[].perc', 'missing path', NULL)) AS r(k, path, finding, type_seen) ON k = {_SLOT}
  UNION ALL
  SELECT 'generation_mix', path, finding, type_seen, received_at FROM mix_days JOIN (VALUES
      (3, '$.result.records[].COAL_pct', 'unknown path', 'DECIMAL'),
      (3, '$.result.records[].COAL_perc', 'missing path', NULL)) AS m(k, path, finding, type_seen) ON k = day(day) % 7
  UNION ALL
  SELECT 'generation_mix', '$.result.records[].' || wire, 'other type', 'VOID', received_at
  FROM (SELECT day, wire, count(*) AS empty FROM mix_nulls GROUP BY day, wire) z JOIN mix_days d ON d.day = z.day AND z.empty = d.n
  WHERE day(d.day) % 7 = 4
  UNION ALL
  SELECT 'prices', path, finding, type_seen, received_at FROM price_docs JOIN (VALUES
      (1, '$.results[].value_inc_vat', 'other type', 'STRING'), (3, '$.results[].payment_method', 'missing path', NULL),
      (4, '$.count', 'other type', 'BOOLEAN')) AS p(k, path, finding, type_seen) ON k = day(day) % 6)
SELECT source, path, finding, type_seen, min(CAST(received_at AS DATE)) AS first_day, max(CAST(received_at AS DATE)) AS last_day,
       CAST(count(*) AS BIGINT) AS documents FROM drifted GROUP BY source, path, finding, type_seen""")


QUERIES = {
    "late_closed": q_late_closed,
    "late_rows": q_late_rows,
    "rollup_daily": q_rollup_daily,
    "rollup_monthly": q_rollup_monthly,
    "rollup_sketches": q_rollup_sketches,
    "intensity_cross_check": q_intensity_cross_check,
    "fuel_buckets": q_fuel_buckets,
    "year_over_year": q_year_over_year,
    "week_over_week": q_week_over_week,
    "alert_episodes": q_alert_episodes,
    "forecast_check": q_forecast_check,
    "charging_worth": q_charging_worth,
    "best_blocks": q_best_blocks,
    "states_at_instants": q_states_at_instants,
    "days_replaced_at_once": q_days_replaced_at_once,
    "drift_profile": q_drift_profile,
    "drift_profile_feeds": q_drift_profile_feeds,
}

ORACLE = {
    "late_closed": LATE_CLOSED_SQL,
    "late_rows": LATE_ROWS_SQL,
    "rollup_daily": ROLLUP_DAILY_SQL,
    "rollup_monthly": ROLLUP_MONTHLY_SQL,
    "rollup_sketches": ROLLUP_SKETCHES_SQL,
    "intensity_cross_check": CROSS_CHECK_SQL,
    "fuel_buckets": _bucket_sql(),
    "year_over_year": YEAR_OVER_YEAR_SQL,
    "week_over_week": WEEK_OVER_WEEK_SQL,
    "alert_episodes": _alerts_sql(),
    "forecast_check": FORECAST_CHECK_SQL,
    "charging_worth": _charging_sql(),
    "best_blocks": BEST_BLOCKS_SQL,
    "states_at_instants": STATES_AT_SQL,
    "days_replaced_at_once": DAYS_REPLACED_SQL,
    "drift_profile": DRIFT_SQL,
    "drift_profile_feeds": DRIFT_FEEDS_SQL,
}
