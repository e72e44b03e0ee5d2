"""Registered queries of the landing and write paths: contract check, parsers, merges into hot
tables, quarantine, archive and backfill, over documents that ``sources.documents`` builds from
the whole ``events`` table.  The DuckDB twins compute rows and reject reasons straight from
``events``, without any JSON.
"""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halfhourly.functions.columns import sequence_of, ts_lit
from halfhourly.operators import lake, merge, quality
from halfhourly.plans import reads
from halfhourly.plans.catalog import (
    A, AS_OF, AS_OF_DAY, COMPACT_KEEP_DAYS, HH, REFRESH, Tables, _band_sql, _carbon_reduce_sql, _refresh_lo, _sql_ts, _with,
)
from halfhourly.schemas import CARBON_SCHEMA, MIX_KEY, MIX_SCHEMA, MIX_WIRE_FUELS, PRICE_KEY, PRICE_SCHEMA
from halfhourly.session import scratch_path
from halfhourly.sources import adapters, documents
from halfhourly.streaming import ingest

FEEDS = ("national", "regional", "generation_mix", "prices")
ARCHIVE_DAYS = 5
CLEARED_DAY = AS_OF_DAY - timedelta(days=2)


# ---------------------------------------------------------------------------
# wire documents -> rows, rejects
# ---------------------------------------------------------------------------

def _spread(t: Tables) -> DataFrame:
    """``events`` over all cores: the stand-in is a file of one row group, which a single task would read and check."""
    return t.events.repartition(t.spark.sparkContext.defaultParallelism)


def _documents(t: Tables, feed: str) -> DataFrame:
    """The feed's documents, landed: a text that is only an expression would be made again wherever the check looks at it."""
    path = f"{_root(t.spark)}/{feed}"
    getattr(documents, feed)(_spread(t)).write.parquet(path)
    return t.spark.read.parquet(path)


def _checked(t: Tables, feed: str) -> DataFrame:
    return ingest.check(_documents(t, feed), [feed], t.dim())


def _parsed(t: Tables, feed: str) -> DataFrame:
    return ingest.parse(feed, _checked(t, feed).filter(F.size("violations") == 0), t.dim())


def _rows(t: Tables, feed: str) -> DataFrame:
    return _parsed(t, feed).drop("_seq").withColumnRenamed("_received_at", "received_at")


def q_wire_national(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(Tables(spark, sf_dir), "national")


def q_wire_regional(spark, sf_dir):
    return _rows(Tables(spark, sf_dir), "regional")


def q_wire_mix(spark, sf_dir):
    return _rows(Tables(spark, sf_dir), "generation_mix")


def q_wire_prices(spark, sf_dir):
    return _rows(Tables(spark, sf_dir), "prices")


def _every_feed(t: Tables) -> DataFrame:
    out = None
    for feed in FEEDS:
        one = _checked(t, feed).select("source", "file", "violations")
        out = one if out is None else out.unionByName(one)
    return out


def q_wire_rejects(spark, sf_dir):
    """Every rejected document with its first violation and how many it has."""
    return _every_feed(Tables(spark, sf_dir)).filter(F.size("violations") > 0).select(
        "source", "file", F.size("violations").cast("bigint").alias("n_violations"), F.get("violations", F.lit(0)).alias("first_violation"))


def q_wire_counts(spark, sf_dir):
    bad = F.size("violations") > 0
    return _every_feed(Tables(spark, sf_dir)).groupBy("source").agg(
        F.count(F.lit(1)).cast("bigint").alias("landed"), F.count_if(~bad).cast("bigint").alias("good"),
        F.count_if(bad).cast("bigint").alias("quarantined"))


# ---------------------------------------------------------------------------
# merges into hot tables (each batch twice: a replay changes nothing)
# ---------------------------------------------------------------------------

def _ingested(spark: SparkSession, sf_dir: str, table: str, root: str) -> str:
    t = Tables(spark, sf_dir)
    for feed in ingest.TABLE_SOURCES[table]:
        getattr(documents, feed)(_spread(t)).write.mode("append").parquet(f"{root}/landed/{table}")
    batch = spark.read.parquet(f"{root}/landed/{table}")
    for _ in range(2):
        ingest.process_batch(spark, batch, table, f"{root}/state", f"{root}/quarantine", t.dim(), "one")
    return f"{root}/state/{table}"


def _root(spark: SparkSession) -> str:
    return scratch_path(spark, f"landing-{uuid.uuid4().hex}")


def q_ingest_hot_carbon(spark, sf_dir):
    return lake.read_table(spark, _ingested(spark, sf_dir, "carbon_intensity", _root(spark)), CARBON_SCHEMA)


def q_ingest_hot_mix(spark, sf_dir):
    return lake.read_table(spark, _ingested(spark, sf_dir, "generation_mix", _root(spark)), MIX_SCHEMA)


def q_ingest_hot_price(spark, sf_dir):
    return lake.read_table(spark, _ingested(spark, sf_dir, "agile_price", _root(spark)), PRICE_SCHEMA)


def q_ingest_quarantine(spark, sf_dir):
    """Documents set aside by the three writers after a replay: each once."""
    root, out = _root(spark), None
    for table in ingest.TABLE_SOURCES:
        _ingested(spark, sf_dir, table, root)
        one = spark.read.parquet(f"{root}/quarantine/{table}").select(
            F.lit(table).alias("table_name"), F.col("source").cast("string").alias("source"), "file",
            F.size("violations").cast("bigint").alias("n_violations"))
        out = one if out is None else out.unionByName(one)
    return out


def q_upsert_mix(spark, sf_dir):
    """Stored state = the mix of events before ``as_of``; batch = the last hours again, with later events."""
    ev = Tables(spark, sf_dir).events
    current = adapters.generation_mix_wide(ev.filter(F.col("ts") < ts_lit(AS_OF)))
    batch = adapters.generation_mix_wide(ev.filter(F.col("ts") >= ts_lit(_refresh_lo())))
    seq = sequence_of(F.col("ingested_at_utc"), F.lit(0))
    return merge.upsert_replace(current, batch, MIX_KEY, AS_OF, seq)


def q_compact_price_log(spark, sf_dir):
    return merge.compact_log(adapters.price_log(Tables(spark, sf_dir).events), AS_OF, COMPACT_KEEP_DAYS,
                             keys=PRICE_KEY, sticky=())


def q_compact_counts(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    logs = {"carbon_log": adapters.carbon_log(ev), "price_log": adapters.price_log(ev)}
    parts = [merge.expired_versions(log, AS_OF, COMPACT_KEEP_DAYS).select(F.lit(n).alias("log_name"), "*")
             for n, log in logs.items()]
    return parts[0].unionByName(parts[1])


# ---------------------------------------------------------------------------
# archive and backfill
# ---------------------------------------------------------------------------

def _archived(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """The last days archived, then archived again after one day lost its rows: that day is cleared."""
    t, root = Tables(spark, sf_dir), _root(spark)
    tables = {"carbon_intensity": t.carbon(), "agile_price": t.price()}
    lake.archive(tables, root, AS_OF, ARCHIVE_DAYS)
    fewer = {n: df.filter(F.to_date("period_start_utc") != F.lit(CLEARED_DAY.date())) for n, df in tables.items()}
    return root, lake.archive(fewer, root, AS_OF, ARCHIVE_DAYS)


def q_lake_archive_counts(spark, sf_dir):
    return _archived(spark, sf_dir)[1]


def q_lake_carbon(spark, sf_dir):
    return lake.scan_lake(spark, _archived(spark, sf_dir)[0], "carbon_intensity")


def q_lake_price(spark, sf_dir):
    return lake.scan_lake(spark, _archived(spark, sf_dir)[0], "agile_price")


def q_lake_backfill(spark, sf_dir):
    """National history straight into the lake, twice; the newest document of a period counts.  The whole lake is read back."""
    rows = _parsed(Tables(spark, sf_dir), "national")
    newest = merge.upsert_carbon(spark.createDataFrame([], CARBON_SCHEMA), rows, F.col("_received_at"), F.col("_seq"))
    root = _root(spark)
    lake.backfill(newest, root)
    lake.backfill(newest, root)
    return lake.scan_lake(spark, root, "carbon_intensity")


def q_lake_day_scan(spark, sf_dir):
    """One day of the hot carbon table, half-open."""
    return lake.scan_day(Tables(spark, sf_dir).carbon(), AS_OF_DAY)


def q_lake_sql(spark, sf_dir):
    """Ad-hoc SQL over archived tables, its parameters bound by name."""
    root = _archived(spark, sf_dir)[0]
    views = {n: lake.scan_lake(spark, root, n) for n in ("carbon_intensity", "agile_price")}
    text = """SELECT c.region_id, CAST(count(*) AS BIGINT) AS half_hours, min(c.forecast_gco2_per_kwh) AS least,
       max(p.price_pence_per_kwh_inc_vat) AS dearest
FROM carbon_intensity c LEFT JOIN agile_price p USING (region_id, period_start_utc)
WHERE c.period_day >= DATE(${SINCE}) AND c.region_id <> ${REGION} GROUP BY c.region_id"""
    return reads.ad_hoc(spark, text, views, SINCE=str((AS_OF_DAY - timedelta(days=4)).date()), REGION=3)[0]


def q_lake_catalog(spark, sf_dir):
    """Archived tables through the catalog: registered while the last day is missing, taken up again after it came."""
    t, root, database = Tables(spark, sf_dir), _root(spark), f"lake_{uuid.uuid4().hex[:12]}"
    tables = {"carbon_intensity": t.carbon(), "agile_price": t.price()}
    lake.archive(tables, root, AS_OF_DAY - timedelta(hours=12), ARCHIVE_DAYS)
    created = lake.ensure_tables(spark, root, database)
    lake.archive(tables, root, AS_OF, 1)
    again = lake.ensure_tables(spark, root, database)
    out = None
    for name in tables:
        one = spark.table(f"{database}.{name}").groupBy(lake.DAY).agg(F.count(F.lit(1)).cast("bigint").alias("rows")).select(
            F.lit(name).alias("table_name"), "*", F.lit(created).cast("bigint").alias("created"), F.lit(again).cast("bigint").alias("created_again"))
        out = one if out is None else out.unionByName(one)
    rows = spark.createDataFrame(out.collect(), out.schema)  # a row a table and archived day
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return rows


def q_ingest_stream_files(spark, sf_dir):
    """Price documents as files, a folder a tariff code, read by the ingest stream in two polls with one checkpoint; the hot
    table they end in.  (Instants of arrival are the files' own and left out.)"""
    t, root = Tables(spark, sf_dir), _root(spark)
    docs = documents.prices(t.events).withColumn("late", F.dayofmonth("received_at") > 15).persist()
    codes = sorted(r[0] or "none" for r in docs.select("tariff_code").distinct().collect())  # one a region
    for late in (False, True):
        for code in codes:
            own = docs.filter((F.col("late") == late) & (F.coalesce("tariff_code", F.lit("none")) == code)).select("payload")
            own.write.mode("append").option("maxRecordsPerFile", 1).text(f"{root}/landed/prices/{code}")
        for q in ingest.ingest_stream(spark, f"{root}/landed", f"{root}/state", f"{root}/checkpoints", f"{root}/quarantine",
                                      tables=["agile_price"], dim=t.dim()):
            q.awaitTermination()
            if q.exception() is not None:
                raise q.exception()
    docs.unpersist()
    return lake.read_table(spark, f"{root}/state/agile_price", PRICE_SCHEMA).drop("ingested_at_utc")


def q_dq_hot_mix(spark, sf_dir):
    """The row checks on the stand-in mix, which lacks fuels in most half-hours."""
    return quality.mix_row_checks(Tables(spark, sf_dir).mix_wide())


# ---------------------------------------------------------------------------
# DuckDB twins
# ---------------------------------------------------------------------------

_NATIONAL = f"""
nat AS (
  SELECT CAST(0 AS INTEGER) AS region_id, {HH} AS period_start_utc, {HH} + INTERVAL '30 minutes' AS period_end_utc,
         CAST(floor(value) AS INTEGER) AS forecast_gco2_per_kwh,
         CASE WHEN event_type = 'purchase' THEN CAST(floor(value * CAST(1.1 AS DOUBLE)) AS INTEGER) END AS actual_gco2_per_kwh,
         {_band_sql('floor(value)')} AS intensity_index, ts AS ingested_at_utc, event_id
  FROM events WHERE event_id % 16 NOT BETWEEN 5 AND 13)"""

_SLOT = "((hour(period_start_utc) * 2 + minute(period_start_utc) // 30) % 9)"
_REGIONAL = f"""
reg_docs AS (
  SELECT period_start_utc, max(ingested_at_utc) AS received_at, count(*) AS n FROM carbon GROUP BY 1),
reg AS (
  SELECT c.region_id, c.period_start_utc, c.period_end_utc, c.forecast_gco2_per_kwh,
         CAST(NULL AS INTEGER) AS actual_gco2_per_kwh, c.intensity_index, d.received_at
  FROM carbon c JOIN reg_docs d USING (period_start_utc)
  WHERE c.region_id <> 0 AND {_SLOT} NOT IN (3, 5))"""

_MIX_COLS = ", ".join(f"coalesce(m.{c}, 0.0) AS {c}" for _, c in MIX_WIRE_FUELS)
_MIX = f"""
mix_nulls AS (
  SELECT CAST(period_start_utc AS DATE) AS day, wire, i, j FROM (
    SELECT period_start_utc, row_number() OVER (PARTITION BY CAST(period_start_utc AS DATE) ORDER BY period_start_utc) - 1 AS i,
           unnest([{', '.join(f"{{'w': '{w}', 'j': {j}, 'v': {c}}}" for j, (w, c) in enumerate(MIX_WIRE_FUELS))}], recursive := true)
    FROM mix) x(period_start_utc, i, wire, j, v) WHERE v IS NULL),
mix_days AS (
  SELECT CAST(period_start_utc AS DATE) AS day, max(ingested_at_utc) AS received_at, count(*) AS n FROM mix GROUP BY 1),
wire_mix AS (
  SELECT m.period_start_utc, {_MIX_COLS}, m.total_generation_mw, m.neso_carbon_intensity_gco2_per_kwh, d.received_at
  FROM mix m JOIN mix_days d ON d.day = CAST(m.period_start_utc AS DATE)
  WHERE day(m.period_start_utc) % 7 NOT IN (1, 3)
    AND NOT (day(m.period_start_utc) % 7 = 4 AND EXISTS (SELECT 1 FROM mix_nulls z WHERE z.day = d.day)))"""

_PRICES = """
price_docs AS (
  SELECT region_id, CAST(period_start_utc AS DATE) AS day, max(ingested_at_utc) AS received_at, count(*) AS n,
         (region_id = 14 AND day(CAST(period_start_utc AS DATE)) % 2 = 1)
           OR (region_id = 13 AND day(CAST(period_start_utc AS DATE)) % 5 = 0) AS nowhere
  FROM price GROUP BY 1, 2),
wire_prices AS (
  SELECT p.region_id, p.period_start_utc, p.period_end_utc, p.price_pence_per_kwh_inc_vat, p.price_pence_per_kwh_exc_vat,
         d.received_at
  FROM price p JOIN price_docs d ON d.region_id = p.region_id AND d.day = CAST(p.period_start_utc AS DATE)
  WHERE NOT d.nowhere AND day(d.day) % 6 NOT IN (3, 4))"""

_REJECTS = f"""{_MIX},
{_PRICES},
{_REGIONAL},
rejects AS (
  SELECT 'national' AS source, 'national/' || lpad(CAST(event_id AS VARCHAR), 12, '0') || '.json' AS file, 1 AS n_violations,
         CASE event_id % 16 WHEN 5 THEN '$.data[0].intensity.leftover: unknown key'
           WHEN 6 THEN '$.data[0].intensity.actual: missing key' WHEN 7 THEN '$.data[0].intensity.index: not an accepted value'
           WHEN 11 THEN '$.data[0].intensity.forecast: null' WHEN 12 THEN '$: not an object'
           WHEN 9 THEN '$.data[0].intensity.forecast: not int' WHEN 10 THEN '$.data[0].intensity.forecast: not int'
           ELSE '$.data[0].from: not instant' END AS first_violation
  FROM events WHERE event_id % 16 BETWEEN 5 AND 13
  UNION ALL
  SELECT 'regional', 'regional/' || strftime(period_start_utc, '%Y-%m-%dT%H:%M') || '.json',
         CASE {_SLOT} WHEN 3 THEN 2 ELSE 2 * n END,
         CASE {_SLOT} WHEN 3 THEN '$.datum: unknown key' ELSE '$.data[0].regions[0].generationmix[0].pct: unknown key' END
  FROM reg_docs WHERE {_SLOT} IN (3, 5)
  UNION ALL
  SELECT 'generation_mix', 'generation_mix/' || CAST(day AS VARCHAR) || '.json', CASE WHEN day(day) % 7 = 1 THEN 1 ELSE 2 * n END,
         CASE WHEN day(day) % 7 = 1 THEN '$.success: not true' ELSE '$.result.records[0].COAL_pct: unknown key' END
  FROM mix_days WHERE day(day) % 7 IN (1, 3)
  UNION ALL
  SELECT 'generation_mix', 'generation_mix/' || CAST(day AS VARCHAR) || '.json', count(*),
         arg_min('$.result.records[' || i || '].' || wire || ': null', i * 100 + j)
  FROM mix_nulls WHERE day(day) % 7 = 4 GROUP BY day
  UNION ALL
  SELECT 'prices', 'prices/' || region_id || '/' || CAST(day AS VARCHAR) || '.json',
         CASE day(day) % 6 WHEN 3 THEN n WHEN 4 THEN 1 ELSE 0 END + CASE WHEN nowhere THEN 1 ELSE 0 END,
         CASE day(day) % 6 WHEN 3 THEN '$.results[0].payment_method: missing key' WHEN 4 THEN '$.count: not long'
           ELSE 'unknown tariff code' END
  FROM price_docs WHERE nowhere OR day(day) % 6 IN (3, 4))"""

_ARCHIVED = (f"CAST(period_start_utc AS DATE) >= CAST({_sql_ts(AS_OF_DAY - timedelta(days=ARCHIVE_DAYS))} AS DATE) "
             f"AND CAST(period_start_utc AS DATE) < CAST({_sql_ts(AS_OF_DAY)} AS DATE) "
             f"AND CAST(period_start_utc AS DATE) <> CAST({_sql_ts(CLEARED_DAY)} AS DATE)")
_LAKE_CARBON = ("region_id, period_start_utc, period_end_utc, forecast_gco2_per_kwh, actual_gco2_per_kwh, intensity_index, "
                "CAST(period_start_utc AS DATE) AS period_day")


def _expired_sql(name: str) -> str:
    return (f"SELECT '{name}' AS log_name, CAST(sum(n) AS BIGINT) AS versions, CAST(sum(n) - sum(gone) AS BIGINT) AS kept, "
            f"CAST(sum(gone) AS BIGINT) AS expired FROM (SELECT count(*) AS n, greatest(count(*) FILTER (WHERE ingested_at_utc < "
            f"{A} - INTERVAL {COMPACT_KEEP_DAYS} DAY) - 1, 0) AS gone FROM {name} GROUP BY region_id, period_start_utc)")


_MIX_ALL = ["period_start_utc", *[c for _, c in MIX_WIRE_FUELS], "total_generation_mw", "neso_carbon_intensity_gco2_per_kwh",
            "ingested_at_utc"]

ORACLE: dict[str, str] = {
    "wire_national": _with(f"""{_NATIONAL}
SELECT * EXCLUDE (event_id, ingested_at_utc), ingested_at_utc AS received_at FROM nat"""),
    "wire_regional": _with(f"{_REGIONAL}\nSELECT * FROM reg"),
    "wire_mix": _with(f"{_MIX}\nSELECT * FROM wire_mix"),
    "wire_prices": _with(f"{_PRICES}\nSELECT * FROM wire_prices"),
    "wire_rejects": _with(f"{_REJECTS}\nSELECT source, file, CAST(n_violations AS BIGINT) AS n_violations, first_violation FROM rejects"),
    "wire_counts": _with(f"""{_REJECTS},
landed AS (
  SELECT 'national' AS source, count(*) AS landed FROM events UNION ALL SELECT 'regional', count(*) FROM reg_docs
  UNION ALL SELECT 'generation_mix', count(*) FROM mix_days UNION ALL SELECT 'prices', count(*) FROM price_docs),
bad AS (SELECT source, count(*) AS n FROM rejects GROUP BY 1)
SELECT source, CAST(landed AS BIGINT) AS landed, CAST(landed - coalesce(n, 0) AS BIGINT) AS good,
       CAST(coalesce(n, 0) AS BIGINT) AS quarantined FROM landed LEFT JOIN bad USING (source)"""),
    "ingest_hot_carbon": _with(f"""{_NATIONAL},
{_REGIONAL}
SELECT * FROM {_carbon_reduce_sql('nat')}
UNION ALL SELECT * RENAME (received_at AS ingested_at_utc) FROM reg"""),
    "ingest_hot_mix": _with(f"{_MIX}\nSELECT * RENAME (received_at AS ingested_at_utc) FROM wire_mix"),
    "ingest_hot_price": _with(f"{_PRICES}\nSELECT * RENAME (received_at AS ingested_at_utc) FROM wire_prices"),
    "ingest_quarantine": _with(f"""{_REJECTS}
SELECT CASE source WHEN 'prices' THEN 'agile_price' WHEN 'generation_mix' THEN 'generation_mix' ELSE 'carbon_intensity' END
         AS table_name, source, file, CAST(n_violations AS BIGINT) AS n_violations FROM rejects"""),
    "compact_price_log": _with(f"""
old AS (SELECT * FROM price_log WHERE ingested_at_utc < {A} - INTERVAL {COMPACT_KEEP_DAYS} DAY)
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY region_id, period_start_utc
  ORDER BY ingested_at_utc DESC, event_id DESC) AS rn FROM old) WHERE rn = 1
UNION ALL SELECT * FROM price_log WHERE ingested_at_utc >= {A} - INTERVAL {COMPACT_KEEP_DAYS} DAY"""),
    "compact_counts": _with(f"{_expired_sql('carbon_log')} UNION ALL {_expired_sql('price_log')}"),
    "lake_archive_counts": _with(f"""
days AS (SELECT CAST(unnest(generate_series({_sql_ts(AS_OF_DAY - timedelta(days=ARCHIVE_DAYS))}, {_sql_ts(AS_OF_DAY - timedelta(days=1))},
                INTERVAL 1 DAY)) AS DATE) AS period_day),
stored AS (SELECT 'carbon_intensity' AS table_name, period_start_utc FROM carbon WHERE {_ARCHIVED}
           UNION ALL SELECT 'agile_price', period_start_utc FROM price WHERE {_ARCHIVED})
SELECT n.table_name, d.period_day, CAST(count(s.period_start_utc) AS BIGINT) AS rows
FROM days d CROSS JOIN (SELECT unnest(['carbon_intensity', 'agile_price']) AS table_name) n
LEFT JOIN stored s ON s.table_name = n.table_name AND CAST(s.period_start_utc AS DATE) = d.period_day GROUP BY 1, 2"""),
    "lake_carbon": _with(f"SELECT {_LAKE_CARBON} FROM carbon WHERE {_ARCHIVED}"),
    "lake_price": _with(f"""SELECT region_id, period_start_utc, period_end_utc,
       CAST(price_pence_per_kwh_inc_vat AS REAL) AS price_pence_per_kwh_inc_vat,
       CAST(price_pence_per_kwh_exc_vat AS REAL) AS price_pence_per_kwh_exc_vat, CAST(period_start_utc AS DATE) AS period_day
FROM price WHERE {_ARCHIVED}"""),
    "lake_backfill": _with(f"""{_NATIONAL}
SELECT {_LAKE_CARBON} FROM {_carbon_reduce_sql('nat')}"""),
    "lake_day_scan": _with(f"SELECT * FROM carbon WHERE CAST(period_start_utc AS DATE) = CAST({_sql_ts(AS_OF_DAY)} AS DATE)"),
    "lake_sql": _with(f"""SELECT c.region_id, CAST(count(*) AS BIGINT) AS half_hours, min(c.forecast_gco2_per_kwh) AS least,
       max(CAST(p.price_pence_per_kwh_inc_vat AS REAL)) AS dearest
FROM (SELECT * FROM carbon WHERE {_ARCHIVED}) c LEFT JOIN (SELECT * FROM price WHERE {_ARCHIVED}) p USING (region_id, period_start_utc)
WHERE CAST(c.period_start_utc AS DATE) >= CAST({_sql_ts(AS_OF_DAY - timedelta(days=4))} AS DATE) AND c.region_id <> 3 GROUP BY c.region_id"""),
    "lake_catalog": _with(f"""days AS (SELECT region_id, CAST(period_start_utc AS DATE) AS period_day, 'carbon_intensity' AS table_name FROM carbon
  UNION ALL SELECT region_id, CAST(period_start_utc AS DATE), 'agile_price' FROM price)
SELECT table_name, period_day, CAST(count(*) AS BIGINT) AS rows, CAST(3 AS BIGINT) AS created, CAST(0 AS BIGINT) AS created_again FROM days
WHERE period_day >= CAST({_sql_ts(AS_OF_DAY - timedelta(days=ARCHIVE_DAYS + 1))} AS DATE) AND period_day < CAST({_sql_ts(AS_OF_DAY)} AS DATE)
GROUP BY 1, 2"""),
    "ingest_stream_files": _with(f"{_PRICES}\nSELECT * EXCLUDE (received_at) FROM wire_prices"),
    "dq_hot_mix": _with(" UNION ALL ".join(
        [f"SELECT 'not_null' AS \"check\", 'generation_mix' AS table_name, '{c}' AS column_name, "
         f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS violations FROM mix" for c in _MIX_ALL]
        + ["SELECT 'component_sum', 'generation_mix', 'total_generation_mw', CAST(0 AS BIGINT)"])),
}


def _wide_mix_sql() -> str:
    """The ``mix`` of the shared CTEs on its own."""
    text = ORACLE["wire_national"]
    start = text.index("mix AS (") + len("mix AS (")
    return text[start:text.index("GROUP BY 1)", start)] + "GROUP BY 1"


def _upsert_mix_sql() -> str:
    wide = _wide_mix_sql()
    old = wide.replace("FROM events", f"FROM events WHERE ts < {A}")
    new = wide.replace("FROM events", f"FROM events WHERE ts >= {REFRESH}")
    return (f"SELECT * FROM ({old}) o WHERE period_start_utc < {REFRESH}\nUNION ALL\n"
            f"SELECT * REPLACE ({A} AS ingested_at_utc) FROM ({new}) n")


ORACLE["upsert_mix"] = _upsert_mix_sql()

QUERIES = {name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_")}
