"""Lake (archive) tables: day-partitioned Parquet, schema-conformed writes.

* Partition column ``period_day = to_date(period_start_utc)``; readers pass
  period bounds through ``day_bounds`` so both the partition filter
  (directory pruning) and the row filter (row-group stats) reach the scan.
* Rewrites are dynamic partition overwrites: only the days present in the
  frame are replaced.  A requested day with no rows is cleared explicitly
  (a dynamic overwrite with an empty frame would leave it as it was).
* A frame derived from the table it overwrites is first cut from its
  lineage with a reliable ``checkpoint()`` in the shared checkpoint folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halfhourly.functions.columns import ts_lit, utc_naive
from halfhourly.schemas import ARCHIVE_LOOKBACK_DAYS, HOT_RETENTION_DAYS, lake_schema

DAY = "period_day"


def _as_date(v) -> date:
    """The UTC day of an instant (one with an offset is converted), or a date as it is."""
    if isinstance(v, date) and not isinstance(v, datetime):
        return v
    return utc_naive(v).date()


def with_day(df: DataFrame) -> DataFrame:
    return df.withColumn(DAY, F.to_date("period_start_utc"))


def day_bounds(period_from=None, period_to=None) -> Column:
    """Row filter on ``period_start_utc`` plus the implied partition filter."""
    cond = F.lit(True)
    if period_from is not None:
        cond = cond & (F.col("period_start_utc") >= ts_lit(period_from)) \
            & (F.col(DAY) >= F.lit(_as_date(period_from)))
    if period_to is not None:
        cond = cond & (F.col("period_start_utc") < ts_lit(period_to)) \
            & (F.col(DAY) <= F.lit(_as_date(period_to)))
    return cond


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the table schema; a NULL in a required column fails the job."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            c = F.coalesce(c, F.raise_error(F.lit(f"NULL in required column {f.name}"))).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def to_lake(df: DataFrame, table: str) -> DataFrame:
    """Drop ingest metadata, conform to the archive schema, add the day."""
    return with_day(conform(df.drop("ingested_at_utc"), lake_schema(table)))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def drop_partitions(spark: SparkSession, path: str, days: Iterable[date]) -> int:
    """Delete ``period_day=`` directories (metadata operation, no data read)."""
    fs, root = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    n = 0
    for d in days:
        p = jvm.org.apache.hadoop.fs.Path(root, f"{DAY}={d.isoformat()}")
        if fs.exists(p):
            fs.delete(p, True)
            n += 1
    return n


def list_days(spark: SparkSession, path: str) -> list[date]:
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return []
    out = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(f"{DAY}="):
            out.append(date.fromisoformat(name.split("=", 1)[1]))
    return sorted(out)


def observed(obs: Observation, fallback) -> dict:
    """Metrics of an ``Observation``; ``fallback()`` recomputes them when Spark
    pruned the metrics node (it does so for inputs it can prove empty)."""
    try:
        return obs.get
    except Exception:  # noqa: BLE001
        return fallback()


def _written_counts(spark: SparkSession, path: str, days: Iterable[date], schema: T.StructType) -> dict[date, int]:
    """Rows per day of the files just written: one grouped aggregate, metadata columns only."""
    rows = (spark.read.schema(schema).parquet(path).filter(F.col(DAY).isin(*days)).groupBy(DAY).count().collect()
            if days else [])
    return {r[0]: r[1] for r in rows}


def overwrite_days(df: DataFrame, path: str, days: Sequence[date], count: bool = True) -> dict[date, int]:
    """Replace exactly ``days`` of the table at ``path`` with the rows of
    ``df`` for those days; a day without rows ends up empty.  Returns rows
    written per day (``{}`` without ``count``, which saves reading the new files' footers).

    The set of days that received rows (bounded by ``len(days)``) is observed during the
    write; the other days are deleted explicitly, and the rows are then counted per
    day from the written files, for any number of days.  Readers may see the new files
    before an empty day is gone.
    """
    spark = df.sparkSession
    days = [_as_date(d) for d in days]
    obs = Observation(f"days_{uuid.uuid4().hex}")
    selected = df.filter(F.col(DAY).isin(*days))
    present_days = F.collect_set(DAY).alias("present")
    # rebalance: cluster by day but let AQE split a large day over several
    # tasks/files and merge small ones (a plain repartition would put each
    # day in exactly one task).
    (selected.observe(obs, present_days).hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY)
     .option("partitionOverwriteMode", "dynamic").parquet(path))
    metrics = observed(obs, lambda: selected.agg(present_days).first().asDict())
    present = sorted(set(metrics.get("present") or []))
    drop_partitions(spark, path, [d for d in days if d not in present])
    if not count:
        return {}
    counts = _written_counts(spark, path, present, selected.schema)
    return {d: counts.get(d, 0) for d in days}


def archive_days(as_of, lookback: int = ARCHIVE_LOOKBACK_DAYS) -> list[date]:
    """Yesterday and the days before it (relative to ``as_of``), oldest first."""
    today = _as_date(as_of)
    return [today - timedelta(days=b) for b in range(lookback, 0, -1)]


def archive(tables: dict[str, DataFrame], lake_root: str, as_of,
            lookback: int = ARCHIVE_LOOKBACK_DAYS) -> DataFrame:
    """Nightly archive: for each hot table, rewrite the last ``lookback`` UTC
    days in the lake.  Returns ``(table_name, period_day, rows)``: the counts
    observed while writing (tables x lookback rows, built on the driver)."""
    days = archive_days(as_of, lookback)
    lo, hi = days[0], days[-1] + timedelta(days=1)
    counts = []
    for name, df in tables.items():
        rows = df.filter((F.col("period_start_utc") >= ts_lit(datetime.combine(lo, datetime.min.time())))
                         & (F.col("period_start_utc") < ts_lit(datetime.combine(hi, datetime.min.time()))))
        written = overwrite_days(to_lake(rows, name), f"{lake_root}/{name}", days)
        counts += [(name, d, n) for d, n in written.items()]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(counts, f"table_name string, {DAY} date, rows bigint")


def archive_day_counts(tables: dict[str, DataFrame], as_of,
                       lookback: int = ARCHIVE_LOOKBACK_DAYS) -> DataFrame:
    """Rows per archived day per table, zeros included; one aggregate per table."""
    days = archive_days(as_of, lookback)
    out = None
    for name, df in tables.items():
        d = F.to_date("period_start_utc")
        lo, hi = (ts_lit(datetime.combine(x, datetime.min.time())) for x in (days[0], days[-1] + timedelta(days=1)))
        counts = df.filter((F.col("period_start_utc") >= lo) & (F.col("period_start_utc") < hi)).agg(*[F.count_if(d == F.lit(day)).cast("bigint").alias(f"c{i}")
                          for i, day in enumerate(days)])
        rows = counts.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias("table_name"), F.lit(day).alias(DAY), F.col(f"c{i}").alias("rows"))
            for i, day in enumerate(days)])))
        out = rows if out is None else out.unionByName(rows)
    return out


def rows_per_day(df: DataFrame) -> DataFrame:
    return (df.groupBy(F.to_date("period_start_utc").alias(DAY))
            .agg(F.count(F.lit(1)).cast("bigint").alias("rows")))


def scan_lake(spark: SparkSession, lake_root: str, table: str, period_from=None,
              period_to=None) -> DataFrame:
    """Read an archive table; bounds prune partitions and row groups."""
    schema = lake_schema(table).add(T.StructField(DAY, T.DateType(), True))
    df = spark.read.schema(schema).parquet(f"{lake_root}/{table}")
    return df.filter(day_bounds(period_from, period_to))


def scan_day(df: DataFrame, day) -> DataFrame:
    """Rows of one UTC day ``[day, day + 1)`` of a hot table."""
    d = _as_date(day)
    lo = datetime.combine(d, datetime.min.time())
    return df.filter((F.col("period_start_utc") >= ts_lit(lo))
                     & (F.col("period_start_utc") < ts_lit(lo + timedelta(days=1))))


def ensure_tables(spark: SparkSession, lake_root: str, database: str = "lake") -> int:
    """Register the archive tables (Parquet, partitioned by day) if missing and take up the
    days that their folders hold (call it again after an archive); returns how many were created."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    created = 0
    for name in ("carbon_intensity", "generation_mix", "agile_price"):
        fs, folder = _fs(spark, f"{lake_root}/{name}")
        if not fs.exists(folder):
            fs.mkdirs(folder)
        if spark.catalog.tableExists(f"{database}.{name}"):
            _take_up_days(spark, f"{database}.{name}", list_days(spark, f"{lake_root}/{name}"))
            continue
        cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lake_schema(name).fields)
        spark.sql(f"CREATE TABLE {database}.{name} ({cols}, {DAY} date) USING parquet "
                  f"PARTITIONED BY ({DAY}) LOCATION '{lake_root}/{name}'")
        _take_up_days(spark, f"{database}.{name}", list_days(spark, f"{lake_root}/{name}"))
        created += 1
    return created


def _take_up_days(spark: SparkSession, table: str, stored: Sequence[date], per_statement: int = 500) -> None:
    """Register the stored days that the catalog lacks, drop those that are gone; the others are not touched."""
    known = {date.fromisoformat(r[0].split("=", 1)[1]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    for verb, days in (("ADD IF NOT EXISTS", sorted(set(stored) - known)), ("DROP IF EXISTS", sorted(known - set(stored)))):
        specs = [f"PARTITION ({DAY} = DATE'{d.isoformat()}')" for d in days]
        for k in range(0, len(specs), per_statement):
            joined = (" " if verb.startswith("ADD") else ", ").join(specs[k:k + per_statement])
            spark.sql(f"ALTER TABLE {table} {verb} {joined}")


def apply_retention(df: DataFrame, as_of, days: int = HOT_RETENTION_DAYS) -> DataFrame:
    """Rows of UTC days no older than ``as_of``'s day minus ``days`` (day-granular)."""
    cutoff = F.date_sub(F.to_date(ts_lit(as_of)), days)
    kept = df.filter(F.to_date("period_start_utc") >= cutoff)
    return kept.filter(F.col(DAY) >= cutoff) if DAY in df.columns else kept  # prunes partitions


def expire_partitions(spark: SparkSession, path: str, as_of, days: int = HOT_RETENTION_DAYS) -> int:
    """Drop whole day partitions older than the retention cutoff."""
    cutoff = _as_date(as_of) - timedelta(days=days)
    return drop_partitions(spark, path, [d for d in list_days(spark, path) if d < cutoff])


def merge_into_days(spark: SparkSession, path: str, incoming: DataFrame, merge_fn,
                    schema: T.StructType) -> list[date]:
    """Upsert a batch into a day-partitioned hot table, touching only its days.

    ``merge_fn(current, incoming) -> merged`` is one of the ``merge.upsert_*``
    functions; ``schema`` is the table schema (without the day column).  Only
    the partitions of the days present in the batch are read (the list of
    days is tiny: a batch spans hours to days).  The merged rows take the table
    schema (a NULL in a required column fails the job) and are cut from
    its lineage with a reliable ``checkpoint()`` before the overwrite, so the
    write never reads the files it replaces.  Returns the rewritten days.
    """
    days = sorted(r[0] for r in incoming.select(F.to_date("period_start_utc")).distinct().collect())
    if not days:
        return []
    existing = set(list_days(spark, path)) & set(days)
    cur = read_days(spark, path, schema, sorted(existing)).drop(DAY) if existing else spark.createDataFrame([], schema)
    merged = with_day(conform(merge_fn(cur, incoming), schema)).checkpoint(eager=True)
    overwrite_days(merged, path, days, count=False)
    return days


def read_table(spark: SparkSession, path: str, schema: T.StructType, period_from=None,
               period_to=None) -> DataFrame:
    """Read a day-partitioned hot table (empty frame if it does not exist yet)."""
    if not list_days(spark, path):
        return spark.createDataFrame([], schema)
    full = T.StructType(list(schema.fields) + [T.StructField(DAY, T.DateType(), True)])
    return spark.read.schema(full).parquet(path).filter(day_bounds(period_from, period_to)).drop(DAY)


def read_days(spark: SparkSession, path: str, schema: T.StructType, days: Sequence[date]) -> DataFrame:
    """The rows of some stored days, with the day column: only their folders are listed."""
    full = T.StructType([f for f in schema.fields if f.name != DAY] + [T.StructField(DAY, T.DateType(), True)])
    folders = [f"{path}/{DAY}={d.isoformat()}" for d in days]
    return spark.read.schema(full).option("basePath", path).parquet(*folders).filter(F.col(DAY).isin(*days))


def read_newest_day(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest stored day of a hot table or mart, found in the folder list: a "current" read scans
    one day instead of the table."""
    days = list_days(spark, path)
    return read_days(spark, path, schema, days[-1:]).drop(DAY) if days else spark.createDataFrame([], schema).drop(DAY)


def archive_tables(spark: SparkSession, state_root: str, lake_root: str, as_of,
                   lookback: int = ARCHIVE_LOOKBACK_DAYS) -> DataFrame:
    """Archive from the day-partitioned hot tables: only the ``lookback`` days
    are read (partition pruning), then rewritten in the lake."""
    from halfhourly.schemas import LAKE_TABLES
    days = archive_days(as_of, lookback)
    lo = datetime.combine(days[0], datetime.min.time())
    hi = datetime.combine(days[-1] + timedelta(days=1), datetime.min.time())
    tables = {name: read_table(spark, f"{state_root}/{name}", schema, lo, hi)
              for name, schema in LAKE_TABLES.items()}
    return archive(tables, lake_root, as_of, lookback)


def backfill(rows: DataFrame, lake_root: str, table: str = "carbon_intensity") -> dict[date, int]:
    """Load history rows (e.g. parsed national payloads) straight into the
    lake, bypassing the hot table.  Every day present is overwritten (dynamic
    partition overwrite), so the backfill can be re-run without duplicating
    rows; one pass over the input, the written days observed on the way."""
    lake_rows = to_lake(rows.drop(*[c for c in rows.columns if c.startswith("_")]), table)
    obs = Observation(f"backfill_{uuid.uuid4().hex}")
    exprs = [F.collect_set(DAY).alias("present")]
    (lake_rows.observe(obs, *exprs).hint("rebalance", DAY).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(f"{lake_root}/{table}"))
    present = observed(obs, lambda: lake_rows.agg(*exprs).first().asDict()).get("present") or []
    return _written_counts(lake_rows.sparkSession, f"{lake_root}/{table}", sorted(present), lake_rows.schema)
