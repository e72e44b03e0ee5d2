"""Late data with keyed streaming state: half-hours that stay open until a deadline.

An observation arrives when it arrives (``ingested_at_utc``).  A half-hour accepts what arrives
up to DAYS days after it ended; then it is closed and its row is final.  Two streams read the landed
observations:

* **closed**: a watermarked streaming aggregation.  Its state store holds one row for each open
  (region, half-hour): the newest version and the newest non-NULL ``actual``, combined map-side
  before they reach the state.  When the watermark passes the end of a half-hour plus DAYS days, Spark
  emits the row once (append mode) and drops its state, so state is bounded by the regions and
  the half-hours of DAYS days, whatever the length of the stream.
* **late**: the observations past their half-hour's deadline, stateless, kept apart as they are.

Whether an observation is late is decided by its own two instants, not by how the files fell into
micro-batches.  So that the watermark never drops what is in time, it runs behind the
newest half-hour by DAYS days and ``ahead``, the furthest that an observation may lie before
its half-hour's end (30 minutes for readings of the running half-hour, more for forecasts).

Both sinks are Parquet file sinks whose log belongs to the checkpoint beside it: each row exactly
once over restarts and lost executors.  Runs are ``availableNow`` by default, the reference's scheduled poll.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from halfhourly.functions.columns import sequence_of
from halfhourly.operators import merge
from halfhourly.schemas import CARBON_KEY

DAYS = 2
AHEAD = timedelta(minutes=30)
LANDED_SCHEMA = ("region_id INT, period_start_utc TIMESTAMP_NTZ, period_end_utc TIMESTAMP_NTZ, forecast_gco2_per_kwh INT, "
                 "actual_gco2_per_kwh INT, intensity_index STRING, ingested_at_utc TIMESTAMP_NTZ, event_id BIGINT")


def in_time(days: int = DAYS) -> Column:
    """Arrived before its half-hour closed."""
    return F.col("ingested_at_utc") < F.col("period_end_utc") + F.make_dt_interval(F.lit(days))


def late_rows(log: DataFrame, days: int = DAYS) -> DataFrame:
    """The observations (static or streaming) that came too late."""
    return log.filter(~in_time(days))


def closed_half_hours(log: DataFrame, days: int = DAYS, ahead: timedelta = AHEAD) -> DataFrame:
    """``log`` (static or streaming) reduced to one row a (region, half-hour), from what arrived in time.  As a stream in
    append mode each row appears once, when the watermark closes its half-hour."""
    seconds = int((timedelta(days=days) + ahead).total_seconds())
    marked = (log.filter(in_time(days))
              .withColumn("closing", F.col("period_end_utc").cast("timestamp"))
              .withWatermark("closing", f"{seconds} seconds"))
    seq = sequence_of(F.col("ingested_at_utc"), F.col("event_id"))
    newest = lambda c: F.max_by(F.col(c), seq).alias(c)
    sticky = F.max_by(F.col("actual_gco2_per_kwh"), F.when(F.col("actual_gco2_per_kwh").isNotNull(), seq))
    return (marked.groupBy("closing", *CARBON_KEY)
            .agg(*map(newest, [*merge.CARBON_VALUES, "ingested_at_utc"]), sticky.alias("actual_gco2_per_kwh"),
                 F.count(F.lit(1)).cast("bigint").alias("versions"))
            .select(*CARBON_KEY, "period_end_utc", "forecast_gco2_per_kwh", "actual_gco2_per_kwh", "intensity_index",
                    "ingested_at_utc", "versions"))


def landed(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(LANDED_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def start(spark: SparkSession, folder: str, out: str, days: int = DAYS, ahead: timedelta = AHEAD,
          files_per_batch: int | None = None, trigger: dict | None = None) -> list[StreamingQuery]:
    """Start both streams over the landing ``folder``; ``out`` holds ``closed``, ``late`` and their checkpoints."""
    def sink(df: DataFrame, name: str) -> StreamingQuery:
        return (df.writeStream.queryName(f"{name}-{out}").format("parquet").outputMode("append")
                .option("checkpointLocation", f"{out}/checkpoints/{name}").trigger(**(trigger or {"availableNow": True}))
                .start(f"{out}/{name}"))
    rows = landed(spark, folder, files_per_batch)
    return [sink(closed_half_hours(rows, days, ahead), "closed"), sink(late_rows(rows, days), "late")]


def run(spark: SparkSession, folder: str, out: str, **options) -> list[StreamingQuery]:
    """One scheduled poll: everything that landed, then stop."""
    queries = start(spark, folder, out, **options)
    for q in queries:
        q.awaitTermination()
    return queries


def read_closed(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(f"{LANDED_SCHEMA.rsplit(', ', 1)[0]}, versions BIGINT").parquet(f"{out}/closed")


def read_late(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(LANDED_SCHEMA).parquet(f"{out}/late")


def late_counts(late: DataFrame) -> DataFrame:
    """Late observations a region and day, with the longest delay past the deadline."""
    past = F.timestamp_diff("SECOND", F.col("period_end_utc"), F.col("ingested_at_utc"))
    return late.groupBy("region_id", F.to_date("period_start_utc").alias("period_day")).agg(
        F.count(F.lit(1)).cast("bigint").alias("late"), F.max(past).cast("bigint").alias("longest_delay_s"))
