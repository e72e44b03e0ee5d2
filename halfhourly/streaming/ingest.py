"""Structured Streaming ingest: landed payload files -> hot tables.

The reference polls three feeds on a schedule and upserts each response.
Here each feed is a file-source stream over its landing folder; every
micro-batch is (1) checked against the closed contract, (2) split into good
rows and a quarantine, (3) parsed, and (4) merged by natural key into the
day-partitioned hot table, rewriting only the days the batch touches.

* ``trigger(availableNow=True)`` gives the scheduled-poll behaviour: process
  everything that landed, then stop; the checkpoint remembers which files
  were done, so a rerun after executor or driver loss resumes.
* The merge is idempotent (newest-by-sequence, sticky ``actual``), so a
  replayed micro-batch (same ``batch_id`` after a failure) leaves the table
  as it was: overlapping re-reads collapse by key.
* These tables need no watermark state: a late or corrected half-hour is just
  another batch merged into its day (and re-archived by the 2-day
  rolling archive).  Half-hours that close for good are ``streaming.late``'s.
"""

from __future__ import annotations

import hashlib
import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from halfhourly.functions.columns import tariff_letter, utc_wall_clock
from halfhourly.operators import lake, merge, quality
from halfhourly.schemas import CARBON_SCHEMA, MIX_KEY, MIX_SCHEMA, PRICE_KEY, PRICE_SCHEMA
from halfhourly.sources import contracts, payloads

# source name -> (contract, hot table)
SOURCES = {
    "national": (contracts.NATIONAL, "carbon_intensity"),
    "regional": (contracts.REGIONAL, "carbon_intensity"),
    "generation_mix": (contracts.GENERATION_MIX, "generation_mix"),
    "prices": (contracts.PRICES, "agile_price"),
}

# One stream (hence one writer) per hot table; carbon has two feeds.
TABLE_SOURCES = {
    "carbon_intensity": ["national", "regional"],
    "generation_mix": ["generation_mix"],
    "agile_price": ["prices"],
}

TABLE_SCHEMAS = {"carbon_intensity": CARBON_SCHEMA, "generation_mix": MIX_SCHEMA,
                 "agile_price": PRICE_SCHEMA}


def parse(source: str, good: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    if source == "national":
        return payloads.parse_national(good)
    if source == "regional":
        return payloads.parse_regional(good)
    if source == "generation_mix":
        return payloads.parse_generation_mix(good)
    if source == "prices":
        return payloads.parse_prices(good, dim)
    raise ValueError(f"unknown source {source}")


def merge_fn(table: str):
    """The natural-key merge for a hot table, stamping ``ingested_at_utc``
    with the payload's received time."""
    now: Column = F.col("_received_at")
    seq: Column = F.col("_seq")
    if table == "carbon_intensity":
        return lambda cur, inc: merge.upsert_carbon(cur, inc, now, seq)
    keys = PRICE_KEY if table == "agile_price" else MIX_KEY
    return lambda cur, inc: merge.upsert_replace(cur, inc, keys, now, seq)


def check(batch: DataFrame, sources: list[str], dim: DataFrame | None = None) -> DataFrame:
    """Add ``violations`` using each row's own source contract.  For prices ``dim`` names the known
    tariff letters: the letter decides the region, and without a known one the document is set aside, not lost."""
    v = None
    for src in sources:
        spec = SOURCES[src][0]
        expr = contracts.violations(F.col("payload"), spec)
        if src == "generation_mix":
            ok_env = F.coalesce(F.get_json_object("payload", "$.success") == "true", F.lit(False))
            expr = F.when(ok_env, expr).otherwise(F.array_append(expr, F.lit("$.success: not true")))
        v = F.when(F.col("source") == src, expr) if v is None else v.when(F.col("source") == src, expr)
    v = v.otherwise(F.array(F.lit("unknown source")))
    checked = batch.withColumn("violations", v)
    if "prices" not in sources or dim is None:
        return checked
    letters = quality.broadcast_if_small(
        dim.select(F.col("octopus_code").alias("_letter")).filter("_letter IS NOT NULL").distinct())
    return (checked.join(letters, tariff_letter(F.col("tariff_code")) == F.col("_letter"), "left")
            .withColumn("violations", F.when((F.col("source") != "prices") | F.col("_letter").isNotNull(), F.col("violations"))
                        .otherwise(F.array_append("violations", F.lit("unknown tariff code")))).drop("_letter"))


def process_batch(spark: SparkSession, batch: DataFrame, table: str, state_root: str,
                  quarantine_root: str, dim: DataFrame | None = None, batch_id: str | int = "once") -> dict:
    """Contract split -> quarantine -> parse -> merge into touched days.  The quarantine is kept by
    ``batch_id`` (of a stream: its query and batch) and a replay overwrites its own, so it never doubles.  Checked
    documents and parsed rows are each evaluated once."""
    sources = TABLE_SOURCES[table]
    checked = check(batch, sources, dim).persist()
    rows = None
    try:
        bad = checked.filter(F.size("violations") > 0)
        good = checked.filter(F.size("violations") == 0).drop("violations")
        (bad.select("source", "file", "received_at", "payload", "violations")
         .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("source")
         .parquet(os.path.join(quarantine_root, table, f"batch_id={batch_id}")))
        for src in sources:
            part = parse(src, good.filter(F.col("source") == src), dim)
            rows = part if rows is None else rows.unionByName(part)
        rows = rows.persist()
        written = rows.agg(merge.upsert_count(rows)).first()[0]  # rows written (K4), and the one pass that parses
        days = lake.merge_into_days(spark, os.path.join(state_root, table), rows, merge_fn(table),
                                    TABLE_SCHEMAS[table])
        return {"days": days, "rows_written": int(written)}
    finally:
        checked.unpersist()
        if rows is not None:
            rows.unpersist()


def _ensure_dir(spark: SparkSession, path: str) -> None:
    """A file-source stream needs its folder to exist before the first file lands."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        fs.mkdirs(p)


def _source_of(file: Column, sources: list[str]) -> Column:
    """Feed name = the landing sub-folder the file sits in."""
    pat = r"^.*/(" + "|".join(sources) + r")/[^/]+(?:/[^/]+)?$"  # the last match: folders above the root may share a name
    return F.regexp_extract(file, pat, 1)


def payload_stream(spark: SparkSession, landing_root: str, table: str,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of landed documents for one hot table (all its feeds).

    Layout: ``<landing>/<feed>/<file>``; prices use
    ``<landing>/prices/<tariff code>/<file>`` and take the region from the
    tariff code in the path.
    """
    sources = TABLE_SOURCES[table]
    for src in sources:
        _ensure_dir(spark, os.path.join(landing_root, src))
    reader = spark.readStream.format("text").option("wholetext", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if sources == ["prices"]:
        path = os.path.join(landing_root, "prices", "*")
    elif len(sources) == 1:
        path = os.path.join(landing_root, sources[0])
    else:
        path = os.path.join(landing_root, "{" + ",".join(sources) + "}")
    df = reader.load(path)
    return _payload_columns(df, sources)


def _payload_columns(df: DataFrame, sources: list[str]) -> DataFrame:
    out = df.select(
        F.col("value").alias("payload"),
        utc_wall_clock(F.col("_metadata.file_modification_time")).alias("received_at"),
        _source_of(F.col("_metadata.file_path"), sources).alias("source"),
        F.col("_metadata.file_path").alias("file"))
    if "prices" in sources:
        out = out.withColumn("tariff_code", payloads.tariff_code_from_path(F.col("file")))
    return out


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a checkpoint folder: batches are numbered anew in a new one, so their number alone
    would let a later query overwrite what an earlier one set aside."""
    text = spark.read.option("wholetext", "true").text(f"{checkpoint}/metadata").first()[0]
    return json.loads(text)["id"]


def ingest_stream(spark: SparkSession, landing_root: str, state_root: str, checkpoint_root: str,
                  quarantine_root: str, tables=tuple(TABLE_SOURCES), dim: DataFrame | None = None,
                  available_now: bool = True, max_files_per_trigger: int | None = None,
                  processing_time: str = "30 minutes") -> list[StreamingQuery]:
    """Start one streaming query per hot table; returns them (caller awaits)."""
    dim = dim if dim is not None else payloads.region_seed(spark)
    out = []
    for table in tables:
        stream = payload_stream(spark, landing_root, table, max_files_per_trigger)

        checkpoint = os.path.join(checkpoint_root, table)

        def run(batch_df: DataFrame, batch_id: int, _t=table, _c=checkpoint, _id=[]) -> None:  # noqa: B006 (read once a query)
            _id[:] = _id or [_query_id(spark, _c)]
            process_batch(spark, batch_df, _t, state_root, quarantine_root, dim, f"{_id[0]}-{batch_id}")

        w = (stream.writeStream.foreachBatch(run)
             .option("checkpointLocation", checkpoint)
             .queryName(f"ingest_{table}"))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
        out.append(w.start())
    return out


def ingest_batch(spark: SparkSession, landing_root: str, state_root: str, quarantine_root: str,
                 table: str, dim: DataFrame | None = None) -> dict:
    """The same work as one big micro-batch (backfills, tests: stream == batch)."""
    sources = TABLE_SOURCES[table]
    for src in sources:
        _ensure_dir(spark, os.path.join(landing_root, src))
    paths = [os.path.join(landing_root, "prices", "*") if s == "prices" else os.path.join(landing_root, s)
             for s in sources]
    df = spark.read.option("wholetext", "true").text(paths)
    return process_batch(spark, _payload_columns(df, sources), table, state_root, quarantine_root, dim,
                         f"backfill-{hashlib.sha256(landing_root.encode()).hexdigest()[:12]}")
