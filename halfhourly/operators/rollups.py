"""Hourly aggregates as stored, mergeable partial states.

One row a (keys, hour) holds what any coarser grain needs: count, sum, least and greatest
value, a HyperLogLog sketch of distinct senders and a KLL sketch of the value's distribution.  A
day or a month is a merge of these rows at read, never of raw ones, and the exact measures come out
equal to a full recomputation.  States are stored by day; after a late batch only the days
it touches are recomputed (corrections replace values, so states of a touched day are
rebuilt, not added to) and replaced, the files of all other days stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from halfhourly.functions.columns import ts_lit
from halfhourly.operators import lake

HLL_BITS = 12   # relative error of a distinct count: about 1.04 / sqrt(2 ** HLL_BITS)
KLL_K = 200     # rank error of a quantile: about 1.65 %
STATE_SCHEMA = ("region_id INT, hour_utc TIMESTAMP_NTZ, n BIGINT, total BIGINT, least BIGINT, greatest BIGINT, "
                "senders BINARY, spread BINARY, build INT, period_day DATE")


def hour(ts: Column | str) -> Column:
    """Start of the hour as an instant without zone."""
    return F.window(F.col(ts) if isinstance(ts, str) else ts, "1 hour").start.cast("timestamp_ntz")


def hourly_states(rows: DataFrame, value: str, sender: str, keys: Sequence[str] = ("region_id",), build: int = 0) -> DataFrame:
    """Partial states of ``rows`` (keys, period_start_utc, an integer ``value``, ``sender``): one aggregation, combined map-side."""
    v = F.col(value).cast("bigint")
    return (rows.groupBy(*keys, hour("period_start_utc").alias("hour_utc"))
            .agg(F.count(v).alias("n"), F.sum(v).alias("total"), F.min(v).alias("least"), F.max(v).alias("greatest"),
                 F.hll_sketch_agg(F.col(sender), F.lit(HLL_BITS)).alias("senders"),
                 F.kll_sketch_agg_bigint(v, F.lit(KLL_K)).alias("spread"))
            .withColumn("build", F.lit(build)).withColumn(lake.DAY, F.to_date("hour_utc")))


def merge_states(states: DataFrame, *grain: Column | str) -> DataFrame:
    """States of a coarser grain (``grain`` are the grouping columns) from finer ones."""
    return states.groupBy(*grain).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        F.hll_union_agg("senders").alias("senders"), F.kll_merge_agg_bigint("spread").alias("spread"), F.max("build").alias("build"))


def measures(states: DataFrame, quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """Exact count, sum, mean, extremes and the estimates ``senders`` and ``p50``, ..., in place of the sketches."""
    kept = [c for c in states.columns if c not in ("senders", "spread")]
    points = [F.kll_sketch_get_quantile_bigint("spread", F.lit(q)).alias(f"p{round(100 * q)}") for q in quantiles]
    return states.select(*kept, F.when(F.col("n") > 0, F.col("total") / F.col("n")).alias("mean"),
                         F.hll_sketch_estimate("senders").alias("senders"), *points)


def touched_days(batch: DataFrame) -> list[date]:
    """The UTC days a batch speaks of (as many as a batch spans)."""
    return sorted(r[0] for r in batch.select(F.to_date("period_start_utc")).distinct().collect())


def rebuild(rows: DataFrame, path: str, days: Sequence[date], value: str, sender: str, build: int,
            keys: Sequence[str] = ("region_id",)) -> dict[date, int]:
    """Recompute and replace the states of ``days`` from ``rows`` (all rows of the source; only those days are read).
    Returns state rows a day."""
    if not days:
        return {}
    within = lake.day_bounds(*_span(days)) if lake.DAY in rows.columns else _between(days)
    source = rows.filter(within & F.to_date("period_start_utc").isin(*days))
    return lake.overwrite_days(hourly_states(source, value, sender, keys, build), path, days)


def _span(days: Sequence[date]):
    at = [datetime(d.year, d.month, d.day) for d in days]
    return min(at), max(at) + timedelta(days=1)


def _between(days: Sequence[date]) -> Column:
    """Pushed to the scan also where the table has no day column."""
    lo, hi = (ts_lit(x) for x in _span(days))
    return (F.col("period_start_utc") >= lo) & (F.col("period_start_utc") < hi)


def read_states(spark: SparkSession, path: str, period_from=None, period_to=None) -> DataFrame:
    """Stored states; bounds prune days."""
    df = spark.read.schema(STATE_SCHEMA).parquet(path)
    lo, hi = (None if p is None else lake._as_date(p) for p in (period_from, period_to))
    df = df if lo is None else df.filter(F.col(lake.DAY) >= F.lit(lo))
    return df if hi is None else df.filter(F.col(lake.DAY) <= F.lit(hi))
