"""Fuel buckets and their shares by half-hour, day and month in one pass.

A fuel counts in several buckets at once (wind is renewable, low-carbon and zero-carbon), so buckets
overlap and do not add up to the total.  Each stored wide row gives its bucket sums by plain
arithmetic (no join, no second scan), and one GROUPING SETS aggregation serves all three grains: a
single exchange, after the partial sums of each grain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halfhourly.functions.columns import share_pct
from halfhourly.schemas import FUEL_BUCKETS, FUELS

GRAINS = ("period", "day", "month")


def _sum(columns: list[str]) -> Column:
    """NULL-skipping row-wise sum; NULL if all are."""
    known = F.coalesce(*(F.when(F.col(c).isNotNull(), F.lit(True)) for c in columns))
    return F.when(known, sum((F.coalesce(F.col(c), F.lit(0.0)) for c in columns), F.lit(0.0)))


def bucket_rows(wide: DataFrame) -> DataFrame:
    """One row a half-hour and bucket: megawatts in the bucket and in all."""
    column = {label: name for name, label, _ in FUELS}
    buckets = F.array(*(F.struct(F.lit(b).alias("bucket"), _sum([column[f] for f in fuels]).alias("mw"))
                        for b, fuels in FUEL_BUCKETS.items()))
    total = _sum([name for name, _, _ in FUELS])
    return wide.select("period_start_utc", total.alias("all_mw"), F.inline(buckets))


def bucket_shares(wide: DataFrame) -> DataFrame:
    """(grain, bucket, start, half_hours, mw, total_mw, share_pct): megawatts added up over the half-hours of the grain."""
    rows = bucket_rows(wide).select(
        "bucket", F.col("period_start_utc").alias("period"), F.date_trunc("day", "period_start_utc").cast("timestamp_ntz").alias("day"),
        F.date_trunc("month", "period_start_utc").cast("timestamp_ntz").alias("month"), "mw", "all_mw")
    grouped = rows.groupingSets([["bucket", g] for g in GRAINS], "bucket", *GRAINS).agg(
        F.grouping_id().alias("gid"), F.count(F.lit(1)).cast("bigint").alias("half_hours"), F.sum("mw").alias("mw"),
        F.sum("all_mw").alias("total_mw"))
    # of (bucket, period, day, month) the grouping id has a bit set for each column left out
    grain = F.when(F.col("gid") == 0b0011, GRAINS[0]).when(F.col("gid") == 0b0101, GRAINS[1]).otherwise(GRAINS[2])
    return grouped.select(grain.alias("grain"), "bucket", F.coalesce(*GRAINS).alias("start"), "half_hours", "mw", "total_mw",
                          share_pct(F.col("mw"), F.col("total_mw")).alias("share_pct"))
