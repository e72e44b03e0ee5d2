"""Cross-check of two published series of the same quantity.

The two series are merged with a full outer join on the period, so a period that only one of them
has is a finding, not a loss.  Where both have a value, its deviation is held against the group's
median and median absolute deviation (the group is, say, the hour of the day).  Both medians are
exact and come from histograms: counts of equal values, combined map-side, so that the window
that finds the middle sees the distinct values of a group (integers of a bounded
range), never its rows, and a group that holds most periods costs no more than another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Median absolute deviations of a normal distribution to its standard deviation.
NORMAL = 1.4826


def grouped_medians(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """``name`` = twice the exact median of the integer column ``value`` in each ``group`` (twice, to stay an integer)."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(group)
    upto = F.sum("n").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = counts.select(group, value, upto.alias("upto"), F.sum("n").over(w).alias("all"))
    at = lambda k: F.min(F.when(F.col("upto") >= k, F.col(value)))
    return placed.groupBy(group).agg((at(F.expr("(all + 1) div 2")) + at(F.expr("all div 2 + 1"))).alias(name))


def merge_series(left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str) -> DataFrame:
    """(key, left, right, status) of two series with one row a ``key`` each; values as integers."""
    a = left.select(key, F.col(left_value).cast("bigint").alias("left_value"), F.lit(True).alias("in_left"))
    b = right.select(key, F.col(right_value).cast("bigint").alias("right_value"), F.lit(True).alias("in_right"))
    status = F.when(F.col("in_right").isNull(), "left_only").when(F.col("in_left").isNull(), "right_only").otherwise("both")
    return a.join(b, key, "full").withColumn("status", status).drop("in_left", "in_right")


def cross_check(merged: DataFrame, group: Column, threshold: float = 3.0) -> DataFrame:
    """``merged`` (of ``merge_series``) with deviation, its group's median and MAD, and the outlier flag: further from the median than
    ``threshold`` standard deviations as estimated by the MAD (where that is 0, any departure).  NULL where a value is missing."""
    rows = merged.withColumn("grp", group).withColumn("deviation", F.col("left_value") - F.col("right_value"))
    middle = grouped_medians(rows, "grp", "deviation", "median2")
    apart = rows.join(middle, "grp", "left").withColumn("apart2", F.abs(2 * F.col("deviation") - F.col("median2")))
    spread = grouped_medians(apart, "grp", "apart2", "mad4")
    out = apart.join(spread, "grp", "left")
    return out.select(
        *merged.columns, "deviation", (F.col("median2") / 2).alias("median_deviation"), (F.col("mad4") / 4).alias("mad"),
        (F.col("apart2") / 2 > F.lit(threshold * NORMAL) * F.col("mad4") / 4).alias("outlier"))
