"""A series against itself a whole number of weeks before, on a dense calendar.

Year over year compares with 364 days before (52 weeks, so that weekdays meet weekdays), week over week with 7.
Every period of the calendar between the two bounds has a row for every key, whether it was
measured or not; gaps say which side is missing.  The series is never joined with itself: each
measured row is sent to its own period and, as the earlier value, to the one ``shift_days`` on, and
one aggregation brings both together with the calendar's empty rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halfhourly.functions.columns import ts_lit

YEAR, WEEK = 364, 7


def spine(keys: DataFrame, first: Column, last: Column, minutes: int, name: str) -> DataFrame:
    """Every ``minutes``-step from ``first`` to ``last`` for every row of ``keys`` (a dimension)."""
    step = F.make_dt_interval(mins=F.lit(minutes))
    return keys.select("*", F.explode(F.sequence(first, last, step)).alias(name))


def against_earlier(series: DataFrame, keys: Sequence[str], time: str, value: str, shift_days: int, minutes: int,
                    first, last) -> DataFrame:
    """``series`` has one row a (keys, ``time``) on a grid of ``minutes``; ``first`` and ``last`` (instants without zone) bound
    the calendar.  Keys are those that the series has anywhere."""
    lo, hi = ts_lit(first), ts_lit(last)
    shift = F.make_dt_interval(F.lit(shift_days))
    v, none = F.col(value), F.lit(None).cast(series.schema[value].dataType)
    own = series.select(*keys, time, v.alias("value"), none.alias("earlier"))
    sent = series.select(*keys, (F.col(time) + shift).alias(time), none.alias("value"), v.alias("earlier"))
    empty = spine(series.select(*keys).distinct(), lo, hi, minutes, time).select(
        *keys, time, none.alias("value"), none.alias("earlier"))
    within = F.col(time).between(lo, hi)
    both = own.filter(within).unionByName(sent.filter(within)).unionByName(empty)
    pair = both.groupBy(*keys, time).agg(F.max("value").alias("value"), F.max("earlier").alias("earlier"))
    status = (F.when(F.col("value").isNull() & F.col("earlier").isNull(), "missing_both")
              .when(F.col("value").isNull(), "missing_now").when(F.col("earlier").isNull(), "missing_earlier").otherwise("both"))
    change = F.col("value") - F.col("earlier")
    return pair.select(*keys, time, (F.col(time) - shift).alias("earlier_period"), "value", "earlier", change.alias("change"),
                       F.when(F.col("earlier") != 0, 100.0 * change / F.col("earlier")).alias("change_pct"), status.alias("status"))


def bounds(series: DataFrame, time: str):
    """First and last instant of a series (one aggregate row)."""
    return tuple(series.agg(F.min(time), F.max(time)).first())
