"""The state of a log's table at many instants, from one pass over the log.

``merge.as_known_at`` answers for one instant.  Here the instants cut time into blocks; each row falls into the
block of the first instant that knows it, and a block's rows of a key reduce to its newest version and its newest
non-NULL sticky values, combined map-side.  The state at an instant is the merge of a key's blocks up to there, carried along the
key's blocks by a running window.  That sees at most one row a key and instant, never the log, so a key's
length of history does not matter, and the log is shuffled once, already reduced.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from halfhourly.functions.columns import sequence_of, ts_lit, utc_naive
from halfhourly.operators.merge import CARBON_VALUES
from halfhourly.schemas import CARBON_KEY


def _block(ingested: Column, instants: Sequence[datetime]) -> Column:
    """Number of the first instant at or after ``ingested``, by a balanced chain of comparisons; NULL after the last."""
    def choose(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo) if lo < len(instants) else F.lit(None).cast("int")
        mid = (lo + hi) // 2
        return F.when(ingested <= ts_lit(instants[mid]), choose(lo, mid)).otherwise(choose(mid + 1, hi))
    return choose(0, len(instants))


def states_at(log: DataFrame, instants: Sequence, keys: Sequence[str] = CARBON_KEY,
              newest: Sequence[str] = (*CARBON_VALUES, "ingested_at_utc"), sticky: Sequence[str] = ("actual_gco2_per_kwh",)) -> DataFrame:
    """(known_at, keys, newest, sticky): for each of ``instants`` what ``as_known_at`` gives for it.  ``log`` has
    ``ingested_at_utc`` and ``event_id``, which order its rows.  ``instants`` is a list of the caller's, not a table of unknown size."""
    at = sorted({utc_naive(t) if not isinstance(t, str) else datetime.fromisoformat(t) for t in instants})
    seq = sequence_of(F.col("ingested_at_utc"), F.col("event_id"))
    rows = log.withColumn("block", _block(F.col("ingested_at_utc"), at)).filter("block IS NOT NULL")
    state = lambda c: F.max(F.when(F.col(c).isNotNull(), F.struct(seq.alias("seq"), F.col(c).alias("v")))).alias(c)
    whole = F.max(F.struct(seq.alias("seq"), *newest)).alias("newest")
    reduced = rows.groupBy(*keys, "block").agg(whole, *map(state, sticky))
    order = Window.partitionBy(*keys).orderBy("block")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = reduced.select(
        *keys, "block", F.lead("block", 1, len(at)).over(order).alias("next"), "newest",
        *(F.max(c).over(upto).alias(c) for c in sticky))  # newer blocks have greater sequences: the newest version is its own
    known = F.array(*(ts_lit(t) for t in at)) if at else F.array().cast("array<timestamp_ntz>")
    held = carried.withColumn("known_at", F.explode(F.slice(known, F.col("block") + 1, F.col("next") - F.col("block"))))
    return held.select("known_at", *keys, *(F.col(f"newest.{c}").alias(c) for c in newest), *(F.col(f"{c}.v").alias(c) for c in sticky))

