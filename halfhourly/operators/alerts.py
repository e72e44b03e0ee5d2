"""Staleness alerts over all history: pending, firing and resolved episodes.

A rule is evaluated every EVERY seconds.  A feed is stale when its newest ingest is more than its limit
ago; it is *pending* from the first evaluation that finds it stale, *firing* once it has been so for the hold
time, *resolved* at the first evaluation after the next ingest.  One that recovers within the hold
time never fires (``cleared``).

Nothing is evaluated tick by tick.  Ingests closer together than the limit form a session window, whose
end (last ingest plus the limit, the window's gap) is the instant where the feed goes stale and
whose successor's start is its recovery.  Sessions are formed in blocks of one day, so that a feed
with a third of all rows is spread, and their edges are stitched afterwards: of a feed and day at most
86400 / limit + 1 sessions are left, whatever the number of ingests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from halfhourly.functions.columns import ts_lit

EVERY = 300


def rule(feed: Column, values: dict[str, int]) -> Column:
    """A fixed number of seconds a feed."""
    out = F.lit(None).cast("int")
    for name, seconds in values.items():
        out = F.when(feed == name, seconds).otherwise(out)
    return out


def _micros(instant: Column) -> Column:
    """Of an instant without zone, since 1970 (no session zone involved)."""
    return F.timestamp_diff("MICROSECOND", _epoch(), instant)


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _seconds(n: Column) -> Column:
    return F.make_dt_interval(secs=n.cast("decimal(18,6)"))


def sessions(log: DataFrame, keys: Sequence[str], at: str, limit: Column) -> DataFrame:
    """(keys, limit_s, started, stale_from): stretches of ``log`` in which no ingest is more than ``limit`` seconds after
    the one before.  Rows without a limit are left out."""
    rows = log.select(*keys, F.to_date(at).alias("block"), F.col(at).alias("at"), limit.cast("bigint").alias("limit_s"))
    # a session's end is exclusive: an ingest exactly the limit later still belongs, hence a microsecond more
    window = F.session_window("at", F.make_interval(secs=F.col("limit_s").cast("decimal(18,6)") + F.lit("0.000001").cast("decimal(18,6)")))
    local = (rows.filter("limit_s IS NOT NULL").groupBy(*keys, "block", "limit_s", window)
             .agg(F.min("at").alias("started"), F.max("at").alias("last")))
    order = Window.partitionBy(*keys, "limit_s").orderBy("started")
    apart = _micros(F.col("started")) - _micros(F.lag("last").over(order)) > F.col("limit_s") * 1_000_000
    stitched = local.withColumn("apart", F.coalesce(apart, F.lit(False)).cast("int"))
    stitched = stitched.withColumn("run", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return stitched.groupBy(*keys, "limit_s", "run").agg(F.min("started").alias("started"), F.max("last").alias("last")).select(
        *keys, "limit_s", "started", (F.col("last") + _seconds(F.col("limit_s"))).alias("stale_from"))


def _tick(instant: Column, after: bool, every: int) -> Column:
    """The first evaluation at or after an instant (strictly after, if ``after``)."""
    step = every * 1_000_000
    number = F.floor(_micros(instant) / step) + 1 if after else F.ceil(_micros(instant) / step)
    return _epoch() + _seconds(number * every)


def episodes(log: DataFrame, keys: Sequence[str], at: str, limit: Column, hold: Column, as_of, every: int = EVERY) -> DataFrame:
    """One row an episode: pending_at, firing_at, resolved_at, state at ``as_of`` (pending, firing, resolved, cleared) and the
    seconds from pending to its end or ``as_of``.  ``at`` and ``as_of`` are UTC without zone; ``limit`` and ``hold`` depend
    on the keys only.  Ingests after ``as_of`` are not known yet."""
    now = ts_lit(as_of)
    order = Window.partitionBy(*keys).orderBy("started")
    spans = sessions(log.filter(F.col(at) <= now), keys, at, limit).withColumn("recovered", F.lead("started").over(order))
    resolved = _tick(F.col("recovered"), False, every)
    seen = spans.select(*keys, _tick(F.col("stale_from"), True, every).alias("pending_at"),
                        F.when(resolved <= now, resolved).alias("resolved_at"),
                        _seconds(F.ceil(hold / every) * every).alias("held"))
    seen = seen.filter((F.col("pending_at") <= now) & (F.col("resolved_at").isNull() | (F.col("pending_at") < F.col("resolved_at"))))
    fires = F.col("pending_at") + F.col("held")
    still = F.col("resolved_at").isNull()
    fired = F.when(still, fires <= now).otherwise(fires < F.col("resolved_at"))
    state = F.when(still, F.when(fired, "firing").otherwise("pending")).otherwise(F.when(fired, "resolved").otherwise("cleared"))
    return seen.select(*keys, "pending_at", F.when(fired, fires).alias("firing_at"), "resolved_at", state.alias("state"),
                       F.timestamp_diff("SECOND", F.col("pending_at"), F.coalesce("resolved_at", now)).cast("bigint").alias("lasted_s"))
