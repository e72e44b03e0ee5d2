"""Natural-key merges (upserts), log compaction and time travel.

The reference resolves conflicts row by row in a database.  Here every merge
is ONE ``groupBy(key)`` over ``current UNION incoming`` with ``max_by``
against a single orderable sequence column:

* "newest wins" columns: ``max_by(col, seq)``;
* "sticky" columns (``actual`` may only be filled, never erased):
  ``max_by(col, seq if col IS NOT NULL)`` which is the newest non-NULL value,
  i.e. ``COALESCE(newest incoming non-NULL, stored)``.

``max_by`` is a declarative aggregate, so Spark combines map-side before the
shuffle: a key holding a third of all rows is reduced to one buffer per task
before anything crosses the network.  The sequence is ``struct(t, n)``
(instant, tiebreak), see ``functions.sequence_of``.  Each column gets its own
``max_by`` so Catalyst drops the ones a query does not use (measured on a
1M-row log: 1.7 s per-column vs 2.1 s with all columns packed in one struct
when two columns are used; 3.1 s vs 2.9 s when all are).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halfhourly.functions.columns import oldest_sequence, sequence_of, ts_lit
from halfhourly.schemas import CARBON_KEY, PRICE_KEY

SEQ = "_seq"

CARBON_VALUES = ["period_end_utc", "forecast_gco2_per_kwh", "intensity_index"]
PRICE_VALUES = ["period_end_utc", "price_pence_per_kwh_inc_vat", "price_pence_per_kwh_exc_vat"]


def reduce_newest(rows: DataFrame, keys: Sequence[str], seq: Column | str,
                  newest: Sequence[str], sticky: Sequence[str] = ()) -> DataFrame:
    """One row per key: the newest row's ``newest`` columns, the newest
    non-NULL value of each ``sticky`` column, and the newest sequence as
    ``_seq`` so reductions compose."""
    seq = F.col(seq) if isinstance(seq, str) else seq
    aggs = [F.max_by(F.col(c), seq).alias(c) for c in newest]
    aggs += [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), seq)).alias(c) for c in sticky]
    aggs.append(F.max(seq).alias(SEQ))
    return rows.groupBy(*keys).agg(*aggs)


def carbon_from_log(log: DataFrame, seq: Column | None = None) -> DataFrame:
    """Carbon table from an append-only observation log.

    ``log`` has the carbon columns plus ``ingested_at_utc`` and an
    ``event_id`` tiebreak; order is ``(ingested_at_utc, event_id)``.
    """
    seq = seq if seq is not None else sequence_of(F.col("ingested_at_utc"), F.col("event_id"))
    red = reduce_newest(log.withColumn(SEQ, seq), CARBON_KEY, SEQ,
                        newest=CARBON_VALUES + ["ingested_at_utc"],
                        sticky=["actual_gco2_per_kwh"])
    return red.select(
        "region_id", "period_start_utc", "period_end_utc", "forecast_gco2_per_kwh",
        "actual_gco2_per_kwh", "intensity_index", "ingested_at_utc")


def price_from_log(log: DataFrame, seq: Column | None = None) -> DataFrame:
    seq = seq if seq is not None else sequence_of(F.col("ingested_at_utc"), F.col("event_id"))
    red = reduce_newest(log.withColumn(SEQ, seq), PRICE_KEY, SEQ,
                        newest=PRICE_VALUES + ["ingested_at_utc"])
    return red.select("region_id", "period_start_utc", "period_end_utc",
                      "price_pence_per_kwh_inc_vat", "price_pence_per_kwh_exc_vat",
                      "ingested_at_utc")


def _stamp(current: DataFrame, incoming: DataFrame, incoming_seq: Column,
           now) -> DataFrame:
    """Union of stored rows (the oldest sequence) and a batch stamped ``now``."""
    now_col = now if isinstance(now, Column) else ts_lit(now)
    inc = (incoming.withColumn(SEQ, incoming_seq)
           .withColumn("ingested_at_utc", now_col))
    cur = current.withColumn(SEQ, oldest_sequence(inc.schema[SEQ].dataType))
    cols = list(current.columns) + [SEQ]
    return cur.select(*cols).unionByName(inc.select(*cols))


def upsert_carbon(current: DataFrame, incoming: DataFrame, now, incoming_seq: Column) -> DataFrame:
    """Conflict on ``(region_id, period_start_utc)``: end/forecast/band replaced
    by the newest incoming row, ``actual`` = newest incoming non-NULL else the
    stored value, ``ingested_at_utc`` = ``now`` for every touched key.

    ``incoming_seq`` (a ``sequence_of`` struct) orders the batch: received
    time, then file and position; stored rows count as older than any batch.
    """
    u = _stamp(current, incoming, incoming_seq, now)
    red = reduce_newest(u, CARBON_KEY, SEQ, newest=CARBON_VALUES + ["ingested_at_utc"],
                        sticky=["actual_gco2_per_kwh"])
    return red.select(*current.columns)


def upsert_replace(current: DataFrame, incoming: DataFrame, keys: Sequence[str], now,
                   incoming_seq: Column) -> DataFrame:
    """Generic replace-on-conflict (generation mix, price, region dimension)."""
    if "ingested_at_utc" in current.columns:
        u = _stamp(current, incoming, incoming_seq, now)
    else:
        inc = incoming.withColumn(SEQ, incoming_seq)
        u = (current.withColumn(SEQ, oldest_sequence(inc.schema[SEQ].dataType))
             .unionByName(inc.select(*current.columns, SEQ)))
    values = [c for c in current.columns if c not in keys]
    return reduce_newest(u, keys, SEQ, newest=values).select(*current.columns)


def upsert_price(current: DataFrame, incoming: DataFrame, now, incoming_seq: Column) -> DataFrame:
    return upsert_replace(current, incoming, PRICE_KEY, now, incoming_seq)


def upsert_count(incoming: DataFrame) -> Column:
    """Rows an upsert reports as written (0 for an empty batch): ``count(*)``,
    meant for ``DataFrame.observe`` so the batch is not scanned twice."""
    return F.count(F.lit(1)).alias("rows_written")


def as_known_at(log: DataFrame, known_at, reduce=carbon_from_log) -> DataFrame:
    """State of the table as it was known at ``known_at`` (time travel over the
    append-only ingest log): filter the log, then reduce."""
    return reduce(log.filter(F.col("ingested_at_utc") <= ts_lit(known_at)))


def compact_log(log: DataFrame, as_of, keep_days: int, keys: Sequence[str] = CARBON_KEY,
                sticky: Sequence[str] = ("actual_gco2_per_kwh",)) -> DataFrame:
    """Keep every log row from the last ``keep_days`` plus, per key, ONE merged
    row standing for everything older (newest values, newest non-NULL ``sticky`` ones,
    newest ``ingested_at_utc``/``event_id``).  Any log with those two columns will do: carbon,
    prices (``sticky=()``), generation mix (``keys=MIX_KEY, sticky=()``).

    Law: ``carbon_from_log(compact_log(log)) == carbon_from_log(log)``.
    """
    cutoff = ts_lit(as_of) - F.make_dt_interval(F.lit(keep_days))
    old = log.filter(F.col("ingested_at_utc") < cutoff)
    recent = log.filter(F.col("ingested_at_utc") >= cutoff)
    seq = sequence_of(F.col("ingested_at_utc"), F.col("event_id"))
    newest = [c for c in log.columns if c not in {*keys, *sticky}]
    merged = reduce_newest(old.withColumn(SEQ, seq), keys, SEQ, newest=newest, sticky=sticky)
    merged = merged.select(*log.columns)
    return merged.unionByName(recent.select(*log.columns))


def expired_versions(log: DataFrame, as_of, keep_days: int, keys: Sequence[str] = CARBON_KEY) -> DataFrame:
    """What ``compact_log`` does to a log, in one row: versions before, kept and expired."""
    cutoff = ts_lit(as_of) - F.make_dt_interval(F.lit(keep_days))
    is_old = F.col("ingested_at_utc") < cutoff
    per_key = log.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(is_old).alias("old"))
    gone = F.coalesce(F.sum(F.greatest(F.col("old") - 1, F.lit(0))), F.lit(0)).cast("bigint")
    total = F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")
    return per_key.agg(total.alias("versions"), gone.alias("expired")).select(
        "versions", (F.col("versions") - F.col("expired")).alias("kept"), "expired")
