"""Landed wire payloads -> normalised rows.

A landed payload is one JSON document per file (``payload``), with the
time it was received and the source name.  Reading many files is one scan
(``wholetext``); parsing is ``from_json`` into explicit schemas, then
``posexplode``.  Leaves are read as text and turned into values by the functions
(``wire_int``, ``wire_number``, ``parse_iso_utc``, ``parse_naive_utc``) that the contract
check calls too: what the check accepts is never NULL here.

Each parser also emits ``_seq``: the merge order (received time, file,
position in the document), so duplicates inside one batch resolve
last-wins exactly like an ordered row-by-row upsert.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halfhourly.functions.columns import (
    format_request_ts, parse_iso_utc, parse_naive_utc, sequence_of, tariff_letter, wire_bool, wire_int,
    wire_number,
)
from halfhourly.schemas import (
    BACKFILL_CHUNK_DAYS, MIX_WIRE_FUELS, NATIONAL_REGION_ID, REGION_SCHEMA, REGION_SEED,
    ROLLUP_REGION_IDS,
)
from halfhourly.operators.quality import broadcast_if_small

S = T.StringType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v, True) for k, v in fields.items()])


NATIONAL_WIRE = _struct(data=T.ArrayType(_struct(
    **{"from": S, "to": S, "intensity": _struct(forecast=S, actual=S, index=S)})))

REGIONAL_WIRE = _struct(data=T.ArrayType(_struct(
    **{"from": S, "to": S,
       "regions": T.ArrayType(_struct(regionid=S, dnoregion=S, shortname=S,
                                      intensity=_struct(forecast=S, index=S)))})))

MIX_WIRE = _struct(success=S, result=_struct(
    records=T.ArrayType(_struct(**{"_id": S, "DATETIME": S, "GENERATION": S, "CARBON_INTENSITY": S,
                                   **{w: S for w, _ in MIX_WIRE_FUELS}}))))

PRICE_WIRE = _struct(count=S, results=T.ArrayType(_struct(
    value_exc_vat=S, value_inc_vat=S, valid_from=S, valid_to=S, payment_method=S)))


def _file(payloads: DataFrame) -> Column:
    """The document's file: files landed in the same instant merge in the same order on every run and replay."""
    return (F.col("file") if "file" in payloads.columns else F.lit("")).alias("_file")


def _seq(*positions: Column) -> Column:
    """Merge order inside a batch: received time, then file, then nested positions (32 bits each)."""
    place = positions[0].cast("bigint")
    for p in positions[1:]:
        place = F.shiftleft(place, 32) + p.cast("bigint")
    return sequence_of(F.coalesce(F.col("received_at"), F.lit("1970-01-01").cast("timestamp_ntz")), place, F.col("_file"))


def parse_national(payloads: DataFrame) -> DataFrame:
    """National intensity: one row per period, region 0, ``actual`` nullable."""
    p = payloads.select("received_at", _file(payloads), F.from_json("payload", NATIONAL_WIRE).alias("w"))
    e = p.select("received_at", "_file", F.posexplode("w.data").alias("i", "d"))
    return e.select(
        F.lit(NATIONAL_REGION_ID).cast("int").alias("region_id"),
        parse_iso_utc(F.col("d.from")).alias("period_start_utc"),
        parse_iso_utc(F.col("d.to")).alias("period_end_utc"),
        wire_int(F.col("d.intensity.forecast")).alias("forecast_gco2_per_kwh"),
        wire_int(F.col("d.intensity.actual")).alias("actual_gco2_per_kwh"),
        F.col("d.intensity.index").alias("intensity_index"),
        _seq(F.col("i")).alias("_seq"),
        F.col("received_at").alias("_received_at"))


def parse_regional(payloads: DataFrame) -> DataFrame:
    """Regional intensity: periods x regions, rollups 15..18 dropped, no actual."""
    p = payloads.select("received_at", _file(payloads), F.from_json("payload", REGIONAL_WIRE).alias("w"))
    e = p.select("received_at", "_file", F.posexplode("w.data").alias("i", "d"))
    r = e.select("received_at", "_file", "i", "d", F.posexplode("d.regions").alias("j", "r"))
    r = r.filter(~wire_int(F.col("r.regionid")).isin(*ROLLUP_REGION_IDS))
    return r.select(
        wire_int(F.col("r.regionid")).alias("region_id"),
        parse_iso_utc(F.col("d.from")).alias("period_start_utc"),
        parse_iso_utc(F.col("d.to")).alias("period_end_utc"),
        wire_int(F.col("r.intensity.forecast")).alias("forecast_gco2_per_kwh"),
        F.lit(None).cast("int").alias("actual_gco2_per_kwh"),
        F.col("r.intensity.index").alias("intensity_index"),
        _seq(F.col("i"), F.col("j")).alias("_seq"),
        F.col("received_at").alias("_received_at"))


def parse_generation_mix(payloads: DataFrame) -> DataFrame:
    """Generation mix: ``success=false`` documents yield no rows (they belong
    in quarantine, see ``reject_unsuccessful``); naive times pinned to UTC."""
    p = payloads.select("received_at", _file(payloads), F.from_json("payload", MIX_WIRE).alias("w"))
    p = p.filter(wire_bool(F.col("w.success")))
    e = p.select("received_at", "_file", F.posexplode("w.result.records").alias("i", "r"))
    return e.select(
        parse_naive_utc(F.col("r.DATETIME")).alias("period_start_utc"),
        *[wire_number(F.col(f"r.{w}")).alias(c) for w, c in MIX_WIRE_FUELS],
        wire_number(F.col("r.GENERATION")).alias("total_generation_mw"),
        wire_number(F.col("r.CARBON_INTENSITY")).alias("neso_carbon_intensity_gco2_per_kwh"),
        _seq(F.col("i")).alias("_seq"),
        F.col("received_at").alias("_received_at"))


def reject_unsuccessful(payloads: DataFrame) -> DataFrame:
    """Generation-mix documents whose envelope says ``success=false``."""
    w = F.from_json("payload", MIX_WIRE)
    return payloads.filter(~F.coalesce(wire_bool(w.getField("success")), F.lit(False)))


def parse_prices(payloads: DataFrame, dim: DataFrame, code_col: str = "tariff_code") -> DataFrame:
    """Tariff rates: region comes from the request (tariff code letter), not
    the body; resolved by a broadcast join to the (size-checked) dimension."""
    p = payloads.select("received_at", _file(payloads), tariff_letter(F.col(code_col)).alias("octopus_code"),
                        F.from_json("payload", PRICE_WIRE).alias("w"))
    e = p.select("received_at", "_file", "octopus_code", F.posexplode("w.results").alias("i", "r"))
    regions = broadcast_if_small(dim.select("region_id", "octopus_code").filter(F.col("octopus_code").isNotNull()))
    return e.join(regions, "octopus_code", "inner").select(
        F.col("region_id").cast("int"),
        parse_iso_utc(F.col("r.valid_from")).alias("period_start_utc"),
        parse_iso_utc(F.col("r.valid_to")).alias("period_end_utc"),
        wire_number(F.col("r.value_inc_vat")).alias("price_pence_per_kwh_inc_vat"),
        wire_number(F.col("r.value_exc_vat")).alias("price_pence_per_kwh_exc_vat"),
        _seq(F.col("i")).alias("_seq"),
        F.col("received_at").alias("_received_at"))


def tariff_code_from_path(file: Column) -> Column:
    """Landing layout ``.../<tariff code>/<file>.json`` -> tariff code."""
    return F.regexp_extract(file, r"/(E-1R-[^/]+)/[^/]+$", 1)


def latest_n(df: DataFrame, n: int = 96, order_col: str = "period_start_utc") -> DataFrame:
    """Newest ``n`` rows (top-k: the limit is the feature)."""
    return df.orderBy(F.col(order_col).desc()).limit(n)


def region_seed(spark: SparkSession) -> DataFrame:
    """The 15-row region dimension (national sentinel + 14 regions)."""
    return spark.createDataFrame([r + (None,) for r in REGION_SEED], REGION_SCHEMA)


def plan_windows(span: DataFrame, days: int = BACKFILL_CHUNK_DAYS) -> DataFrame:
    """Cut each ``[start, end)`` row into ``days``-long windows, the last one
    clipped to ``end``; adds the request-format strings."""
    step = days * 86400
    secs = F.timestamp_diff("SECOND", F.col("start"), F.col("end"))
    n = F.ceil(secs / F.lit(step)).cast("int")
    k = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    w = span.select("start", "end", F.explode(k).alias("k"))
    ws = F.col("start") + F.make_dt_interval(F.col("k") * days)
    we = F.least(F.col("start") + F.make_dt_interval((F.col("k") + 1) * days), F.col("end"))
    return w.select(ws.alias("window_start_utc"), we.alias("window_end_utc")).select(
        "window_start_utc", "window_end_utc",
        format_request_ts(F.col("window_start_utc")).alias("from_param"),
        format_request_ts(F.col("window_end_utc")).alias("to_param"))
