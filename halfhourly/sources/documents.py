"""Wire documents built from the driver tables: the stand-in for landed payload files.

Each function gives one row per document (``payload``, ``received_at``, ``source``, ``file`` and,
for prices, ``tariff_code``).  A document holds at most what its grain allows: one period
(national), the regions of one half-hour (regional), the half-hours of one day (generation
mix, prices), so no group grows with the input.  Some documents are planted with a
fault or an unusual but valid form, chosen by event id, half-hour or day; they exercise the
contract check and the parsers on every row of ``events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halfhourly.functions.columns import half_hour, plus_minutes, tariff_code
from halfhourly.schemas import MIX_WIRE_FUELS, MIX_WIRE_PERC, MIX_WIRE_ROLLUPS
from halfhourly.sources import adapters

NATIONAL_FORMS = 16     # planted by event_id % 16
REGIONAL_FORMS = 9      # planted by half-hour of the day % 9
PRODUCT = "STANDIN-01"


def _wall(ts: Column, form: str) -> Column:
    """A wall clock as text, cut from the plain cast (no session time zone)."""
    text = ts.cast("string")
    day, minute, second = F.substring(text, 1, 10), F.substring(text, 12, 5), F.substring(text, 12, 8)
    return {"minute": F.concat(day, F.lit("T"), minute), "second": F.concat(day, F.lit("T"), second)}[form]


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def national(events: DataFrame) -> DataFrame:
    """One document per event, one period each."""
    k = F.col("event_id") % NATIONAL_FORMS
    start = half_hour("ts")
    own = events.select("event_id", "ts", "event_type", "value", k.alias("k"), start.alias("s"))
    k = F.col("k")
    number = F.floor("value").cast("int").cast("string")
    begin = (F.when(k == 3, F.concat(_wall(plus_minutes(F.col("s"), 60), "minute"), F.lit("+0100")))
             .when(k == 4, F.concat(_wall(F.col("s"), "second"), F.lit(".0000000Z")))
             .when(k == 8, F.lit("2026-02-31T14:30Z"))
             .when(k == 13, F.lit("2026-05-21T25:61Z"))
             .otherwise(F.concat(_wall(F.col("s"), "minute"), F.lit("Z"))))
    forecast = (F.when(k == 1, _quoted(number)).when(k == 2, F.concat(number, F.lit(".0")))
                .when(k == 9, F.lit("99999999999")).when(k == 10, F.concat(number, F.lit(".5")))
                .when(k == 11, F.lit("null")).otherwise(number))
    actual = F.when(F.col("event_type") == "purchase", F.floor(F.col("value") * 1.1).cast("int").cast("string")).otherwise("null")
    band = F.when(k == 7, F.lit("Extreme")).otherwise(adapters.band_of_forecast(F.floor("value")))
    body = F.concat(
        F.lit('{"data":[{"from":'), _quoted(begin), F.lit(',"to":'),
        _quoted(F.concat(_wall(plus_minutes(F.col("s"), 30), "minute"), F.lit("Z"))),
        F.lit(',"intensity":{"forecast":'), forecast,
        F.when(k == 6, F.lit("")).otherwise(F.concat(F.lit(',"actual":'), actual)),
        F.lit(',"index":'), _quoted(band), F.when(k == 5, F.lit(',"leftover":1')).otherwise(F.lit("")), F.lit("}}]}"))
    return own.select(
        F.when(k == 12, F.lit("not json")).otherwise(body).alias("payload"), F.col("ts").alias("received_at"),
        F.lit("national").alias("source"),
        F.concat(F.lit("national/"), F.lpad(F.col("event_id").cast("string"), 12, "0"), F.lit(".json")).alias("file"))


def regional(events: DataFrame) -> DataFrame:
    """One document per half-hour with the regions seen in it (fifteen at most); region 0 goes out as the rollup 18."""
    own = adapters.carbon_table(events)
    one = F.struct(
        F.when(F.col("region_id") == 0, 18).otherwise(F.col("region_id")).alias("regionid"),
        F.concat(F.lit("Region "), F.col("region_id").cast("string")).alias("dnoregion"), F.lit("R").alias("shortname"),
        F.struct(F.col("forecast_gco2_per_kwh").alias("forecast"), F.col("intensity_index").alias("index")).alias("intensity"),
        F.array(F.struct(F.lit("wind").alias("fuel"), F.lit(12.5).alias("perc"))).alias("generationmix"))
    docs = own.groupBy("period_start_utc").agg(F.array_sort(F.collect_list(one)).alias("regions"),
                                               F.max("ingested_at_utc").alias("received_at"))
    at = F.col("period_start_utc")
    period = F.struct(F.concat(_wall(at, "minute"), F.lit("Z")).alias("from"),
                      F.concat(_wall(plus_minutes(at, 30), "minute"), F.lit("Z")).alias("to"), "regions")
    text = F.to_json(F.struct(F.array(period).alias("data")))
    form = (F.hour(at) * 2 + F.floor(F.minute(at) / 30)) % REGIONAL_FORMS
    return docs.select(
        F.when(form == 3, F.replace(text, F.lit('"data"'), F.lit('"datum"')))
        .when(form == 5, F.replace(text, F.lit('"perc"'), F.lit('"pct"'))).otherwise(text).alias("payload"),
        "received_at", F.lit("regional").alias("source"),
        F.concat(F.lit("regional/"), _wall(at, "minute"), F.lit(".json")).alias("file"))


def generation_mix(events: DataFrame) -> DataFrame:
    """One document per day with its half-hours (48 at most); a fuel without events is 0, but null on some days."""
    wide = adapters.generation_mix_wide(events)
    at, form = F.col("period_start_utc"), F.dayofmonth("period_start_utc") % 7
    clock = F.when(form == 2, _wall(at, "minute")).otherwise(_wall(at, "second"))
    fuel = {w: F.when(form == 4, F.col(c)).otherwise(F.coalesce(F.col(c), F.lit(0.0))) for w, c in MIX_WIRE_FUELS}
    record = F.struct(
        (F.hour(at) * 2 + F.minute(at) / 30).cast("int").alias("_id"), clock.alias("DATETIME"),
        *[v.alias(w) for w, v in fuel.items()], F.col("total_generation_mw").alias("GENERATION"),
        F.col("neso_carbon_intensity_gco2_per_kwh").alias("CARBON_INTENSITY"),
        *[F.lit(1.0).alias(w) for w in [*MIX_WIRE_ROLLUPS[2:], *MIX_WIRE_PERC]])
    day = F.to_date("period_start_utc")
    docs = wide.groupBy(day.alias("day")).agg(F.array_sort(F.collect_list(record)).alias("records"),
                                              F.max("ingested_at_utc").alias("received_at"))
    text = F.to_json(F.struct((F.dayofmonth("day") % 7 != 1).alias("success"), F.lit("about").alias("help"),
                              F.struct("records", F.size("records").alias("total")).alias("result")),
                     {"ignoreNullFields": "false"})
    return docs.select(
        F.when(F.dayofmonth("day") % 7 == 3, F.replace(text, F.lit('"COAL_perc"'), F.lit('"COAL_pct"')))
        .otherwise(text).alias("payload"),
        "received_at", F.lit("generation_mix").alias("source"),
        F.concat(F.lit("generation_mix/"), F.col("day").cast("string"), F.lit(".json")).alias("file"))


def prices(events: DataFrame) -> DataFrame:
    """One document per region and day with its rates (48 at most); region 14 sometimes asks with an unknown
    letter, region 13 sometimes without a code."""
    own = adapters.price_table(events)
    day, at = F.to_date("period_start_utc"), F.col("period_start_utc")
    form = F.dayofmonth("period_start_utc") % 6
    begin = (F.when(form == 2, F.concat(_wall(plus_minutes(at, 60), "minute"), F.lit("+01:00")))
             .otherwise(F.concat(_wall(at, "second"), F.lit("Z"))))
    rate = F.struct(
        at.alias("_at"),
        F.col("price_pence_per_kwh_exc_vat").alias("value_exc_vat"), F.col("price_pence_per_kwh_inc_vat").alias("value_inc_vat"),
        begin.alias("valid_from"), F.concat(_wall(plus_minutes(at, 30), "second"), F.lit("Z")).alias("valid_to"),
        F.lit(None).cast("string").alias("payment_method"))
    docs = own.groupBy("region_id", day.alias("day")).agg(F.array_sort(F.collect_list(rate)).alias("rates"),
                                                          F.max("ingested_at_utc").alias("received_at"))
    rates = F.transform("rates", lambda r: r.dropFields("_at"))
    text = F.to_json(F.struct(F.size("rates").alias("count"), F.lit(None).cast("string").alias("next"),
                              F.lit(None).cast("string").alias("previous"), rates.alias("results")),
                     {"ignoreNullFields": "false"})
    n = F.dayofmonth("day")
    letter = (F.when((F.col("region_id") == 14) & (n % 2 == 1), F.lit("Z"))
              .otherwise(F.substring(F.lit("ABCDEFGHIJKLMN"), F.col("region_id"), 1)))
    code = F.when(~((F.col("region_id") == 13) & (n % 5 == 0)), tariff_code(PRODUCT, letter))
    return docs.select(
        F.when(n % 6 == 1, F.regexp_replace(text, r'"value_inc_vat":([0-9.E-]+)', '"value_inc_vat":"$1"'))
        .when(n % 6 == 3, F.replace(text, F.lit(',"payment_method":null'), F.lit("")))
        .when(n % 6 == 4, F.regexp_replace(text, r'"count":[0-9]+', '"count":true')).otherwise(text).alias("payload"),
        "received_at", F.lit("prices").alias("source"),
        F.concat(F.lit("prices/"), F.col("region_id").cast("string"), F.lit("/"), F.col("day").cast("string"),
                 F.lit(".json")).alias("file"),
        code.alias("tariff_code"))
