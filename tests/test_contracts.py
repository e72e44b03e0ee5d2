"""Wire contracts and parsers: round trips, counts, UTC, drift rejection."""

import copy
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from halfhourly.sources import contracts, payloads
from payload_fixtures import NATIONAL, NATIONAL_NULL_ACTUAL, dumps, generation_mix, prices, regional


def _frame(spark, docs, received="2027-07-11 14:31:00", extra=None):
    rows = [(dumps(d), datetime.fromisoformat(received), "test") + tuple(extra or ()) for d in docs]
    cols = "payload string, received_at timestamp_ntz, source string"
    if extra:
        cols += ", tariff_code string"
    return spark.createDataFrame(rows, cols)


def _violations(spark, doc, spec):
    df = _frame(spark, [doc]).select(contracts.violations(F.col("payload"), spec).alias("v"))
    return df.first().v


def test_national_parses_one_row(spark):
    assert _violations(spark, NATIONAL, contracts.NATIONAL) == []
    rows = payloads.parse_national(_frame(spark, [NATIONAL])).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.region_id == 0
    assert r.period_start_utc == datetime(2027, 7, 11, 14, 30)
    assert r.period_end_utc == datetime(2027, 7, 11, 15, 0)
    assert (r.forecast_gco2_per_kwh, r.actual_gco2_per_kwh, r.intensity_index) == (143, 151, "moderate")


def test_national_null_actual(spark):
    assert _violations(spark, NATIONAL_NULL_ACTUAL, contracts.NATIONAL) == []
    r = payloads.parse_national(_frame(spark, [NATIONAL_NULL_ACTUAL])).first()
    assert r.actual_gco2_per_kwh is None


def test_regional_drops_rollups(spark):
    doc = regional()
    assert _violations(spark, doc, contracts.REGIONAL) == []
    rows = payloads.parse_regional(_frame(spark, [doc])).collect()
    assert sorted(r.region_id for r in rows) == list(range(1, 15))
    assert all(r.actual_gco2_per_kwh is None for r in rows)
    assert [r.forecast_gco2_per_kwh for r in rows if r.region_id == 3] == [0]


def test_generation_mix_parses_and_pins_utc(spark):
    doc = generation_mix()
    assert _violations(spark, doc, contracts.GENERATION_MIX) == []
    rows = payloads.parse_generation_mix(_frame(spark, [doc])).orderBy("period_start_utc").collect()
    assert len(rows) == 3
    assert rows[0].period_start_utc == datetime(2027, 8, 2, 12, 0)
    assert rows[0].hydro_mw == 111.0
    comp = sum(getattr(rows[0], c) for c in ["gas_mw", "coal_mw", "nuclear_mw", "wind_mw", "wind_embedded_mw",
                                             "hydro_mw", "imports_mw", "biomass_mw", "other_mw", "solar_mw",
                                             "storage_mw"])
    assert comp == pytest.approx(rows[0].total_generation_mw)


def test_generation_mix_success_false_yields_no_rows(spark):
    df = _frame(spark, [generation_mix(success=False)])
    assert payloads.parse_generation_mix(df).count() == 0
    assert payloads.reject_unsuccessful(df).count() == 1


def test_prices_take_region_from_code(spark):
    dim = payloads.region_seed(spark)
    df = _frame(spark, [prices(4)], extra=("E-1R-AGILE-24-10-01-C",))
    rows = payloads.parse_prices(df, dim).collect()
    assert len(rows) == 4 and {r.region_id for r in rows} == {13}
    assert all(r.price_pence_per_kwh_inc_vat > r.price_pence_per_kwh_exc_vat for r in rows)
    assert _violations(spark, prices(5), contracts.PRICES) == []


@pytest.mark.parametrize("where", ["top", "intensity", "period"])
def test_national_unknown_key_rejected(spark, where):
    doc = copy.deepcopy(NATIONAL)
    target = {"top": doc, "intensity": doc["data"][0]["intensity"], "period": doc["data"][0]}[where]
    target["leftover"] = 1
    v = _violations(spark, doc, contracts.NATIONAL)
    assert len(v) == 1 and "leftover: unknown key" in v[0]


def test_regional_unknown_key_inside_region_rejected(spark):
    doc = regional()
    doc["data"][0]["regions"][4]["extra"] = "x"
    v = _violations(spark, doc, contracts.REGIONAL)
    assert v == ["$.data[0].regions[4].extra: unknown key"]


def test_mix_unknown_key_in_record_rejected_but_envelope_open(spark):
    doc = generation_mix()
    doc["result"]["records"][1]["NEW_FUEL"] = 1.0
    doc["result"]["anything"] = 1
    doc["more"] = 2
    v = _violations(spark, doc, contracts.GENERATION_MIX)
    assert v == ["$.result.records[1].NEW_FUEL: unknown key"]


def test_price_unknown_key_in_rate_rejected(spark):
    doc = prices(2)
    doc["results"][1]["tier"] = 2
    assert _violations(spark, doc, contracts.PRICES) == ["$.results[1].tier: unknown key"]


def test_missing_key_wrong_type_bad_enum(spark):
    doc = copy.deepcopy(NATIONAL)
    del doc["data"][0]["intensity"]["actual"]
    assert _violations(spark, doc, contracts.NATIONAL) == ["$.data[0].intensity.actual: missing key"]
    doc = copy.deepcopy(NATIONAL)
    doc["data"][0]["intensity"]["index"] = "Extreme"
    assert _violations(spark, doc, contracts.NATIONAL) == ["$.data[0].intensity.index: not an accepted value"]
    doc = copy.deepcopy(NATIONAL)
    doc["data"][0]["intensity"]["forecast"] = None
    assert _violations(spark, doc, contracts.NATIONAL) == ["$.data[0].intensity.forecast: null"]


@pytest.mark.parametrize("value,ok", [(89, True), (89.0, True), ("89", True), (89.5, False), (True, False)])
def test_lax_integer_coercion(spark, value, ok):
    doc = copy.deepcopy(NATIONAL)
    doc["data"][0]["intensity"]["forecast"] = value
    assert (_violations(spark, doc, contracts.NATIONAL) == []) == ok


@pytest.mark.parametrize("text", ["2027-07-11T14:30Z", "2027-07-11T15:30+0100", "2027-07-11T14:30:00.0000000Z",
                                  "2027-07-11T12:30:00-02:00", "2026-02-31T14:30Z", "2027-07-11T25:61Z", "2027-07-11T14:30",
                                  "2027-07-11", ""])
def test_contract_accepts_what_the_parser_reads(spark, text):
    """A time is in violation exactly if it parses to NULL, and the good forms name one instant."""
    doc = copy.deepcopy(NATIONAL)
    doc["data"][0]["from"] = text
    v = _violations(spark, doc, contracts.NATIONAL)
    start = payloads.parse_national(_frame(spark, [doc])).first().period_start_utc
    assert (v == []) == (start is not None)
    assert start in (None, datetime(2027, 7, 11, 14, 30)) and v in ([], ["$.data[0].from: not instant"])


@pytest.mark.parametrize("value", ["89", 89.0, 99999999999, "abc", 1e300])
def test_numbers_are_read_or_rejected(spark, value):
    doc = copy.deepcopy(NATIONAL)
    doc["data"][0]["intensity"]["forecast"] = value
    v = _violations(spark, doc, contracts.NATIONAL)
    read = payloads.parse_national(_frame(spark, [doc])).first().forecast_gco2_per_kwh
    assert (read, v) == ((89, []) if value in ("89", 89.0) else (None, ["$.data[0].intensity.forecast: not int"]))


@pytest.mark.parametrize("text,ok", [("2027-08-02T13:00", True), ("2027-08-02 13:00:00.1234567", True), ("2027-08-02T13:00Z", False)])
def test_naive_forms(spark, text, ok):
    doc = generation_mix()
    doc["result"]["records"][0]["DATETIME"] = text
    v = _violations(spark, doc, contracts.GENERATION_MIX)
    assert v == ([] if ok else ["$.result.records[0].DATETIME: not naive"])
    nulls = payloads.parse_generation_mix(_frame(spark, [doc])).filter("period_start_utc IS NULL").count()
    assert nulls == (0 if ok else 1)


def test_split_contract(spark):
    bad = copy.deepcopy(NATIONAL)
    bad["x"] = 1
    good_df, bad_df = contracts.split_contract(_frame(spark, [NATIONAL, bad]), contracts.NATIONAL)
    assert good_df.count() == 1 and bad_df.count() == 1


def test_minute_precision_instant(spark):
    from halfhourly.functions.columns import parse_iso_utc
    df = spark.createDataFrame([("2027-07-11T14:30Z",), ("2027-07-11T14:30:00Z",), ("2027-07-11T15:30:00+01:00",)], "s string")
    got = [r.t for r in df.select(parse_iso_utc(F.col("s")).alias("t")).collect()]
    assert got == [datetime(2027, 7, 11, 14, 30)] * 3


def test_price_fan_out_over_two_regions(spark):
    """One scan over two tariff folders: 4 rates x 2 regions = 8 rows."""
    dim = payloads.region_seed(spark)
    rows = [(dumps(prices(4)), datetime(2027, 7, 11, 9, 0), "prices", f"/land/prices/E-1R-AGILE-24-10-01-{c}/p.json")
            for c in ("C", "J")]
    df = spark.createDataFrame(rows, "payload string, received_at timestamp_ntz, source string, file string")
    df = df.withColumn("tariff_code", payloads.tariff_code_from_path(F.col("file")))
    out = payloads.parse_prices(df, dim).collect()
    assert len(out) == 8
    assert sorted({r.region_id for r in out}) == [13, 14]


def test_wire_times_do_not_depend_on_session_zone(spark):
    """Parsed instants are UTC wall clock even in a session set to London
    (BST in May: a zone leak would show as a one-hour shift)."""
    from halfhourly.functions.columns import parse_iso_utc, parse_naive_utc
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/London")
    try:
        df = spark.createDataFrame([("2027-07-11T14:30Z", "2026-03-29T01:30:00")], "a string, b string")
        r = df.select(parse_iso_utc(F.col("a")).alias("a"), parse_naive_utc(F.col("b")).alias("b")).first()
        assert r.a == datetime(2027, 7, 11, 14, 30)
        assert r.b == datetime(2026, 3, 29, 1, 30)   # inside London's spring-forward gap
        assert payloads.parse_national(_frame(spark, [NATIONAL])).first().period_start_utc == datetime(2027, 7, 11, 14, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_quality_checks_on_parsed_payloads(spark):
    from halfhourly.operators import marts, quality
    regional_rows = payloads.parse_regional(_frame(spark, [regional()]))
    cov = quality.region_coverage(regional_rows).collect()
    assert len(cov) == 1 and cov[0].regions == 14 and cov[0].complete
    report = {r.check: r.violations for r in quality.row_checks(
        regional_rows, "carbon_intensity", [quality.regional_actual_null_check(), quality.period_order_check()]).collect()}
    assert report == {"regional_actual_null": 0, "period_order": 0}
    mix = payloads.parse_generation_mix(_frame(spark, [generation_mix()]))
    assert quality.fuels_per_period(marts.generation_mix_long(mix)).count() == 0
    comp = quality.row_checks(mix, "generation_mix", [quality.component_sum_check()]).first()
    assert comp.violations == 0
    shares = marts.generation_mix_long(mix).groupBy("period_start_utc").agg(F.sum("share_of_generation_pct").alias("s"))
    assert all(abs(r.s - 100.0) < 1e-9 for r in shares.collect())
