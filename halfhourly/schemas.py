"""Table schemas and the fixed values the semantics depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as written for results to match)
# ---------------------------------------------------------------------------

# Accepted carbon-intensity bands, in increasing order of intensity.
INTENSITY_BANDS = ["very low", "low", "moderate", "high", "very high"]

# Region ids 15..18 on the regional feed are rollups (England, Scotland,
# Wales, GB), not distribution regions; they are dropped on ingest.
ROLLUP_REGION_IDS = [15, 16, 17, 18]

# 0 is the national sentinel; 1..14 are the distribution regions.
NATIONAL_REGION_ID = 0
FIRST_DNO_REGION_ID = 1
LAST_DNO_REGION_ID = 14

# Price cards fall back to London when the national sentinel is selected.
DEFAULT_PRICE_REGION_ID = 13

# Fuel columns of the wide generation-mix table, with the label used in the
# long form and whether the fuel counts as renewable.
FUELS = [
    ("gas_mw", "gas", False),
    ("coal_mw", "coal", False),
    ("nuclear_mw", "nuclear", False),
    ("wind_mw", "wind", True),
    ("wind_embedded_mw", "wind_emb", True),
    ("hydro_mw", "hydro", True),
    ("imports_mw", "imports", False),
    ("biomass_mw", "biomass", True),
    ("other_mw", "other", False),
    ("solar_mw", "solar", True),
    ("storage_mw", "storage", False),
]

# Generation-mix wire record: fuel field name -> normalised column.
MIX_WIRE_FUELS = [
    ("GAS", "gas_mw"),
    ("COAL", "coal_mw"),
    ("NUCLEAR", "nuclear_mw"),
    ("WIND", "wind_mw"),
    ("WIND_EMB", "wind_embedded_mw"),
    ("HYDRO", "hydro_mw"),
    ("IMPORTS", "imports_mw"),
    ("BIOMASS", "biomass_mw"),
    ("OTHER", "other_mw"),
    ("SOLAR", "solar_mw"),
    ("STORAGE", "storage_mw"),
]
# Derived roll-ups on the wire; parsed only so that schema drift is caught.
MIX_WIRE_ROLLUPS = ["GENERATION", "CARBON_INTENSITY", "LOW_CARBON", "ZERO_CARBON",
                    "RENEWABLE", "FOSSIL"]
MIX_WIRE_PERC = [f"{w}_perc" for w, _ in MIX_WIRE_FUELS] + [
    "GENERATION_perc", "LOW_CARBON_perc", "ZERO_CARBON_perc", "RENEWABLE_perc",
    "FOSSIL_perc"]

# Region dimension seed: region_id, canonical_code, slug, name,
# carbon_intensity_id, tariff letter.
REGION_SEED = [
    (0, "NATIONAL", "national", "National (UK rollup)", None, None),
    (1, "NORTH_SCOTLAND", "north-scotland", "North Scotland", 1, "P"),
    (2, "SOUTH_SCOTLAND", "south-scotland", "South Scotland", 2, "N"),
    (3, "NORTH_WEST_ENGLAND", "north-west-england", "North West England", 3, "G"),
    (4, "NORTH_EAST_ENGLAND", "north-east-england", "North East England", 4, "F"),
    (5, "YORKSHIRE", "yorkshire", "Yorkshire", 5, "M"),
    (6, "NORTH_WALES_MERSEYSIDE", "north-wales-merseyside", "North Wales & Merseyside", 6, "D"),
    (7, "SOUTH_WALES", "south-wales", "South Wales", 7, "K"),
    (8, "WEST_MIDLANDS", "west-midlands", "West Midlands", 8, "E"),
    (9, "EAST_MIDLANDS", "east-midlands", "East Midlands", 9, "B"),
    (10, "EAST_ENGLAND", "east-england", "East England", 10, "A"),
    (11, "SOUTH_WEST_ENGLAND", "south-west-england", "South West England", 11, "L"),
    (12, "SOUTH_ENGLAND", "south-england", "South England", 12, "H"),
    (13, "LONDON", "london", "London", 13, "C"),
    (14, "SOUTH_EAST_ENGLAND", "south-east-england", "South East England", 14, "J"),
]

# Tariff code layout: E-1R-{product}-{letter}.
TARIFF_CODE_PREFIX = "E-1R-"

# Range queries are capped at 14 days; backfill requests are cut in 14-day chunks.
MAX_RANGE_DAYS = 14
BACKFILL_CHUNK_DAYS = 14

# Archive rewrites yesterday and the day before;
# the hot tables keep 90 days.
ARCHIVE_LOOKBACK_DAYS = 2
HOT_RETENTION_DAYS = 90

# Staleness limits in seconds (two half-hourly feeds, then the daily price feed).
STALENESS_LIMITS_S = {"carbon_intensity": 5400, "generation_mix": 5400, "agile_price": 100800}

# Seconds that a feed must stay stale before its alert fires.
ALERT_HOLD_S = {"carbon_intensity": 1800, "generation_mix": 1800, "agile_price": 7200}

# Fuels (long-form labels) of each published bucket; a fuel may be in several.
FUEL_BUCKETS = {
    "renewable": ["wind", "wind_emb", "hydro", "biomass", "solar"],
    "fossil": ["gas", "coal"],
    "low_carbon": ["nuclear", "wind", "wind_emb", "hydro", "biomass", "solar"],
    "zero_carbon": ["nuclear", "wind", "wind_emb", "hydro", "solar"],
    "wind_total": ["wind", "wind_emb"],
}

# Row-count floors checked after a restore.
ROW_FLOORS = {"carbon_intensity": 100, "generation_mix": 10, "agile_price": 100}

# Published total must be within 5 % of the component sum.
COMPONENT_SUM_TOLERANCE = 0.05

# ---------------------------------------------------------------------------
# Normalised table schemas
# ---------------------------------------------------------------------------

TS = T.TimestampNTZType()

CARBON_SCHEMA = T.StructType([
    T.StructField("region_id", T.IntegerType(), False),
    T.StructField("period_start_utc", TS, False),
    T.StructField("period_end_utc", TS, False),
    T.StructField("forecast_gco2_per_kwh", T.IntegerType(), False),
    T.StructField("actual_gco2_per_kwh", T.IntegerType(), True),
    T.StructField("intensity_index", T.StringType(), False),
    T.StructField("ingested_at_utc", TS, False),
])

MIX_SCHEMA = T.StructType(
    [T.StructField("period_start_utc", TS, False)]
    + [T.StructField(c, T.DoubleType(), False) for c, _, _ in FUELS]
    + [T.StructField("total_generation_mw", T.DoubleType(), False),
       T.StructField("neso_carbon_intensity_gco2_per_kwh", T.DoubleType(), False),
       T.StructField("ingested_at_utc", TS, False)]
)

PRICE_SCHEMA = T.StructType([
    T.StructField("region_id", T.IntegerType(), False),
    T.StructField("period_start_utc", TS, False),
    T.StructField("period_end_utc", TS, False),
    T.StructField("price_pence_per_kwh_inc_vat", T.DoubleType(), False),
    T.StructField("price_pence_per_kwh_exc_vat", T.DoubleType(), False),
    T.StructField("ingested_at_utc", TS, False),
])

REGION_SCHEMA = T.StructType([
    T.StructField("region_id", T.IntegerType(), False),
    T.StructField("canonical_code", T.StringType(), False),
    T.StructField("slug", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("carbon_intensity_id", T.IntegerType(), True),
    T.StructField("octopus_code", T.StringType(), True),
    T.StructField("notes", T.StringType(), True),
])

# Natural keys.
CARBON_KEY = ["region_id", "period_start_utc"]
PRICE_KEY = ["region_id", "period_start_utc"]
MIX_KEY = ["period_start_utc"]

# Lake (archive) tables: same columns minus ingested_at, 32-bit floats, plus
# the derived day partition column.
LAKE_TABLES = {
    "carbon_intensity": CARBON_SCHEMA,
    "generation_mix": MIX_SCHEMA,
    "agile_price": PRICE_SCHEMA,
}


def lake_schema(name: str) -> T.StructType:
    """Archive schema: drop ``ingested_at_utc``, store MW/pence as FLOAT."""
    fields = []
    for f in LAKE_TABLES[name].fields:
        if f.name == "ingested_at_utc":
            continue
        dt = T.FloatType() if isinstance(f.dataType, T.DoubleType) else f.dataType
        fields.append(T.StructField(f.name, dt, f.nullable))
    return T.StructType(fields)
