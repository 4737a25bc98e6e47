"""Fixed values of the domain: vocabularies, thresholds and table contracts."""

# ---------------------------------------------------------------------------
# Fixed values. Results depend on each of these; do not edit without a reason.
# ---------------------------------------------------------------------------
COUNTRY_ALIASES = {
    "usa": "United States",
    "us": "United States",
    "u.s.": "United States",
    "uk": "United Kingdom",
    "uae": "United Arab Emirates",
}

FUEL_ALIASES = {
    "coal": "Coal",
    "lignite": "Coal",
    "natural gas": "Gas",
    "gas": "Gas",
    "hydro": "Hydro",
    "hydroelectric": "Hydro",
    "solar": "Solar",
    "wind": "Wind",
    "nuclear": "Nuclear",
    "oil": "Oil",
    "diesel": "Oil",
    "biomass": "Biomass",
    "geothermal": "Geothermal",
}

RENEWABLE_FUELS = ("Hydro", "Solar", "Wind", "Biomass", "Geothermal")

PLACEHOLDERS = ("", "?", "unknown", "unk", "na", "n/a", "null", "none", "0", "-", "--")

COUNTRY_REGIONS = {
    "United States": ("North America", "Northern America"),
    "United Kingdom": ("Europe", "Northern Europe"),
    "India": ("Asia", "Southern Asia"),
    "Germany": ("Europe", "Western Europe"),
    "France": ("Europe", "Western Europe"),
    "Brazil": ("South America", "South America"),
    "Canada": ("North America", "Northern America"),
    "China": ("Asia", "Eastern Asia"),
    "Australia": ("Oceania", "Australia and New Zealand"),
}
OTHER_REGION = "Other"

REQUIRED_COLUMNS = ("plant_id", "plant_name", "country", "capacity_mw", "primary_fuel")
NUMERIC_COLUMNS = ("capacity_mw", "estimated_generation_gwh")
RANGE_RULES = {"capacity_mw": (0.0001, 1000000.0), "commissioning_year": (1850.0, 2100.0)}
MANDATORY_COLUMNS = ("plant_name", "country", "primary_fuel", "capacity_mw")

GWH_PER_MW_YEAR = 8.76
UNDERUTILISED_BELOW = 0.40
SPIKE_RATIO = 2.0
DROP_RATIO = 0.5
SLA_HOURS = 24.0

METRIC_PREFIXES = (
    "bronze_", "silver_", "gold_", "freshness_", "volume_", "dq_", "visualizations_", "renewable_",
)
METRIC_NAMES = ("dq_failure_count", "renewable_energy_ratio")
STAGE_METRICS = {
    "bronze": "bronze_rows_ingested",
    "silver": "silver_valid_rows",
    "gold": "gold_rows_fact_capacity",
    "visualizations": "visualizations_generated",
}

# Service levels: share of duplicate keys, of mandatory nulls and of quarantined
# rows, and hours of lag.
SLO_MANDATORY_NULL_RATE = 0.005
SLO_LAG_HOURS = 24.0
SLO_QUARANTINE_RATIO = 0.02
# ---------------------------------------------------------------------------

RAW_NUMERIC_COLUMNS = (
    "capacity_mw", "capacity_kw", "capacity_gw", "commissioning_year",
    "latitude", "longitude", "estimated_generation_gwh",
)
YEARLY_GENERATION_PREFIX = "estimated_generation_gwh_"
TEXT_COLUMNS = ("plant_name", "country", "primary_fuel")
