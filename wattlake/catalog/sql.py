"""DuckDB text for the checks: expression snippets and the shared tables as CTEs."""

from __future__ import annotations

from wattlake.sources.bindings import AGE_AS_OF, AS_OF, METRIC_OF_EVENT

# Fixed values, stated here once more so that the SQL does not share a mistake with the engine.
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
BLANK_CHARS = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000"
BLANKS = r"[\t\n\v\f\r\x1c-\x1f\x85\p{Z}]+"
WORD_OR_GAP = r"(\p{L}+|\P{L}+)"

RUN = f"TIMESTAMP '{AS_OF}'"
AGE = f"TIMESTAMP '{AGE_AS_OF}'"


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def strip(c: str) -> str:
    return f"trim({c}, '{BLANK_CHARS}')"


def clean(c: str) -> str:
    return f"regexp_replace({strip(f'lower({c})')}, '{BLANKS}', ' ', 'g')"


def title(c: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({c}), '{WORD_OR_GAP}'), "
        "lambda w: concat(replace(upper(w[1]), 'ẞ', 'Ss'), w[2:])), '')"
    )


def no_placeholder(c: str) -> str:
    return f"CASE WHEN lower({strip(c)}) NOT IN ({quoted(PLACEHOLDERS)}) THEN {strip(c)} END"


def case_of(c: str, mapping: dict[str, str], otherwise: str) -> str:
    arms = " ".join(f"WHEN {quoted([k])} THEN {quoted([v])}" for k, v in mapping.items())
    return f"CASE {c} {arms} ELSE {otherwise} END"


def canonical(c: str, aliases: dict[str, str]) -> str:
    known = case_of(clean(c), aliases, title(strip(c)))
    return f"CASE WHEN {clean(c)} NOT IN ({quoted(PLACEHOLDERS)}) THEN {known} END"


def has_text(*columns: str) -> str:
    return " AND ".join(f"{strip(c)} <> ''" for c in columns)


def known(*columns: str) -> str:
    tokens = quoted([p for p in PLACEHOLDERS if p])
    return " AND ".join(f"lower({strip(c)}) NOT IN ({tokens})" for c in columns)


def present(*columns: str) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in columns)


def summed(c: str) -> str:
    return f"sum(CAST({c} AS DOUBLE))"


def total(c: str) -> str:
    return f"coalesce({summed(c)}, 0.0::DOUBLE)"


def mean(c: str) -> str:
    return f"avg(CAST({c} AS DOUBLE))"


def ratio(part: str, whole: str) -> str:
    return f"(CASE WHEN {whole} = 0 THEN 0.0::DOUBLE ELSE {part} / {whole} END)"


def iso(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%dT%H:%M:%S.%f+00:00')"


def year_text(c: str) -> str:
    return f"CAST(CAST(round(CAST({c} AS DOUBLE)) AS INTEGER) AS VARCHAR)"


def row_hash(*columns: str) -> str:
    pairs = ", ".join(
        f"CASE WHEN CAST({c} AS VARCHAR) <> '' THEN '{c}=' || CAST({c} AS VARCHAR) END" for c in sorted(columns)
    )
    return f"sha256(concat_ws(chr(1), {pairs}))"


def hash_sum(digest: str) -> str:
    return f"CAST(sum(CAST(CAST('0x' || substr({digest}, 1, 15) AS BIGINT) AS DECIMAL(38,0))) AS VARCHAR)"


_CONTINENTS = {k: v[0] for k, v in COUNTRY_REGIONS.items()}
_SUB_REGIONS = {k: v[1] for k, v in COUNTRY_REGIONS.items()}

GOOD = (
    "plant_id IS NOT NULL AND plant_name IS NOT NULL AND country IS NOT NULL AND capacity_mw IS NOT NULL "
    "AND primary_fuel IS NOT NULL AND capacity_mw BETWEEN 0.0001 AND 1000000 "
    "AND (commissioning_year IS NULL OR commissioning_year BETWEEN 1850 AND 2100)"
)

# Name -> (the CTEs it reads, its text). Generated column lists follow the engine's table contracts.
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "plant_attributes": (
        (),
        """
        SELECT CAST(c_custkey AS VARCHAR) AS plant_id, c_name AS plant_name,
               CASE WHEN c_custkey % 17 = 0 THEN ' n/a ' WHEN c_custkey % 19 = 0 THEN 'usa'
                    WHEN c_custkey % 23 = 0 THEN ' UK' ELSE lower(n_name) END AS country,
               r_name AS region_name,
               CASE WHEN c_custkey % 29 = 0 THEN 'unknown' WHEN c_mktsegment = 'BUILDING' THEN 'coal'
                    WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Natural  Gas'
                    WHEN c_mktsegment = 'MACHINERY' THEN 'hydroelectric'
                    WHEN c_mktsegment = 'HOUSEHOLD' THEN ' WIND' ELSE 'tidal' END AS primary_fuel,
               c_acctbal AS capacity_mw,
               CASE WHEN c_custkey % 31 = 0 THEN NULL WHEN c_custkey % 37 = 0 THEN 1700.0::DOUBLE
                    ELSE CAST(1950 + c_custkey % 75 AS DOUBLE) END AS commissioning_year,
               CAST(c_custkey % 180 AS DOUBLE) - 90 AS latitude,
               CASE WHEN c_custkey % 41 <> 0 THEN CAST(c_custkey % 360 AS DOUBLE) - 180 END AS longitude,
               CASE WHEN c_custkey % 43 = 0 THEN ' ' ELSE c_name END AS owner
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    "plants_raw": (
        ("plant_attributes",),
        """
        SELECT a.*, g.estimated_generation_gwh, g.event_time
        FROM plant_attributes a LEFT JOIN (
          SELECT CAST(o_custkey AS VARCHAR) AS plant_id, max(o_orderdate) AS event_time,
                 CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 1000 AS estimated_generation_gwh
          FROM orders GROUP BY 1) g USING (plant_id)""",
    ),
    "readings": (
        ("plant_attributes",),
        """
        SELECT a.*, o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) / 1000 AS estimated_generation_gwh,
               o_orderdate AS event_time, o_orderdate AS ingested_at, o_orderpriority AS source_name,
               o_orderstatus AS status
        FROM orders JOIN plant_attributes a ON CAST(o_custkey AS VARCHAR) = a.plant_id""",
    ),
    "batch": (
        ("plants_raw",),
        f"""
        SELECT *, {case_of('country', _CONTINENTS, "'Other'")} AS continent,
               {case_of('country', _SUB_REGIONS, "'Other'")} AS sub_region
        FROM (SELECT plant_id, {no_placeholder('plant_name')} AS plant_name,
                     {canonical('country', COUNTRY_ALIASES)} AS country,
                     {canonical('primary_fuel', FUEL_ALIASES)} AS primary_fuel,
                     {no_placeholder('country')} AS raw_country, {no_placeholder('primary_fuel')} AS raw_fuel,
                     capacity_mw, commissioning_year, latitude, longitude,
                     nullif({strip('owner')}, '') AS owner, estimated_generation_gwh, event_time,
                     {iso(f'coalesce(event_time, {RUN})')} AS ingested_at
              FROM plants_raw)""",
    ),
    "silver": (
        ("batch",),
        f"""
        SELECT * EXCLUDE (raw_country, raw_fuel), CAST(coalesce(year(event_time), year({RUN})) AS BIGINT) AS event_year,
               CAST(coalesce(month(event_time), 1) AS BIGINT) AS event_month
        FROM batch WHERE {GOOD}""",
    ),
    "dim_plant": (
        ("silver",),
        f"""
        SELECT plant_id, plant_name, country, capacity_mw, primary_fuel, commissioning_year, latitude, longitude,
               CASE WHEN {has_text("coalesce(owner, '')")} THEN 'OWNER_' || substr(sha256({strip('owner')}), 1, 10)
                    ELSE 'UNKNOWN' END AS owner_masked
        FROM silver""",
    ),
    "dim_country": (
        ("silver",),
        """
        SELECT country, CAST(row_number() OVER (ORDER BY country NULLS LAST) AS INTEGER) AS country_id
        FROM (SELECT DISTINCT country FROM silver)""",
    ),
    "dim_fuel_type": (
        ("silver",),
        f"""
        SELECT primary_fuel, CAST(row_number() OVER (ORDER BY primary_fuel NULLS LAST) AS INTEGER) AS fuel_type_id,
               coalesce(primary_fuel IN ({quoted(RENEWABLE_FUELS)}), false) AS is_renewable
        FROM (SELECT DISTINCT primary_fuel FROM silver)""",
    ),
    "fact_plant_capacity": (
        ("silver",),
        f"""
        SELECT country, primary_fuel, mw AS total_capacity_mw,
               CASE WHEN primary_fuel IN ({quoted(RENEWABLE_FUELS)}) THEN mw ELSE 0.0::DOUBLE END AS renewable_capacity_mw
        FROM (SELECT country, primary_fuel, {total('capacity_mw')} AS mw FROM silver GROUP BY ALL)""",
    ),
    "fact_power_generation": (
        ("silver",),
        f"""
        SELECT country, primary_fuel, event_year AS year, {total('estimated_generation_gwh')} AS total_generation_gwh
        FROM silver GROUP BY ALL""",
    ),
    "fact_power_generation_time": (
        ("silver",),
        f"""
        SELECT event_year AS year, event_month AS month, {total('estimated_generation_gwh')} AS total_generation_gwh
        FROM silver GROUP BY ALL""",
    ),
    "fact_capacity_geo": (
        ("silver",),
        f"SELECT continent, sub_region, {total('capacity_mw')} AS total_capacity_mw FROM silver GROUP BY ALL",
    ),
    "generation_flagged": (
        ("fact_power_generation", "dim_fuel_type"),
        """
        SELECT g.*, coalesce(f.is_renewable, false) AS is_renewable
        FROM fact_power_generation g LEFT JOIN dim_fuel_type f USING (primary_fuel)""",
    ),
    "metrics_log": (
        (),
        f"""
        SELECT {iso('ts')} AS metric_timestamp, {case_of('event_type', METRIC_OF_EVENT, 'NULL')} AS metric_name,
               value AS metric_value, ts
        FROM events""",
    ),
    "source_log": ((), "SELECT l.*, s_name AS source_name FROM lineitem l JOIN supplier ON l_suppkey = s_suppkey"),
    "source_state": (
        ("source_log",),
        """
        SELECT source_name, max(l_shipdate) AS last_ingested_at,
               max(CASE WHEN l_linestatus = 'F' THEN l_shipdate END) AS event_time_watermark, count(*) AS last_rows
        FROM source_log GROUP BY 1""",
    ),
    "source_outcomes": (
        ("source_log",),
        """
        SELECT source_name, n AS rows, returned, late_arriving_rows, accepted,
               CASE WHEN returned * 30 > n * 11 THEN 'failed' WHEN accepted * 30 > n * 11 THEN 'skipped'
                    ELSE 'ingested' END AS status
        FROM (SELECT source_name, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS returned,
                     count(*) FILTER (l_linestatus = 'F') AS late_arriving_rows,
                     count(*) FILTER (l_returnflag = 'A') AS accepted
              FROM source_log GROUP BY 1)""",
    ),
    "source_registry": (
        (),
        """
        SELECT s_name AS source_name, CASE WHEN s_acctbal > 0 THEN true WHEN s_acctbal < 0 THEN false END AS enabled,
               CASE WHEN s_acctbal > 5000 THEN 48.0::DOUBLE END AS freshness_update_sla_hours, s_suppkey
        FROM supplier""",
    ),
}


def with_ctes(select: str, *names: str, **extra: str) -> str:
    """A query over the named shared tables; ``extra`` adds CTEs of its own after them."""
    wanted: list[str] = []

    def need(name: str) -> None:
        for other in CTES[name][0]:
            need(other)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        need(name)
    parts = [f"{n} AS ({CTES[n][1]})" for n in wanted] + [f"{n} AS ({text})" for n, text in extra.items()]
    return f"WITH {', '.join(parts)} {select}"
