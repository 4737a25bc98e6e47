"""Projections, conforming and de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.catalog import tables as shared
from wattlake.catalog.registry import query
from wattlake.catalog.sql import (
    _CONTINENTS,
    _SUB_REGIONS,
    COUNTRY_ALIASES,
    FUEL_ALIASES,
    RENEWABLE_FUELS,
    RUN,
    canonical,
    case_of,
    clean,
    no_placeholder,
    quoted,
    strip,
    title,
    with_ctes,
)
from wattlake.functions.hashing import owner_mask, owner_prefix_mask
from wattlake.functions.text import clean_text, title_case
from wattlake.operators import conform, upsert
from wattlake.plans.medallion import conformed_batch
from wattlake.session import new_folder
from wattlake.sources import bindings
from wattlake.sources.sinks import KeyedTable


@query("cnf_01_column_names", "SELECT o_orderkey AS order_key, o_orderstatus AS order_status, o_totalprice AS total_price_usd FROM orders")
def column_names(spark, sf_dir):
    raw = bindings.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(" Order Key "), F.col("o_orderstatus").alias("order--STATUS"),
        F.col("o_totalprice").alias("Total.Price (USD)"))
    return conform.conform_names(raw)


@query("cnf_02_trim_text", with_ctes(
    f"""SELECT plant_id, nullif({strip('plant_name')}, '') AS plant_name, nullif({strip('country')}, '') AS country,
               nullif({strip('primary_fuel')}, '') AS primary_fuel, nullif({strip('owner')}, '') AS owner
        FROM plants_raw""", "plants_raw"))
def trim_text(spark, sf_dir):
    raw = bindings.plants_raw(spark, sf_dir).select("plant_id", "plant_name", "country", "primary_fuel", "owner")
    return conform.trim_text(raw)


@query("cnf_03_numbers", """
    SELECT l_orderkey, TRY_CAST(CASE WHEN l_linenumber = 1 THEN 'n/a' ELSE l_quantity::VARCHAR END AS DOUBLE) AS capacity_mw,
           CAST(l_extendedprice AS DOUBLE) AS estimated_generation_gwh_2017 FROM lineitem""")
def numbers(spark, sf_dir):
    raw = bindings.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_linenumber") == 1, "n/a").otherwise(F.col("l_quantity").cast("string")).alias("capacity_mw"),
        F.col("l_extendedprice").cast("string").alias("estimated_generation_gwh_2017"))
    return conform.coerce_numbers(raw)


@query("cnf_04_union_by_name", """
    SELECT s_name AS name, s_acctbal AS balance, NULL::VARCHAR AS segment FROM supplier
    UNION ALL SELECT c_name, c_acctbal, c_mktsegment FROM customer""")
def union_by_name(spark, sf_dir):
    supplier = bindings.table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    customer = bindings.table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"), F.col("c_name").alias("name"))
    return conform.union_by_name([supplier, customer])


@query("cnf_05_canonical_aliases", """
    SELECT CAST(p_partkey AS VARCHAR) AS gppd_idnr, p_name AS name, CAST(p_partkey AS VARCHAR) AS plant_id,
           p_name AS plant_name FROM part""")
def canonical_aliases(spark, sf_dir):
    raw = bindings.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("gppd_idnr"), F.col("p_name").alias("name"))
    return conform.canonical_columns(raw)


@query("cnf_05_mixed_feeds", """
    SELECT CAST(s_suppkey AS VARCHAR) AS plant_id, s_name AS plant_name, s_acctbal AS capacity_mw FROM supplier
    UNION ALL SELECT 'C' || c_custkey, c_name, c_acctbal FROM customer""")
def mixed_feeds(spark, sf_dir):
    """Two feeds that name their columns differently, in one batch."""
    fixed = {"country": "India", "primary_fuel": "Wind", "commissioning_year": "2001", "latitude": "1", "longitude": "2"}
    common = [F.lit(v).alias(k) for k, v in fixed.items()]
    public = bindings.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("gppd_idnr"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("capacity_mw"), *common)
    own = bindings.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("Plant ID"), F.col("c_name").alias("plant_name"),
        F.col("c_acctbal").alias("capacity_mw"), *common)
    return conformed_batch(public, own).select("plant_id", "plant_name", "capacity_mw")


@query("cnf_06_country_from_code", """
    SELECT c_custkey, CASE WHEN c_nationkey < 10 THEN n_name ELSE 'N ' || c_nationkey END AS country, n_name AS country_long
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def country_from_code(spark, sf_dir):
    nation = bindings.table(spark, sf_dir, "nation")
    rows = bindings.table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    raw = rows.select("c_custkey", F.concat(F.lit("N "), F.col("c_nationkey").cast("string")).alias("country"),
                      F.col("n_name").alias("country_long"))
    return conform.canonical_columns(raw)


@query("cnf_07_latest_yearly", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           coalesce(CASE WHEN l_returnflag = 'A' THEN l_tax END, CASE WHEN l_linestatus = 'O' THEN l_discount END,
                    l_quantity) AS estimated_generation_gwh FROM lineitem""")
def latest_yearly(spark, sf_dir):
    raw = bindings.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").alias("estimated_generation_gwh_2013"),
        F.when(F.col("l_returnflag") == "A", F.col("l_tax")).alias("estimated_generation_gwh_2017"),
        F.when(F.col("l_linestatus") == "O", F.col("l_discount")).alias("estimated_generation_gwh_2014"))
    return conform.canonical_columns(raw).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "estimated_generation_gwh")


@query("cnf_08_placeholders", with_ctes(
    f"""SELECT plant_id, {no_placeholder('plant_name')} AS plant_name, {no_placeholder('country')} AS country,
               {no_placeholder('primary_fuel')} AS primary_fuel FROM plants_raw""", "plants_raw"))
def placeholders(spark, sf_dir):
    raw = bindings.plants_raw(spark, sf_dir).select("plant_id", "plant_name", "country", "primary_fuel")
    return conform.null_placeholders(raw)


@query("cnf_09_units", """
    SELECT l_orderkey, l_linenumber, l_partkey,
           coalesce(CASE l_returnflag WHEN 'A' THEN l_extendedprice / 1000 WHEN 'R' THEN l_extendedprice * 1000 END,
                    l_quantity / 1000, l_tax * 1000) AS capacity_mw FROM lineitem""")
def units(spark, sf_dir):
    raw = bindings.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice")).alias("capacity_mw"),
        F.when(F.col("l_returnflag") == "A", " kW").when(F.col("l_returnflag") == "R", "GW ").alias("capacity_unit"),
        F.col("l_quantity").alias("capacity_kw"), F.col("l_tax").alias("capacity_gw"))
    return conform.standardise_units(raw).select("l_orderkey", "l_linenumber", "l_partkey", "capacity_mw")


@query("cnf_10_country", with_ctes(
    f"SELECT plant_id, {canonical('country', COUNTRY_ALIASES)} AS country FROM plants_raw", "plants_raw"))
def country(spark, sf_dir):
    return bindings.plants_raw(spark, sf_dir).select("plant_id", conform.canonical_country(F.col("country")).alias("country"))


@query("cnf_11_fuel", with_ctes(
    f"SELECT plant_id, {canonical('primary_fuel', FUEL_ALIASES)} AS primary_fuel FROM plants_raw", "plants_raw"))
def fuel(spark, sf_dir):
    return bindings.plants_raw(spark, sf_dir).select("plant_id", conform.canonical_fuel(F.col("primary_fuel")).alias("primary_fuel"))


@query("cnf_12_text_clean", f"SELECT doc_id, {clean('text')} AS cleaned FROM documents")
def text_clean(spark, sf_dir):
    return bindings.table(spark, sf_dir, "documents").select("doc_id", clean_text(F.col("text")).alias("cleaned"))


@query("cnf_12_text_title", f"SELECT doc_id, md5({title('text')}) AS title_md5 FROM documents")
def text_title(spark, sf_dir):
    return bindings.table(spark, sf_dir, "documents").select("doc_id", F.md5(title_case(F.col("text"))).alias("title_md5"))


@query("cnf_13_geography", with_ctes(
    f"""SELECT plant_id, {case_of('c', _CONTINENTS, "'Other'")} AS continent, {case_of('c', _SUB_REGIONS, "'Other'")} AS sub_region
        FROM (SELECT plant_id, {canonical('country', COUNTRY_ALIASES)} AS c FROM plants_raw)""", "plants_raw"))
def geography(spark, sf_dir):
    rows = bindings.plants_raw(spark, sf_dir).withColumn("country", conform.canonical_country(F.col("country")))
    return conform.enrich_geography(rows).select("plant_id", "continent", "sub_region")


@query("cnf_14_changed_counts", with_ctes(
    """SELECT count(*) FILTER (raw_country <> country) AS country_name_normalized_rows,
              count(*) FILTER (raw_fuel <> primary_fuel) AS fuel_type_standardized_rows FROM batch""", "batch"))
def changed_counts(spark, sf_dir):
    return conform.changed_by_normalising(shared.batch(spark, sf_dir))


@query("cnf_15_event_period", with_ctes(
    f"""SELECT plant_id, CAST(coalesce(year(event_time), year({RUN})) AS BIGINT) AS event_year,
               CAST(coalesce(month(event_time), 1) AS BIGINT) AS event_month FROM plants_raw""", "plants_raw"))
def event_period(spark, sf_dir):
    rows = bindings.plants_raw(spark, sf_dir)
    return conform.event_period(rows, shared.RUN_YEAR).select("plant_id", "event_year", "event_month")


@query("cnf_16_owner_mask", with_ctes(
    f"""SELECT plant_id, CASE WHEN {strip('owner')} <> '' THEN 'OWNER_' || substr(sha256({strip('owner')}), 1, 10)
                              ELSE 'UNKNOWN' END AS owner_masked FROM plants_raw""", "plants_raw"))
def masked_owner(spark, sf_dir):
    return bindings.plants_raw(spark, sf_dir).select("plant_id", owner_mask(F.col("owner")).alias("owner_masked"))


@query("cnf_17_owner_prefix", with_ctes(
    "SELECT plant_id, substr(owner, 1, 3) || '***' AS owner_masked FROM plants_raw", "plants_raw"))
def owner_prefix(spark, sf_dir):
    return bindings.plants_raw(spark, sf_dir).select("plant_id", owner_prefix_mask(F.col("owner")).alias("owner_masked"))


@query("cnf_18_renewable_flag", with_ctes(
    f"SELECT plant_id, coalesce(primary_fuel IN ({quoted(RENEWABLE_FUELS)}), false) AS is_renewable FROM batch", "batch"))
def renewable_flag(spark, sf_dir):
    return shared.batch(spark, sf_dir).select("plant_id", conform.is_renewable(F.col("primary_fuel")).alias("is_renewable"))


# --- latest record per key ----------------------------------------------------------

READING = "plant_id, estimated_generation_gwh, event_time, ingested_at, o_orderkey, capacity_mw"


def _readings(spark, sf_dir):
    return bindings.readings(spark, sf_dir).select(*READING.split(", "))


@query("ups_01_latest_per_key", with_ctes(
    f"""SELECT {READING} FROM readings
        QUALIFY row_number() OVER (PARTITION BY plant_id ORDER BY ingested_at DESC, o_orderkey DESC) = 1""", "readings"))
def latest_per_key(spark, sf_dir):
    return upsert.latest_per_key(_readings(spark, sf_dir), "plant_id", ["ingested_at", "o_orderkey"])


def _halves(spark, sf_dir):
    """Current table: latest delivered or pending readings; batch: latest failed readings, a few without a time."""
    rows = bindings.readings(spark, sf_dir).select(*READING.split(", "), "status")
    undated = rows.withColumn(
        "event_time", F.when(F.col("estimated_generation_gwh") >= 100, F.col("event_time")))
    pick = lambda df: upsert.latest_per_key(df.drop("status"), "plant_id", ["event_time", "o_orderkey"])
    return pick(rows.filter(F.col("status") != "F")), pick(undated.filter(F.col("status") == "F"))


HALVES = {
    "both_batches": """
        SELECT plant_id, estimated_generation_gwh, ingested_at, o_orderkey, capacity_mw, (status = 'F')::INT AS batch,
               CASE WHEN status <> 'F' OR estimated_generation_gwh >= 100 THEN event_time END AS event_time FROM readings""",
    "latest": """SELECT * FROM both_batches QUALIFY row_number() OVER (
                 PARTITION BY plant_id, batch ORDER BY event_time DESC NULLS LAST, o_orderkey DESC) = 1""",
}


def _upsert_sql(nulls: str) -> str:
    return with_ctes(
        f"""SELECT {READING} FROM latest QUALIFY row_number() OVER (
            PARTITION BY plant_id ORDER BY event_time DESC NULLS {nulls}, ingested_at DESC, batch DESC) = 1""",
        "readings", **HALVES)


@query("ups_02_upsert", _upsert_sql("LAST"))
def upsert_batch(spark, sf_dir):
    current, batch = _halves(spark, sf_dir)
    return upsert.upsert(current, batch)


@query("ups_02_bucketed_upsert", _upsert_sql("LAST"))
def bucketed_upsert(spark, sf_dir):
    """The same, into a table of which the batch writes only its buckets; the batch comes in two parts."""
    current, batch = _halves(spark, sf_dir)
    table = KeyedTable(spark, new_folder(spark, "ups-02"), "plant_id")
    table.replace(current)
    small = F.pmod(F.xxhash64("plant_id"), F.lit(100)) == 0
    for part in (batch.filter(small), batch.filter(~small)):
        table.change_keys(part, lambda now, part=part: upsert.upsert(now, part))
    return table.read()


@query("ups_02_upsert_nulls_win", _upsert_sql("FIRST"))
def upsert_nulls_win(spark, sf_dir):
    """A record without a time replaces any other, as in a sort that puts nulls last and keeps the last row."""
    current, batch = _halves(spark, sf_dir)
    return upsert.upsert(current, batch, nulls_win=True)


@query("ups_03_clean_current_table", with_ctes(
    f"""SELECT plant_id, {no_placeholder('country')} AS country, {no_placeholder('primary_fuel')} AS primary_fuel,
               CASE WHEN plant_id LIKE '%7' THEN capacity_mw + 1 ELSE capacity_mw END AS capacity_mw, event_time
        FROM plants_raw""", "plants_raw"))
def clean_current_table(spark, sf_dir):
    """Placeholders an old table still holds are gone after a merge, from rows in the batch and from all others."""
    old = bindings.plants_raw(spark, sf_dir).select("plant_id", "country", "primary_fuel", "capacity_mw", "event_time")
    new = conform.null_placeholders(old.filter(F.col("plant_id").endswith("7"))).withColumn("capacity_mw", F.col("capacity_mw") + 1)
    return upsert.upsert(old, new)


@query("ups_04_quarantine_union", with_ctes(
    """SELECT plant_id, capacity_mw, NULL::VARCHAR AS stale FROM batch WHERE NOT coalesce(capacity_mw BETWEEN 0.0001 AND 1000000, false)
       UNION ALL SELECT plant_id, NULL, 'year' FROM batch WHERE commissioning_year = 1700""", "batch"))
def quarantine_union(spark, sf_dir):
    rows = shared.batch(spark, sf_dir)
    first = rows.filter(~F.coalesce(F.col("capacity_mw").between(0.0001, 1000000), F.lit(False))).select("plant_id", "capacity_mw")
    second = rows.filter(F.col("commissioning_year") == 1700).select("plant_id", F.lit("year").alias("stale"))
    return upsert.add_to_quarantine(first, second)
