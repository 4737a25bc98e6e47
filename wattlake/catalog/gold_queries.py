"""Dimensions, facts, KPIs, governance and chart data."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.catalog import tables as shared
from wattlake.catalog.registry import query
from wattlake.catalog.sql import RUN, mean, ratio, total, with_ctes
from wattlake.operators import gold
from wattlake.operators.upsert import upsert
from wattlake.plans.incremental import GoldSums
from wattlake.session import new_folder
from wattlake.sources import bindings
from wattlake.sources.sinks import KeyedTable


def _layer(table: str, name: str) -> None:
    @query(name, with_ctes(f"SELECT * FROM {table}", table))
    def run(spark, sf_dir):
        return shared.tables(spark, sf_dir)[table].select("*")  # a plan of its own for every run


_layer("dim_plant", "gld_01_dim_plant")
_layer("dim_country", "gld_02_dim_country")
_layer("dim_fuel_type", "gld_03_dim_fuel_type")
_layer("fact_plant_capacity", "gld_05_fact_plant_capacity")
_layer("fact_power_generation", "gld_06_fact_power_generation")
_layer("fact_power_generation_time", "gld_07_fact_power_generation_time")
_layer("fact_capacity_geo", "gld_08_fact_capacity_geo")


def _changing_silver(spark, sf_dir) -> GoldSums:
    """Silver in four changes: half of the plants with other values, the rest, the right values, and a plant that goes."""
    silver = shared.tables(spark, sf_dir)["stg_power_plants"]
    folder = new_folder(spark, "gold-sums")
    silver.write.parquet(f"{folder}/plants")
    silver = spark.read.parquet(f"{folder}/plants")
    table = KeyedTable(spark, f"{folder}/silver", "plant_id", 16)
    sums = GoldSums(spark, table, f"{folder}/sums", 4)
    half = F.pmod(F.xxhash64("plant_id"), F.lit(2)) == 0
    wrong = silver.filter(half).withColumns({"country": F.lit("Nowhere"), "capacity_mw": F.col("capacity_mw") * 3})
    extra = silver.limit(1).withColumns({"plant_id": F.lit("to go"), "country": F.lit("Gone")})
    for batch in (wrong, silver.filter(~half).unionByName(extra), silver.filter(half)):
        table.change_keys(batch, lambda now, batch=batch: upsert(None if now is None else now.join(batch, "plant_id", "left_anti"), batch))
        sums.refresh()
    table.change_keys(extra, lambda now: now.filter("plant_id <> 'to go'"))
    return sums


@query("gld_05_incremental_capacity", with_ctes("SELECT * FROM fact_plant_capacity", "fact_plant_capacity"))
def incremental_capacity(spark, sf_dir):
    """From the sums of silver buckets after four changes, of which each is taken in alone."""
    return gold.fact_plant_capacity(_changing_silver(spark, sf_dir).refresh())


@query("gld_06_incremental_generation", with_ctes("SELECT * FROM fact_power_generation", "fact_power_generation"))
def incremental_generation(spark, sf_dir):
    return gold.fact_power_generation(_changing_silver(spark, sf_dir).refresh())


@query("gld_04_dim_time", """
    SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
           strftime(d, '%Y-%m-%d') AS date FROM (SELECT max(o_orderdate) AS d FROM orders)""")
def dim_time(spark, sf_dir):
    """The run date is the day of the newest order."""
    newest = bindings.table(spark, sf_dir, "orders").select(F.max("o_orderdate")).scalar()
    return gold.dim_time(spark, newest)


@query("gld_04_calendar", """
    SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
           strftime(d, '%Y-%m-%d') AS date
    FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)""")
def calendar(spark, sf_dir):
    return gold.calendar(bindings.table(spark, sf_dir, "orders"), "o_orderdate")


@query("gld_09_missing_inputs", with_ctes(
    """SELECT 'fact_power_generation' AS fact, 0::BIGINT AS row_count UNION ALL SELECT 'fact_power_generation_time', 0
       UNION ALL SELECT 'fact_capacity_geo', 0 UNION ALL SELECT 'fact_plant_capacity', count(*) FROM fact_plant_capacity""",
    "fact_plant_capacity"))
def missing_inputs(spark, sf_dir):
    """Without generation and region columns three facts are empty and the fourth is whole."""
    from wattlake.operators.quality import row_counts

    silver = shared.tables(spark, sf_dir)["stg_power_plants"].drop("estimated_generation_gwh", "continent", "sub_region")
    builders = (gold.fact_power_generation, gold.fact_power_generation_time, gold.fact_capacity_geo, gold.fact_plant_capacity)
    counts = row_counts({b.__name__: b(silver) for b in builders})
    return counts.withColumnRenamed("view_name", "fact")


@query("gld_05_small_values", """
    SELECT l_returnflag AS country, l_linestatus AS primary_fuel,
           CAST(printf('%.8e', sum(l_tax * 1e-7::DOUBLE) * (1 + 3e-12::DOUBLE)) AS DOUBLE) AS total_capacity_mw
    FROM lineitem GROUP BY ALL""")
def small_values(spark, sf_dir):
    """Capacities below a millionth still add up."""
    tiny = bindings.table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("country"), F.col("l_linestatus").alias("primary_fuel"), (F.col("l_tax") * 1e-7).alias("capacity_mw"))
    facts = gold.fact_plant_capacity(tiny).select("country", "primary_fuel", "total_capacity_mw")
    return facts.withColumn("total_capacity_mw", F.format_string("%.8e", F.col("total_capacity_mw") * (1 + 3e-12)).cast("double"))


@query("gld_10_kpi_report", with_ctes(
    f"""SELECT {RUN} AS generated_at, mw AS total_generation_capacity_mw, {ratio('clean', 'mw')} AS renewable_energy_ratio,
               (SELECT coalesce({mean('capacity_mw')}, 0.0::DOUBLE) FROM dim_plant) AS average_plant_capacity_mw,
               (SELECT count(*) FROM (SELECT DISTINCT country, primary_fuel FROM fact_power_generation))
                 AS country_wise_fuel_distribution_rows,
               (SELECT count(*) FROM (SELECT DISTINCT year FROM fact_power_generation)) AS annual_generation_trends_rows
        FROM (SELECT {total('total_capacity_mw')} AS mw, {total('renewable_capacity_mw')} AS clean FROM fact_plant_capacity)""",
    "fact_plant_capacity", "fact_power_generation", "dim_plant"))
def kpi_report(spark, sf_dir):
    t = shared.tables(spark, sf_dir)
    return gold.kpi_report(t["fact_plant_capacity"], t["dim_plant"], t["fact_power_generation"], shared.as_of())


@query("gld_11_country_fuel_distribution", with_ctes(
    f"""SELECT country, primary_fuel, {total('total_generation_gwh')} AS total_generation_gwh
        FROM fact_power_generation GROUP BY ALL ORDER BY 1, 2""", "fact_power_generation"))
def country_fuel_distribution(spark, sf_dir):
    return gold.country_fuel_distribution(shared.tables(spark, sf_dir)["fact_power_generation"])


YEARLY = with_ctes(
    f"""SELECT year, {total('total_generation_gwh')} AS total_generation_gwh FROM fact_power_generation
        GROUP BY 1 ORDER BY 1""", "fact_power_generation")


@query("gld_12_annual_generation_trends", YEARLY)
def annual_generation_trends(spark, sf_dir):
    return gold.annual_generation_trends(shared.tables(spark, sf_dir)["fact_power_generation"])


LINEAGE_NODES = {
    "bronze.plants": ("plants_raw", None),
    "silver.stg_power_plants": ("silver", "stg_power_plants"),
    **{f"gold.{t}": (t, t) for t in ("dim_plant", "dim_country", "dim_fuel_type", "fact_plant_capacity",
                                     "fact_power_generation", "fact_power_generation_time", "fact_capacity_geo")},
}
_SIZES = " UNION ALL ".join(f"SELECT '{n}' AS dataset, count(*) AS n FROM {t}" for n, (t, _) in LINEAGE_NODES.items())
_EDGES = ", ".join("('{}', '{}', '{}')".format(*edge) for edge in gold.LINEAGE)


@query("gld_13_lineage", with_ctes(
    """SELECT f AS from_dataset, t AS to_dataset, x AS transformation, a.n AS from_rows, b.n AS to_rows
       FROM edges LEFT JOIN sizes a ON a.dataset = f LEFT JOIN sizes b ON b.dataset = t""",
    *[t for t, _ in LINEAGE_NODES.values()], sizes=f"{_SIZES} UNION ALL SELECT 'gold.dim_time', 1",
    edges=f"SELECT * FROM (VALUES {_EDGES}) AS e(f, t, x)"))
def lineage(spark, sf_dir):
    t = shared.tables(spark, sf_dir)
    frames = {n: t[name] for n, (_, name) in LINEAGE_NODES.items() if name}
    return gold.lineage(frames | {"bronze.plants": bindings.plants_raw(spark, sf_dir), "gold.dim_time": t["dim_time"]})


_REPORTED = (
    ("capacity_aggregation", "fact_plant_capacity", "country,primary_fuel"),
    ("time_based_aggregation", "fact_power_generation_time", "event_year,event_month"),
    ("geo_based_aggregation", "fact_capacity_geo", "continent,sub_region"),
)


@query("gld_14_aggregation_report", with_ctes(" UNION ALL ".join(
    f"""SELECT '{n}' AS aggregation, true AS applied, count(*) AS output_rows, 'silver.stg_power_plants' AS source,
               '{k}' AS group_by FROM {t}""" for n, t, k in _REPORTED), *[t for _, t, _ in _REPORTED]))
def aggregation_report(spark, sf_dir):
    t = shared.tables(spark, sf_dir)
    report = gold.aggregation_report(*[t[name] for _, name, _ in _REPORTED])
    return report.withColumn("group_by", F.array_join("group_by", ","))


@query("gld_15_staging_model", with_ctes(
    """SELECT plant_id, plant_name, country, capacity_mw, primary_fuel, commissioning_year, latitude, longitude,
              substr(owner, 1, 3) || '***' AS owner_masked, event_year, event_month FROM silver""", "silver"))
def staging_model(spark, sf_dir):
    return gold.staging_model(shared.tables(spark, sf_dir)["stg_power_plants"])


@query("gld_15_capacity_model", with_ctes("SELECT * FROM fact_plant_capacity", "fact_plant_capacity"))
def capacity_model(spark, sf_dir):
    return gold.capacity_model(shared.tables(spark, sf_dir)["fact_plant_capacity"])


@query("gld_15_generation_model", with_ctes("SELECT * FROM fact_power_generation", "fact_power_generation"))
def generation_model(spark, sf_dir):
    return gold.generation_model(shared.tables(spark, sf_dir)["fact_power_generation"])


def _top(by: str) -> str:
    return with_ctes(
        f"""SELECT {by}, {total('total_capacity_mw')} AS total_capacity_mw FROM fact_plant_capacity GROUP BY 1
            ORDER BY 2 DESC, 1 NULLS LAST LIMIT 10""", "fact_plant_capacity")


@query("viz_01_top_countries", _top("country"))
def top_countries(spark, sf_dir):
    return gold.top_capacity(shared.tables(spark, sf_dir)["fact_plant_capacity"], "country")


@query("viz_02_top_fuels", _top("primary_fuel"))
def top_fuels(spark, sf_dir):
    return gold.top_capacity(shared.tables(spark, sf_dir)["fact_plant_capacity"], "primary_fuel")


@query("viz_03_generation_trend", YEARLY)
def generation_trend(spark, sf_dir):
    return gold.generation_trend(shared.tables(spark, sf_dir)["fact_power_generation"])


@query("viz_04_manifest", with_ctes(
    """SELECT string_agg(c, ',' ORDER BY c) AS visualizations, count(*) AS count FROM (
         SELECT 'capacity_by_country' AS c FROM fact_plant_capacity HAVING count(*) > 0
         UNION ALL SELECT 'fuel_mix_capacity' FROM fact_plant_capacity HAVING count(*) > 0
         UNION ALL SELECT 'generation_trend' FROM fact_power_generation HAVING count(*) > 0)""",
    "fact_plant_capacity", "fact_power_generation"))
def manifest(spark, sf_dir):
    t = shared.tables(spark, sf_dir)
    return gold.chart_manifest({
        "capacity_by_country": gold.top_capacity(t["fact_plant_capacity"], "country"),
        "fuel_mix_capacity": gold.top_capacity(t["fact_plant_capacity"], "primary_fuel"),
        "generation_trend": gold.generation_trend(t["fact_power_generation"]),
    })
