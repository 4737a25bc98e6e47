"""Scans and sinks: the given tables written in a format, read back and compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.catalog import tables as shared
from wattlake.catalog.registry import query
from wattlake.catalog.sql import RUN, iso, with_ctes
from wattlake.functions.numbers import to_double
from wattlake.functions.times import at, iso_text, parse_iso
from wattlake.operators.quality import row_counts
from wattlake.session import new_folder
from wattlake.sources import bindings, rejects, readers, registry, sinks

CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("src_01_csv_scan", CUSTOMER)
def csv_scan(spark, sf_dir):
    """CSV comes in as text; the numbers are coerced by the reader of the columns."""
    folder = new_folder(spark, "src-01")
    bindings.table(spark, sf_dir, "customer").write.option("header", True).csv(f"{folder}/customer.csv")
    text = readers.read_dataset(spark, f"{folder}/customer.csv")
    return text.select(
        F.col("c_custkey").try_cast("bigint").alias("c_custkey"), "c_name",
        F.col("c_nationkey").try_cast("int").alias("c_nationkey"), to_double(F.col("c_acctbal")).alias("c_acctbal"), "c_mktsegment")


@query("src_01_csv_quoted_text", "SELECT doc_id, md5(text) AS text_md5 FROM documents")
def csv_quoted_text(spark, sf_dir):
    """Texts with line ends, quotes and separators survive quoted CSV."""
    folder = new_folder(spark, "src-01q")
    rows = bindings.table(spark, sf_dir, "documents").select("doc_id", "text")
    rows.write.options(header=True, escape='"', quoteAll=True).csv(f"{folder}/documents.csv")
    back = readers.read_dataset(spark, f"{folder}/documents.csv", "csv", "doc_id bigint, text string", quoted_lines=True)
    return back.select("doc_id", F.md5("text").alias("text_md5"))


@query("src_02_json_scan", CUSTOMER)
def json_scan(spark, sf_dir):
    folder = new_folder(spark, "src-02")
    bindings.table(spark, sf_dir, "customer").write.json(f"{folder}/customer.json")
    return readers.read_dataset(spark, f"{folder}/customer.json", "json", CUSTOMER_SCHEMA, json_lines=True)


@query("src_03_parquet_scan", "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE l_quantity > 45")
def parquet_scan(spark, sf_dir):
    lines = readers.read_dataset(spark, f"{sf_dir}/lineitem.parquet")
    return lines.filter(F.col("l_quantity") > 45).select("l_orderkey", "l_linenumber", "l_shipdate")


@query("src_04_payload_object", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def payload_object(spark, sf_dir):
    return readers.payload_rows(bindings.table(spark, sf_dir, "events"), "props", "k bigint", keep=("event_id",))


@query("src_04_payload_array", """
    SELECT l_orderkey, l_linenumber, unnest(['quantity', 'tax']) AS name, unnest([l_quantity, l_tax]) AS value FROM lineitem""")
def payload_array(spark, sf_dir):
    """A nested payload per line item with one element per measure."""
    item = lambda name, c: F.struct(F.lit(name).alias("name"), F.col(c).alias("value"))
    items = F.array(item("quantity", "l_quantity"), item("tax", "l_tax"))
    body = F.to_json(F.struct(F.struct(items.alias("items")).alias("data")))
    payloads = bindings.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", body.alias("payload"))
    return readers.payload_rows(payloads, "payload", "name string, value double", "data.items", keep=("l_orderkey", "l_linenumber"))


@query("src_05_json_path", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_path(spark, sf_dir):
    return bindings.table(spark, sf_dir, "events").select("event_id", readers.json_path(F.col("props"), "k").alias("k"))


@query("src_06_directory", "SELECT s_suppkey, s_name FROM supplier")
def directory(spark, sf_dir):
    """CSV files at several depths."""
    folder = new_folder(spark, "src-06")
    supplier = bindings.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    for depth, part in (("top", F.col("s_nationkey") < 10), ("a/b/deep", F.col("s_nationkey") >= 10)):
        supplier.filter(part).write.option("header", True).csv(f"{folder}/{depth}")
    back = readers.read_directory(spark, folder, "csv")
    return back.select(F.col("s_suppkey").cast("bigint").alias("s_suppkey"), "s_name")


@query("src_06_first_file", "SELECT s_suppkey, s_name FROM supplier")
def first_file(spark, sf_dir):
    """Of two files the one whose path sorts first."""
    folder = new_folder(spark, "src-06f")
    supplier = bindings.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    first = supplier.repartitionByRange(1, "s_suppkey")  # one file is what such a feed ships
    first.write.option("header", True).csv(f"{folder}/a")
    supplier.select((F.col("s_suppkey") + 1).alias("s_suppkey"), "s_name").write.option("header", True).csv(f"{folder}/b")
    files = readers.read_directory(spark, folder, "csv")
    back = readers.first_file_of(files, lambda path: readers.read_dataset(spark, path, "csv"))
    return back.select(F.col("s_suppkey").cast("bigint").alias("s_suppkey"), "s_name")


@query("src_07_latest_snapshot", with_ctes(
    """SELECT plant_id, source_name, ingested_at, o_orderkey FROM readings
       QUALIFY ingested_at = max(ingested_at) OVER (PARTITION BY source_name)""", "readings"))
def latest_snapshot(spark, sf_dir):
    rows = bindings.readings(spark, sf_dir).select("plant_id", "source_name", "ingested_at", "o_orderkey")
    return readers.latest_snapshot(rows)


@query("src_08_mixed_formats", "SELECT c_custkey, c_name FROM customer")
def mixed_formats(spark, sf_dir):
    folder = new_folder(spark, "src-08")
    customer = bindings.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_name", "c_nationkey")
    customer.filter("c_nationkey < 12").write.parquet(f"{folder}/p")
    customer.filter("c_nationkey >= 12").select("c_name", "c_custkey").write.option("header", True).csv(f"{folder}/c")
    return readers.read_mixed(spark, folder).select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name")


@query("src_08_one_format", "SELECT s_suppkey, s_name FROM supplier")
def one_format(spark, sf_dir):
    """A folder that holds one of the formats only."""
    folder = new_folder(spark, "src-08-one")
    supplier = bindings.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("s_suppkey"), "s_name")
    supplier.write.option("header", True).csv(folder)
    return readers.read_mixed(spark, folder).select(F.col("s_suppkey").cast("bigint").alias("s_suppkey"), "s_name")


@query("src_09_registry", with_ctes("SELECT source_name, s_suppkey FROM source_registry WHERE enabled IS NOT false", "source_registry"))
def source_registry(spark, sf_dir):
    """A registry file with one source per supplier."""
    folder = new_folder(spark, "src-09")
    listed = bindings.ingest_registry(spark, sf_dir)
    listed.select("source_name", "enabled", F.col("s_suppkey").cast("string").alias("path")).write.json(f"{folder}/sources.json")
    on = readers.enabled_sources(registry.read_registry(spark, f"{folder}/sources.json"))
    return on.select("source_name", F.col("path").cast("bigint").alias("s_suppkey"))


@query("src_10_external_tables", """
    SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def external_tables(spark, sf_dir):
    readers.register_tables(spark, {
        "ext_customer": (f"{sf_dir}/customer.parquet", "c_custkey bigint, c_nationkey int"),
        "ext_nation": (f"{sf_dir}/nation.parquet", "n_nationkey int, n_name string"),
    })
    return spark.sql(
        "SELECT n_name, count(*) AS customers FROM ext_customer JOIN ext_nation ON c_nationkey = n_nationkey GROUP BY n_name")


@query("src_11_report_csv", with_ctes("SELECT ts AS metric_timestamp, metric_name, metric_value FROM metrics_log", "metrics_log"))
def report_csv(spark, sf_dir):
    """The metrics log as CSV without a header, every value quoted."""
    folder = new_folder(spark, "src-11")
    bindings.metrics_log(spark, sf_dir).write.option("quoteAll", True).csv(f"{folder}/metrics")
    back = readers.read_report_csv(spark, f"{folder}/metrics", ["metric_timestamp", "metric_name", "metric_value"], header=False)
    return back.select(parse_iso(F.col("metric_timestamp")).alias("metric_timestamp"), "metric_name",
                       to_double(F.col("metric_value")).alias("metric_value"))


@query("src_12_tolerant_read", "SELECT 'there' AS report, count(*) AS row_count FROM orders UNION ALL SELECT 'not there', 0")
def tolerant_read(spark, sf_dir):
    schema = "o_orderkey bigint"
    return row_counts({
        "there": readers.read_or_empty(spark, f"{sf_dir}/orders.parquet", schema),
        "not there": readers.read_or_empty(spark, f"{sf_dir}/no_such_report.parquet", schema),
    }).withColumnRenamed("view_name", "report")


@query("src_12_bad_file", "SELECT s_suppkey FROM supplier")
def bad_file(spark, sf_dir):
    """A folder of good Parquet files with one among them that is none."""
    folder = new_folder(spark, "src-12")
    supplier = bindings.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("bigint").alias("s_suppkey"))
    supplier.write.parquet(f"{folder}/part=1")
    supplier.select(F.col("s_suppkey").cast("string").alias("value")).write.text(f"{folder}/part=2")
    return readers.read_or_empty(spark, folder, "s_suppkey bigint", pathGlobFilter="part-*").select("s_suppkey")


# --- sinks ------------------------------------------------------------------------------


@query("snk_01_partitioned_append", """
    SELECT o_orderkey, o_orderpriority AS source_name, CAST(year(o_orderdate) AS INTEGER) AS ingest_year,
           1 AS ingest_month FROM orders""")
def partitioned_append(spark, sf_dir):
    """Orders as bronze batches of their priority and year."""
    folder = new_folder(spark, "snk-01")
    orders = bindings.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("source_name"),
        F.date_trunc("year", "o_orderdate").cast("timestamp_ntz").alias("ingested_at"))
    sinks.append_bronze(orders, folder)
    back = spark.read.parquet(folder)
    return back.select("o_orderkey", "source_name", F.col("ingest_year").cast("int").alias("ingest_year"),
                       F.col("ingest_month").cast("int").alias("ingest_month"))


@query("snk_02_replace_table", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def replace_table(spark, sf_dir):
    """A table rewritten from itself."""
    table = sinks.VersionedTable(spark, new_folder(spark, "snk-02"))
    first = table.replace(bindings.table(spark, sf_dir, "orders"))
    table.replace(first.filter(F.col("o_orderstatus") != "P").select("o_orderkey", "o_totalprice"))
    return table.read()


@query("snk_03_quarantine", with_ctes(
    """SELECT plant_id, 'run-1' AS run_id FROM batch WHERE NOT coalesce(capacity_mw BETWEEN 0.0001 AND 1000000, false)
       UNION ALL SELECT plant_id, 'run-2' FROM batch WHERE country IS NULL""", "batch"))
def quarantine_sink(spark, sf_dir):
    folder = new_folder(spark, "snk-03")
    rows = shared.batch(spark, sf_dir)
    bad = ~F.coalesce(F.col("capacity_mw").between(0.0001, 1000000), F.lit(False))
    sinks.append_quarantine(rows.filter(bad), folder, "run-1")
    sinks.append_quarantine(rows.filter(F.col("country").isNull()), folder, "run-2")
    return spark.read.parquet(folder).select("plant_id", "run_id")


@query("snk_03_repeated_run", with_ctes(
    "SELECT plant_id, 'run-1' AS run_id FROM batch WHERE country IS NULL", "batch"))
def repeated_run(spark, sf_dir):
    """A run repeated after a failure replaces what it had written."""
    folder = new_folder(spark, "snk-03r")
    rows = shared.batch(spark, sf_dir)
    sinks.append_quarantine(rows.filter(F.col("capacity_mw") < 0), folder, "run-1")
    sinks.append_quarantine(rows.filter(F.col("country").isNull()), folder, "run-1")
    return spark.read.parquet(folder).select("plant_id", "run_id")


@query("snk_06_repeated_run", f"""
    SELECT {RUN} AS metric_timestamp, 'gold_orders' AS metric_name, CAST(count(*) AS DOUBLE) AS metric_value FROM orders""")
def repeated_metrics(spark, sf_dir):
    folder = new_folder(spark, "snk-06r")
    of = bindings.table(spark, sf_dir, "orders").agg(F.count("*").alias("v"))
    for _ in range(2):
        sinks.append_metrics(sinks.metric_rows(spark, {"gold_orders": F.col("v")}, at(bindings.AS_OF), of=of), folder, "run-1")
    return spark.read.parquet(folder).drop("run")


@query("snk_04_csv_report", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, '[' || c_nationkey || ']' AS nations FROM customer")
def csv_report(spark, sf_dir):
    folder = new_folder(spark, "snk-04")
    customer = bindings.table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.array("c_nationkey").alias("nations"))
    sinks.write_report(customer, folder, "2001-01-01 00:00:00")
    return readers.read_dataset(spark, folder, "csv").drop("run")


@query("snk_05_json_document", "SELECT c_name, c_nationkey FROM customer")
def json_document(spark, sf_dir):
    folder = new_folder(spark, "snk-05")
    customer = bindings.table(spark, sf_dir, "customer").select(F.struct("c_name", F.struct("c_nationkey").alias("in")).alias("doc"))
    sinks.write_document(customer, folder)
    back = spark.read.schema("doc struct<c_name:string,in:struct<c_nationkey:int>>").json(folder)
    return back.select("doc.c_name", "doc.in.c_nationkey")


@query("snk_06_append_metrics", f"""
    SELECT {RUN} AS metric_timestamp, 'gold_orders' AS metric_name, CAST(count(*) AS DOUBLE) AS metric_value FROM orders
    UNION ALL SELECT {RUN}, 'silver_newest_year', max(year(o_orderdate)) FROM orders""")
def append_metrics(spark, sf_dir):
    folder = new_folder(spark, "snk-06")
    values = {"gold_orders": F.count("*"), "silver_newest_year": F.max(F.year("o_orderdate"))}
    for name, value in values.items():
        of = bindings.table(spark, sf_dir, "orders").agg(value.alias("v"))
        sinks.append_metrics(sinks.metric_rows(spark, {name: F.col("v")}, at(bindings.AS_OF), of=of), folder, name)
    return spark.read.parquet(folder).drop("run")


@query("snk_07_state_merge", with_ctes(
    f"""SELECT source_name, CASE WHEN enabled IS NOT false AND o.rows IS NOT NULL THEN {iso('last_ingested_at')} ELSE 'old' END
               AS last_ingested_at, status AS last_status
        FROM source_registry LEFT JOIN source_state USING (source_name) LEFT JOIN source_outcomes o USING (source_name)""",
    "source_registry", "source_state", "source_outcomes"))
def state_merge(spark, sf_dir):
    """New times for the enabled sources only; the others keep the old one."""
    listed = bindings.ingest_registry(spark, sf_dir)
    outcomes = bindings.source_outcomes(spark, sf_dir).select("source_name", F.col("status").alias("last_status"))
    old = listed.select("source_name", F.lit("old").alias("last_ingested_at")).join(outcomes, "source_name", "left")
    on = readers.enabled_sources(listed).select("source_name")
    new = bindings.source_state(spark, sf_dir).join(on, "source_name", "left_semi").select(
        "source_name", iso_text(F.col("last_ingested_at")).alias("last_ingested_at"))
    return sinks.merge_state(old, new)


@query("snk_08_views", with_ctes("SELECT country, count(*) AS plants FROM dim_plant GROUP BY 1", "dim_plant"))
def views(spark, sf_dir):
    t = shared.tables(spark, sf_dir)
    readers.register_views({"view_dim_plant": t["dim_plant"]})
    return spark.sql("SELECT country, count(*) AS plants FROM view_dim_plant GROUP BY country")


@query("src_12_rejects", """
    SELECT o_orderkey, o_totalprice, NULL::VARCHAR AS reason, NULL::VARCHAR AS record FROM orders WHERE o_orderkey % 10 <> 0
    UNION ALL SELECT NULL, NULL, 'malformed record', '{"o_orderkey":' || o_orderkey || ',"o_totalprice":oops' FROM orders
    WHERE o_orderkey % 10 = 0""")
def kept_rejects(spark, sf_dir):
    """Orders as lines of JSON, every tenth broken: the rows, and the broken lines with the reason."""
    folder = new_folder(spark, "src-12")
    orders = bindings.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    broken = F.concat(F.lit('{"o_orderkey":'), F.col("o_orderkey").cast("string"), F.lit(',"o_totalprice":oops'))
    line = F.when(F.col("o_orderkey") % 10 == 0, broken).otherwise(F.to_json(F.struct("o_orderkey", "o_totalprice")))
    orders.select(line.alias("value")).write.text(folder)
    rows, bad = rejects.read_with_rejects(spark, folder, orders.schema, "json")
    return rows.unionByName(bad.drop("path"), allowMissingColumns=True)
