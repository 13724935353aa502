"""S (scans), K (sinks and gates), T (incremental loads).

Entries that need files write the test tables to a fresh folder under the session's scratch root.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F, types as T

from cadastra.catalog.registry import Tables, query
from cadastra.operators import quality, sets
from cadastra.operators.joins import Lookup, enrich
from cadastra.operators.names import rename_all
from cadastra.sources import gates, open_features, readers, writers
from cadastra.sources.inline import local_table
from cadastra.sources.staging import fresh_dir, stage
from cadastra.streaming import event_time, incremental

_ORDER_FIELDS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _iso(name: str):
    return F.col(name).cast("string").alias(name)


def _csv(t: Tables, df: DataFrame, label: str, sep: str = ",") -> str:
    path = fresh_dir(t.spark, label)
    writers.write_csv(df, path, sep)
    return path


# --- scans -----------------------------------------------------------------------------------


@query("s01_declared_csv", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority,
       1 AS has_source FROM orders""")
def _(t: Tables):
    path = _csv(t, t.orders, "s01")
    loaded = readers.read_declared_csv(t.spark, path, t.orders.schema)
    has_source = F.col("filename").endswith(".csv").cast("int").alias("has_source")
    return loaded.select(*[c for c in _ORDER_FIELDS if c != "o_orderdate"], _iso("o_orderdate"), has_source)


@query("s02_tolerant_csv", """
SELECT event_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS value,
       CAST(event_type = 'error' AS INTEGER) AS quarantined FROM events""")
def _(t):
    value = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    path = _csv(t, t.events.select("event_id", "event_type", value.alias("value")), "s02")
    loaded = readers.read_tolerant_csv(t.spark, path, T.StructType.fromDDL("event_id long, event_type string, value double"))
    bad = F.col(readers.CORRUPT).isNotNull().cast("int").alias("quarantined")
    return loaded.select("event_id", "event_type", "value", bad)


@query("s02_quarantine", """
SELECT event_id, event_id || ',error,n/a' AS line FROM events WHERE event_type = 'error'""")
def _(t):
    value = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    path = _csv(t, t.events.select("event_id", "event_type", value.alias("value")), "s02")
    loaded = readers.read_tolerant_csv(t.spark, path, T.StructType.fromDDL("event_id long, event_type string, value double"))
    _, bad = readers.split_tolerant(loaded)
    return bad.select("event_id", "line")


@query("s03_text_then_cast", """
SELECT o_orderkey, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, NULL::INTEGER AS o_orderstatus
FROM orders""")
def _(t):
    columns = ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus"]
    path = _csv(t, t.orders.select(*columns), "s03")
    loaded = readers.read_text_csv(t.spark, path, columns)
    typed = readers.cast_columns(loaded, {"o_orderkey": "bigint", "o_totalprice": "double", "o_orderdate": "date"})
    lenient = readers.cast_columns(typed, {"o_orderstatus": "int"}, strict=False)
    return lenient.select("o_orderkey", "o_totalprice", _iso("o_orderdate"), "o_orderstatus")


@query("s04_inferred_csv", "SELECT c_custkey::INTEGER AS c_custkey, c_acctbal, c_mktsegment FROM customer")
def _(t):
    path = _csv(t, t.customer, "s04", ";")
    return readers.read_inferred_csv(t.spark, path, ";", ["c_custkey", "c_acctbal", "c_mktsegment"])


@query("s05_path_key_scan", """
SELECT o_orderkey, left(o_orderpriority, 1) AS authority FROM orders WHERE left(o_orderpriority, 1) IN ('1', '3')""")
def _(t):
    path = fresh_dir(t.spark, "s05")
    keyed = t.orders.select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("la"))
    keyed.write.partitionBy("la").parquet(path)
    found = readers.read_by_path_key(t.spark.read.parquet, path, r"/la=([^/]+)/", ["1", "3"], "authority")
    return found.select("o_orderkey", "authority")


@query("s06_schema_from_metadata", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def _(t):
    path = _csv(t, t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority"), "s06")
    described = [("o_totalprice", "decimal", 2), ("o_orderkey", "integer", 1), ("o_orderpriority", "code list", 3)]
    meta = readers.inline_table(
        t.spark, [("orders.csv", *row) for row in described], "filename string, `column` string, datatype string, position int"
    )
    schema = readers.schema_from_metadata(meta, "orders.csv", position_col="position")
    return t.spark.read.schema(schema).option("header", True).csv(path)


@query("s07_parquet_scan", "SELECT p_partkey, p_name, p_size FROM part WHERE p_size > 25")
def _(t):
    return t.part.where(F.col("p_size") > 25).select("p_partkey", "p_name", "p_size")


@query("s08_feature_rows", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(user_id AS DOUBLE) AS x, value AS y FROM events""")
def _(t):
    shape = "features array<struct<attributes struct<ObjectId int, event_id long, k int>, geometry struct<x double, y double>>>"
    attributes = F.struct(
        F.lit(1).alias("ObjectId"), "event_id", F.get_json_object("props", "$.k").cast("int").alias("k")
    )
    geometry = F.struct(F.col("user_id").cast("double").alias("x"), F.col("value").alias("y"))
    features = F.array(F.struct(attributes.alias("attributes"), geometry.alias("geometry"))).alias("features")
    path = fresh_dir(t.spark, "s08")
    t.events.select(features).write.json(path)
    return readers.features_to_rows(t.spark.read.schema(shape).json(path))


_OPEN_FEATURES = {"event_id": "bigint", "k": "int", "name of customer": "string", "balance": "double", "geometry.x": "double"}


@query("s08_open_features", """
SELECT 'events' AS layer, event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, NULL::VARCHAR AS customer, NULL::DOUBLE AS balance,
    CAST(user_id AS DOUBLE) AS x, 'OBJECT<event_id: BIGINT, k: BIGINT>' AS attributes_type FROM events
UNION ALL SELECT 'customers', NULL, NULL, c_mktsegment, c_acctbal, NULL, 'OBJECT<balance: DOUBLE, `name of customer`: STRING>' FROM customer""")
def _(t):
    # Two layers with nothing in common, in pages of features.
    path = fresh_dir(t.spark, "s08-open")
    k = F.get_json_object("props", "$.k").cast("int").alias("k")
    events = t.events.select(F.pmod(F.xxhash64("event_id"), F.lit(200)).alias("page"), F.struct(
        F.struct("event_id", k).alias("attributes"), F.struct(F.col("user_id").cast("double").alias("x"), F.col("value").alias("y")).alias("geometry")).alias("f"))
    customers = t.customer.select(F.pmod(F.xxhash64("c_custkey"), F.lit(200)).alias("page"), F.struct(
        F.struct(F.col("c_mktsegment").alias("name of customer"), (F.col("c_acctbal") + 0.0).alias("balance")).alias("attributes")).alias("f"))
    for layer, features in (("events", events), ("customers", customers)):
        pages = features.groupBy("page").agg(F.collect_list("f").alias("features"))
        pages.select(F.to_json(F.struct("features")).alias("value")).write.text(f"{path}/layer={layer}")
    stored = stage(open_features.read_open_features(t.spark, f"{path}/*", whole_files=False), "s08-open")
    types = open_features.found_types(stored).select(F.col("layer").alias("__layer"), "attributes_type")
    # A decimal and a whole number are both found as numbers; here all balances count as doubles.
    types = types.withColumn("attributes_type", F.regexp_replace("attributes_type", r"DECIMAL\(\d+,\d+\)", "DOUBLE"))
    typed = open_features.typed_attributes(stored, _OPEN_FEATURES).withColumnRenamed("name of customer", "customer")
    return typed.join(types, F.col("layer") == F.col("__layer")).drop("__layer")


@query("s09_catalog_scan", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    view = writers.publish_view(t.orders, "cadastra_orders_scan")
    return view.groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("s10_first_rows", "SELECT event_id, user_id FROM events ORDER BY event_id LIMIT 100")
def _(t):
    return t.events.orderBy("event_id").limit(100).select("event_id", "user_id")


@query("s11_header_promotion", """
SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS name, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance
FROM customer""")
def _(t):
    body = t.customer.select(
        F.col("c_custkey").cast("string").alias("a"), F.col("c_name").alias("b"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("string")).otherwise("x").alias("c"),
    )
    banner = [(None, "Accounts by customer", None), (None, None, None), ("code", "name", "balance"), ("Grand total", None, "1")]
    path = fresh_dir(t.spark, "s11")
    sets.append_rows(body, banner).write.csv(path)
    sheet = t.spark.read.schema("a string, b string, c string").csv(path)
    table = readers.promote_header(sheet, "a", "code", total_pattern="Grand")
    return readers.cast_columns(table, {"balance": "double"})


@query("s12_yearly_series", "SELECT o_orderkey, year(o_orderdate)::INTEGER AS year FROM orders")
def _(t):
    path = fresh_dir(t.spark, "s12")
    t.orders.select("o_orderkey", F.year("o_orderdate").alias("y")).write.partitionBy("y").parquet(path)
    span = t.orders.agg(F.min(F.year("o_orderdate")).alias("a"), F.max(F.year("o_orderdate")).alias("b")).first()
    years = readers.year_names(f"Orders by customer, {span.a} to {span.b}", path + "/y={year}")
    return readers.read_series(t.spark.read.parquet, years)


@query("s13_inline_lookup", """
SELECT o_orderkey, dft_code, la_code FROM orders JOIN (VALUES ('1-URGENT', 101, 'E01'), ('2-HIGH', 102, 'E02'))
v(authority, dft_code, la_code) ON o_orderpriority = authority""")
def _(t):
    codes = {"1-URGENT": ["E01", 101], "2-HIGH": ["E02", 102]}
    lookup = readers.nested_codes(t.spark, codes, "authority string, la_code string, dft_code int")
    joined = enrich(
        t.orders.select("o_orderkey", "o_orderpriority"),
        Lookup(lookup, {"o_orderpriority": "authority"}, ["dft_code", "la_code"], "inner"),
    )
    return joined.drop("o_orderpriority")


# --- sinks, maintenance, gates ---------------------------------------------------------------


@query("k01_replace_table", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'")
def _(t):
    path = fresh_dir(t.spark, "k01")
    picked = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    writers.replace_table(picked, path)
    return writers.replace_table(picked.where("o_orderstatus = 'O'").drop("o_orderstatus"), path)


@query("k02_append_with_schema", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(t):
    path = fresh_dir(t.spark, "k02")
    schema = T.StructType.fromDDL("o_orderkey long, o_custkey long, o_totalprice double")
    for condition in ("o_orderstatus = 'F'", "o_orderstatus <> 'F'"):
        writers.append_table(t.orders.where(condition), path, schema)
    return t.spark.read.schema(schema).parquet(path)


@query("k03_view", """
SELECT o_custkey, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderstatus = 'F' GROUP BY 1""")
def _(t):
    view = writers.publish_view(t.orders.where("o_orderstatus = 'F'"), "cadastra_finished_orders_vw")
    return view.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))


def _database(t: Tables, name: str, tables: dict[str, DataFrame]) -> str:
    """A database of the catalog that holds exactly the given tables, stored in the scratch folder."""
    t.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{fresh_dir(t.spark, name)}'")
    for table in writers.catalog_tables(t.spark, name):
        t.spark.sql(f"DROP TABLE {name}.{table}")  # external: only the entry goes
    for table, df in tables.items():
        writers.replace_catalog_table(df, f"{name}.{table}", fresh_dir(t.spark, table))
    return name


@query("k04_export_tables", """
SELECT 'customer' AS table_name, count(*) AS n FROM customer
UNION ALL SELECT 'orders', count(*) FROM orders""")
def _(t):
    database = _database(t, "cadastra_export", {"customer": t.customer, "orders": t.orders})
    paths = writers.export_tables(t.spark, fresh_dir(t.spark, "k04"), database=database)
    counts = {name: t.spark.read.parquet(p).agg(F.count("*").alias("n")) for name, p in paths.items()}
    return sets.unite_tagged(counts, "table_name")


@query("k05_csv_export", """
SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment, c_acctbal FROM customer""")
def _(t):
    holes = t.customer.select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"), "c_acctbal")
    return readers.read_declared_csv(t.spark, _csv(t, holes, "k05"), holes.schema).drop("filename")


@query("k06_parquet_export", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def _(t):
    return stage(t.supplier, "k06")


@query("k07_geojson_export", """
SELECT c_custkey, c_mktsegment, 'Feature' AS type, CAST(c_nationkey AS DOUBLE) AS x, c_acctbal AS y FROM customer""")
def _(t):
    path = fresh_dir(t.spark, "k07")
    x, y = F.col("c_nationkey").cast("double"), F.col("c_acctbal")
    writers.write_geojson_lines(t.customer, path, x, y, ["c_custkey", "c_mktsegment"])
    shape = ("type string, geometry struct<type string, coordinates array<double>>, "
             "properties struct<c_custkey long, c_mktsegment string>")
    back = t.spark.read.schema(shape).json(path)
    point = F.col("geometry.coordinates")
    return back.select("properties.*", "type", point[0].alias("x"), point[1].alias("y"))


@query("k07_polygon_export", """
SELECT c_custkey, c_mktsegment, 'Feature' AS type, CASE WHEN c_nationkey > 3 THEN 'Polygon' END AS kind,
    CASE WHEN c_nationkey > 3 THEN CAST(c_nationkey + 1 AS DOUBLE) END AS corner FROM customer""")
def _(t):
    path = fresh_dir(t.spark, "k07p")
    ring = F.format_string(
        '{"type":"Polygon","coordinates":[[[0,0],[%s,0],[0,1],[0,0]]]}', (F.col("c_nationkey") + 1).cast("string")
    )
    shapes = t.customer.withColumn("shape", F.when(F.col("c_nationkey") > 3, ring))
    writers.geojson_carried(shapes, "shape", ["c_custkey", "c_mktsegment"]).write.text(path)
    shape = ("type string, geometry struct<type string, coordinates array<array<array<double>>>>, "
             "properties struct<c_custkey long, c_mktsegment string>")
    back = t.spark.read.schema(shape).json(path)
    corner = F.get(F.get(F.get("geometry.coordinates", F.lit(0)), F.lit(1)), F.lit(0))
    return back.select("properties.*", "type", F.col("geometry.type").alias("kind"), corner.alias("corner"))


@query("k07_code_list", """
SELECT '[' || string_agg(DISTINCT '"' || c_mktsegment || '"', ',' ORDER BY '"' || c_mktsegment || '"') || ']' AS value FROM customer""")
def _(t):
    return writers.json_list(t.customer, "c_mktsegment")


@query("k08_add_and_set_column", "SELECT c_custkey, 'POINT (' || c_nationkey || ' ' || c_custkey || ')' AS geom FROM customer")
def _(t):
    empty = t.customer.select("c_custkey", "c_nationkey", F.lit(None).cast("string").alias("geom"))
    filled = F.format_string("POINT (%s %s)", F.col("c_nationkey"), F.col("c_custkey"))
    return empty.withColumn("geom", filled).drop("c_nationkey")


@query("k09_repeated_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def _(t):
    return quality.repeated_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("k10_orphan_keys", """
SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def _(t):
    return quality.orphan_keys(t.orders, t.customer.where(F.col("c_acctbal") > 0), {"o_custkey": "c_custkey"})


_NOTES = {
    "event_id": {"comment": "Event number", "label": "Event"},
    "value": {"comment": "Measured value", "unit": "kWh", "label": "Value"},
}


@query("k11_column_notes", """
SELECT 'event_id' AS column_name, 1 AS position, 'bigint' AS column_type, 'Event number' AS comment, NULL::VARCHAR AS unit,
       'Event' AS label, count(event_id) AS n_values FROM events
UNION ALL SELECT 'value', 2, 'double', 'Measured value', 'kWh', 'Value', count(CASE WHEN event_type <> 'error' THEN value END)
FROM events""")
def _(t):
    noted = t.events.select("event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value"))
    return quality.column_notes(quality.with_column_notes(noted, _NOTES))


@query("k12_conform_update", """
SELECT o_orderkey AS "ORDER_KEY", o_totalprice AS "TOTAL_PRICE", 'update - 2024/01/31 09:00:00' AS filename FROM orders""")
def _(t):
    hyphenated = t.orders.select(F.col("o_orderkey").alias("order-key"), F.col("o_totalprice").alias("total-price"))
    return writers.conform_update(hyphenated, "2024/01/31 09:00:00")


def _load_gates(stored: dict[str, DataFrame]) -> None:
    quality.require_none(quality.repeated_keys(stored["customer"], "c_custkey"), "repeated customer key")
    orphans = quality.orphan_keys(stored["orders"], stored["customer"], {"o_custkey": "c_custkey"})
    quality.require_none(orphans, "order without customer")


@query("k13_atomic_load", """
SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1""")
def _(t):
    root = fresh_dir(t.spark, "k13")
    good = {"orders": t.orders, "customer": t.customer}
    writers.publish_tables(t.spark, root, good, _load_gates)
    broken = {"orders": t.orders.where("o_orderstatus = 'F'"), "customer": t.customer.where("c_acctbal > 0")}
    try:
        writers.publish_tables(t.spark, root, broken, _load_gates)
    except quality.GateError:
        pass  # the refused load must leave the first version in place
    stored = writers.published_table(t.spark, root, "orders")
    return stored.groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("k13_gated_load", """
SELECT 'customer' AS table_name, 'segment is known' AS gate, count(*) FILTER (c_mktsegment NOT IN ('BUILDING', 'MACHINERY')) AS n_rows FROM customer
UNION ALL SELECT 'orders', 'year is in window', count(*) FILTER (year(o_orderdate) NOT BETWEEN 1993 AND 1996) FROM orders
UNION ALL SELECT 'customer', 'c_custkey is unique', 0
UNION ALL SELECT 'orders', 'o_orderkey is unique', count(*) FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'orders', 'o_custkey is in customer', count(DISTINCT o_custkey) FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0)
UNION ALL SELECT 'stored customers', 'rows', count(*) FROM customer""")
def _(t):
    # A good load, then one that every gate has something against: it is refused and the first one stays.
    root = fresh_dir(t.spark, "k13g")
    gates.publish_checked(t.spark, root, {"customer": t.customer}, {"customer": gates.Checks(unique=("c_custkey",), least_rows=1)})
    broken = {
        "customer": t.customer.withColumn("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey"))),
        "orders": t.orders.unionAll(t.orders.where("o_orderstatus = 'F'").withColumn("o_orderdate", F.lit("1995-01-01").cast("timestamp_ntz"))),
    }
    checks = {
        "customer": gates.Checks({"segment is known": F.col("c_mktsegment").isin("BUILDING", "MACHINERY")}, ("c_custkey",)),
        "orders": gates.Checks({"year is in window": F.year("o_orderdate").between(1993, 1996)}, ("o_orderkey",), {"customer": {"o_custkey": "c_custkey"}}),
    }
    report = []
    try:
        gates.publish_checked(t.spark, root, broken, checks)
    except gates.RefusedLoad as refused:
        report = refused.report
    stored = writers.published_table(t.spark, root, "customer").select(F.lit("stored customers").alias("table_name"), F.lit("rows").alias("gate"))
    counted = stored.groupBy("table_name", "gate").agg(F.count("*").alias("n_rows"))
    return local_table(t.spark, report, "table_name string, gate string, n_rows bigint").unionAll(counted)


_CATALOG = ["customer", "orders", "lineitem", "events"]


@query("k14_catalog_columns", """
SELECT table_name, column_name, n_rows FROM (
    SELECT 'customer' AS table_name, count(*) AS n_rows FROM customer UNION ALL SELECT 'orders', count(*) FROM orders
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events) c
JOIN (SELECT DISTINCT table_name, column_name FROM information_schema.columns) i USING (table_name)""")
def _(t):
    database = _database(t, "cadastra_catalog", {name: getattr(t, name) for name in _CATALOG})
    return quality.catalog_columns(t.spark, database=database).select("table_name", "column_name", "n_rows")


@query("k15_unknown_values", """
SELECT v AS o_orderpriority FROM (VALUES ('1-URGENT'), ('6-NEVER'), ('5-LOW'), ('0-NOW')) x(v)
WHERE v NOT IN (SELECT o_orderpriority FROM orders)""")
def _(t):
    requested = readers.inline_table(
        t.spark, [("1-URGENT",), ("6-NEVER",), ("5-LOW",), ("0-NOW",)], "o_orderpriority string"
    )
    return quality.unknown_values(requested, t.orders, "o_orderpriority")


@query("k15_outside_window", """
SELECT DISTINCT year(o_orderdate)::INTEGER AS year FROM orders WHERE year(o_orderdate) NOT BETWEEN 1993 AND 1996""")
def _(t):
    return quality.outside_window(t.orders.select(F.year("o_orderdate").alias("year")), "year", 1993, 1996)


# --- incremental -----------------------------------------------------------------------------

_TODAY = dt.date(1999, 3, 15)


@query("t01_rows_to_load", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate FROM orders
WHERE o_orderdate >= (SELECT date_trunc('month', max(o_orderdate)) + INTERVAL 1 MONTH FROM orders
                      WHERE o_orderdate < TIMESTAMP '1998-06-10')
  AND o_orderdate < TIMESTAMP '1999-03-01'""")
def _(t):
    stored = t.orders.where(F.col("o_orderdate") < F.lit("1998-06-10").cast("timestamp_ntz"))
    fresh = incremental.rows_to_load(stored, t.orders, "o_orderdate", _TODAY)
    return fresh.select("o_orderkey", F.to_date("o_orderdate").cast("string").alias("o_orderdate"))


_UPDATES_SQL = """
WITH u AS (SELECT event_id, user_id, value * 2 AS value FROM events WHERE event_type = 'purchase'
           UNION ALL SELECT -event_id, user_id, value FROM events WHERE event_type = 'error')
SELECT event_id, user_id, value FROM u
UNION ALL SELECT event_id, user_id, value FROM events WHERE event_id NOT IN (SELECT event_id FROM u)"""


def _event_updates(t: Tables, *extra: str) -> DataFrame:
    """Purchases with doubled value, and new events with negative numbers."""
    columns = ["event_id", "user_id", "value", *extra]
    changed = t.events.where("event_type = 'purchase'").withColumn("value", F.col("value") * 2).select(*columns)
    added = t.events.where("event_type = 'error'").withColumn("event_id", -F.col("event_id")).select(*columns)
    return changed.unionByName(added)


@query("t02_keyed_upsert", _UPDATES_SQL)
def _(t):
    return incremental.upsert(t.events.select("event_id", "user_id", "value"), _event_updates(t), "event_id", "value")


@query("t02_upsert_repeated_key", """
SELECT event_id, user_id, CASE WHEN event_type = 'purchase' THEN value * 3 ELSE value END AS value FROM events""")
def _(t):
    # Each purchase twice in one batch; the later pull wins, wherever its rows stand.
    columns = ["event_id", "user_id", "value"]
    bought = t.events.where("event_type = 'purchase'")
    pulls = [bought.select("event_id", "user_id", (F.col("value") * k).alias("value"), F.lit(k).alias("pull")) for k in (3, 2)]
    stored = t.events.select(*columns, F.lit(0).alias("pull"))
    later = pulls[0].unionByName(pulls[1].withColumn("pull", F.lit(1)))
    return incremental.upsert(stored, later, "event_id", "pull").select(*columns)


@query("t02_streamed_upsert", _UPDATES_SQL)
def _(t):
    day = F.to_date("ts").alias("day")
    table, feed, checkpoint = (fresh_dir(t.spark, f"t02-{part}") for part in ("table", "feed", "checkpoint"))
    events = t.events.select("event_id", "user_id", "value", day)
    writers.replace_table(events, table, ["day"])
    updates = _event_updates(t, "ts").withColumn("day", F.to_date("ts")).drop("ts")
    updates.write.parquet(feed)
    stream = incremental.stream_files(t.spark, feed, updates.schema)
    incremental.run_upserts(stream, table, checkpoint, ["event_id", "day"], "day", "value")
    return t.spark.read.schema(events.schema).parquet(table).select("event_id", "user_id", "value")


@query("t03_update_batch", """
SELECT o_orderkey AS "O_ORDERKEY", o_orderpriority AS "O_ORDERPRIORITY", 'update - 2024/02/01 00:00:00' AS filename
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def _(t):
    picked = rename_all(t.orders.select("o_orderkey", "o_orderpriority"), lambda c: c.replace("_", "-"))
    pulls = [picked.where(F.col("o-orderpriority") == p) for p in ("1-URGENT", "2-HIGH")]
    return incremental.update_batch(pulls, "2024/02/01 00:00:00")


@query("t04_page_reassembly", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(t):
    path = fresh_dir(t.spark, "t04")
    pages = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    pages.write.option("header", True).csv(path)
    empty = pages.where(F.lit(False))
    empty.write.mode("append").option("header", True).csv(path)
    return incremental.read_pages(t.spark, path, pages.schema)


@query("t05_stream_latest_per_key", """
SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER
    (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def _(t):
    feed, out, checkpoint = (fresh_dir(t.spark, f"t05-{part}") for part in ("feed", "out", "checkpoint"))
    events = t.events.select("user_id", "event_id", "event_type", "value", "ts")
    for condition in ("event_type = 'view'", "event_type <> 'view'"):
        events.where(condition).write.mode("append").parquet(feed)
        stream = incremental.stream_files(t.spark, feed, events.schema)
        latest = incremental.stream_latest(stream, "user_id", ["ts", "event_id"], ["event_id", "event_type", "value"])
        incremental.run_latest_table(latest, out, checkpoint, "user_id", t.spark.sparkContext.defaultParallelism)
    return incremental.latest_table(t.spark, out, latest.schema, "user_id")


@query("t05_stream_high_water_mark", "SELECT event_id, user_id, value FROM events")
def _(t):
    # Two runs of one query over a growing folder: the second reads only the files that are new.
    feed, out, checkpoint = (fresh_dir(t.spark, f"t05h-{part}") for part in ("feed", "out", "checkpoint"))
    events = t.events.select("event_id", "user_id", "value", "event_type")
    for condition in ("event_type = 'view'", "event_type <> 'view'"):
        events.where(condition).write.mode("append").parquet(feed)
        stream = incremental.stream_files(t.spark, feed, events.schema).drop("event_type")
        incremental.run_to_folder(stream, out, checkpoint, "append")
    return t.spark.read.parquet(out).drop("batch")


#: Three waves of events in the order of their arrival: their days, and which of the days before come again or late.
_WAVES = ((1, 10, "false"), (11, 20, "event_id % 5 = 0"), (21, 31, "event_id % 3 = 0"))
_DELAY_DAYS = 2


def _wave(first: int, last: int, again: str) -> str:
    """Events of a wave: its own days without every seventh event, some of all earlier ones (repeats), and, late, what was left out before."""
    return (f"(day(ts) BETWEEN {first} AND {last} AND event_id % 7 <> 0) OR (day(ts) < {first} AND {again})"
            f" OR (day(ts) BETWEEN {first - 10} AND {first - 1} AND event_id % 7 = 0)")


# An event counts at its first arrival, if that is not behind the newest time of the waves before less the delay.
_ARRIVALS_SQL = f"""
WITH arrivals AS ({" UNION ALL ".join(f"SELECT {i} AS wave, * FROM events WHERE {_wave(*w)}" for i, w in enumerate(_WAVES))}
), marks AS (
  SELECT wave, max(max(ts)) OVER (ORDER BY wave ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL {_DELAY_DAYS} DAY AS mark
  FROM arrivals GROUP BY wave
), counted AS (
  SELECT a.* FROM arrivals a JOIN marks USING (wave) WHERE mark IS NULL OR ts > mark QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY wave) = 1
), last_mark AS (SELECT max(ts) - INTERVAL {_DELAY_DAYS} DAY AS mark FROM arrivals)"""


def _event_waves(t: Tables, label: str, build):
    """Run ``build(stream)`` over the three waves, each a run of its own on one checkpoint; the folder of results."""
    feed, out, checkpoint = (fresh_dir(t.spark, f"{label}-{part}") for part in ("feed", "out", "checkpoint"))
    for wave in _WAVES:
        t.events.where(_wave(*wave)).write.mode("append").parquet(feed)
        stream = event_time.with_watermark(incremental.stream_files(t.spark, feed, t.events.schema), "ts", f"{_DELAY_DAYS} days")
        built = build(event_time.first_arrivals(stream, "event_id"))
        incremental.run_to_folder(built, out, checkpoint, "append", t.spark.sparkContext.defaultParallelism)
    return t.spark.read.schema(built.schema).parquet(out).select(*built.columns)


@query("t05_first_arrivals", _ARRIVALS_SQL + " SELECT event_id, user_id, value FROM counted")
def _(t):
    return _event_waves(t, "t05-arrivals", lambda s: s).select("event_id", "user_id", "value")


@query("t05_closed_windows", _ARRIVALS_SQL + """
SELECT date_trunc('day', ts)::DATE AS day, event_type, count(*) AS n_events, round(sum(value), 4) AS value
FROM counted, last_mark GROUP BY 1, 2, mark HAVING date_trunc('day', ts)::DATE + INTERVAL 1 DAY <= mark""")
def _(t):
    sums = [F.count("*").alias("n_events"), F.round(F.sum("value"), 4).alias("value")]
    windows = _event_waves(t, "t05-windows", lambda s: event_time.closed_windows(s, "ts", "1 day", sums, "event_type"))
    return windows.select(F.to_date("window_start").alias("day"), "event_type", "n_events", "value")
