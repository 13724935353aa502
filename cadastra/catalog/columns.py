"""P (projections), F (filters), X (functions), D (derived columns), G (points)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cadastra.catalog.registry import Tables, query
from cadastra.catalog.standins import band_sql, band_text, epoch_sql, range_year_sql, words, words_sql
from cadastra.functions import bands, dates, domain, geo, grid_shift, numbers, polygons, text
from cadastra.operators import aggs, filters, joins, names, windows
from cadastra.sources.staging import stage

# --- projections -----------------------------------------------------------------------------


@query("p01_select_alias", "SELECT o_orderkey AS order_id, o_totalprice AS price FROM orders")
def _(t: Tables):
    return t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("price"))


@query("p02_select_except", "SELECT * EXCLUDE (o_orderdate, o_orderpriority) FROM orders")
def _(t):
    return t.orders.drop("o_orderdate", "o_orderpriority")


@query("p03_upper_names", 'SELECT c_custkey AS "C-CUSTKEY", c_name AS "C-NAME", c_mktsegment AS "C-MKTSEGMENT" FROM customer')
def _(t):
    picked = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return picked.transform(names.upper_names).transform(names.swap_chars, {"_": "-"})


@query("p04_clean_names", "SELECT s_suppkey AS supplier_key, s_name AS supplier_name_text, s_acctbal AS balance FROM supplier")
def _(t):
    messy = t.supplier.select("s_suppkey", "s_name", "s_acctbal").toDF(
        " Supplier  Key", "Supplier (Name):\n text", "Balance..."
    )
    return names.clean_names(messy)


@query("p05_strip_digit_names", "SELECT o_orderkey AS key_1, o_custkey AS key, o_totalprice AS price FROM orders")
def _(t):
    numbered = t.orders.select("o_orderkey", "o_custkey", "o_totalprice").toDF("KEY1", "KEY2", "PRICE")
    return names.strip_digit_names(numbered)


@query("p06_dictionary_rename", "SELECT p_partkey AS part_id, p_name AS title, p_size FROM part")
def _(t):
    return t.part.select("p_partkey", "p_name", "p_size").withColumnsRenamed({"p_partkey": "part_id", "p_name": "title"})


@query("p07_affix_names", """
SELECT year(l_shipdate)::INTEGER AS year,
       round_even(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) * 100.0 / count(*), 1) AS returned_percent,
       round_even(sum(CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END) * 100.0 / count(*), 1) AS bulk_percent
FROM lineitem GROUP BY 1""")
def _(t):
    flags = t.lineitem.select(
        F.year("l_shipdate").alias("year"),
        (F.col("l_returnflag") == "R").cast("int").alias("returned"),
        (F.col("l_quantity") > 25).cast("int").alias("bulk"),
    )
    percents = flags.groupBy("year").agg(*[aggs.flag_percent(c).alias(f"d_{c}") for c in ("returned", "bulk")])
    return names.affix_names(percents, "d_", suffix="_percent")


@query("p08_numeric_columns", "SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def _(t):
    return t.lineitem.select(*names.matching(t.lineitem, r"^l_(?!.*key|line)", numeric=True))


@query("p09_literal_column", "SELECT o_orderkey, 'orders' AS source, 2023 AS year FROM orders")
def _(t):
    return t.orders.select("o_orderkey", F.lit("orders").alias("source"), F.lit(2023).alias("year"))


@query("p10_all_to_text", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""")
def _(t):
    return t.customer.select(*[F.col(c).cast("string").alias(c) for c in t.customer.columns])


@query("p11_alias_reuse", """
SELECT o_orderkey, floor(o_totalprice / 1000) AS thousands,
       CASE WHEN floor(o_totalprice / 1000) < 100 THEN 'small' ELSE 'large' END AS bucket FROM orders""")
def _(t):
    thousands = F.floor(F.col("o_totalprice") / 1000).cast("double").alias("thousands")
    return t.orders.select(
        "o_orderkey", thousands, F.when(F.col("thousands") < 100, "small").otherwise("large").alias("bucket")
    )


@query("p12_row_id", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rowname FROM orders")
def _(t):
    return windows.row_numbers(t.orders.select("o_orderkey"), "o_orderkey", "rowname")


@query("p13_conditional", """
SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN 'now' WHEN o_orderpriority LIKE '5%' THEN 'later'
       ELSE 'soon' END AS turn FROM orders""")
def _(t):
    priority = F.col("o_orderpriority")
    turn = F.when(priority.startswith("1"), "now").when(priority.startswith("5"), "later").otherwise("soon")
    return t.orders.select("o_orderkey", turn.alias("turn"))


@query("p14_sentinel_to_null", "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders")
def _(t):
    return t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"))


@query("p15_fill_then_cast", """
SELECT event_id, CAST(round_even(coalesce(CASE WHEN event_type <> 'error' THEN value END, 0.0), 0) AS INTEGER)
       AS whole FROM events""")
def _(t):
    value = F.when(F.col("event_type") != "error", F.col("value"))
    return t.events.select("event_id", numbers.half_even_int(F.coalesce(value, F.lit(0.0))).alias("whole"))


@query("p16_cast_strict_and_lenient", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS strict_k,
       TRY_CAST(event_type AS INTEGER) AS lenient_type FROM events""")
def _(t):
    return t.events.select(
        "event_id",
        F.get_json_object("props", "$.k").cast("int").alias("strict_k"),
        F.col("event_type").try_cast("int").alias("lenient_type"),
    )


# --- filters ---------------------------------------------------------------------------------


@query("f01_compare_and_range", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_extendedprice > 50000 AND l_discount BETWEEN 0.02 AND 0.05 AND l_shipdate >= TIMESTAMP '1997-01-01'""")
def _(t):
    line = t.lineitem.where(
        (F.col("l_extendedprice") > 50000)
        & F.col("l_discount").between(0.02, 0.05)
        & (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    )
    return line.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("f02_in_and_not_in", """
SELECT o_orderkey, o_orderpriority FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P')""")
def _(t):
    wanted = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~F.col("o_orderstatus").isin("P")
    return t.orders.where(wanted).select("o_orderkey", "o_orderpriority")


@query("f03_in_key_list", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def _(t):
    building = t.customer.where(F.col("c_mktsegment") == "BUILDING")
    return joins.keep_listed(t.orders, building, {"o_custkey": "c_custkey"}).select("o_orderkey", "o_custkey")


@query("f04_in_subquery", """
SELECT c_custkey, c_nationkey FROM customer
WHERE c_nationkey IN (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE')""")
def _(t):
    # Passed by argument, so no session-wide view names are needed.
    return t.spark.sql(
        """SELECT c_custkey, c_nationkey FROM {customer} WHERE c_nationkey IN
           (SELECT n_nationkey FROM {nation} JOIN {region} ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE')""",
        customer=t.customer, nation=t.nation, region=t.region,
    )


@query("f05_either_present", """
SELECT o_orderkey FROM orders WHERE nullif(o_orderstatus, 'P') IS NOT NULL OR nullif(o_orderpriority, '5-LOW') IS NOT NULL""")
def _(t):
    status, priority = F.nullif("o_orderstatus", F.lit("P")), F.nullif("o_orderpriority", F.lit("5-LOW"))
    return t.orders.where(status.isNotNull() | priority.isNotNull()).select("o_orderkey")


@query("f06_drop_any_null", """
SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority FROM orders
WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'""")
def _(t):
    holes = t.orders.select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
    )
    return holes.dropna("any")


@query("f07_text_predicates", """
SELECT p_partkey, CAST(contains(p_name, 'a') AS INTEGER) AS has_a, CAST(p_brand LIKE 'Brand#1%' AS INTEGER) AS brand_one,
       CAST(regexp_matches(p_brand, '[0-9]{2}$') AS INTEGER) AS two_digits FROM part WHERE NOT starts_with(p_type, 'PROMO')""")
def _(t):
    return t.part.where(~F.col("p_type").startswith("PROMO")).select(
        "p_partkey",
        F.col("p_name").contains("a").cast("int").alias("has_a"),
        F.col("p_brand").like("Brand#1%").cast("int").alias("brand_one"),
        F.col("p_brand").rlike("[0-9]{2}$").cast("int").alias("two_digits"),
    )


@query("f08_rows_at_max", """
SELECT o_orderkey, o_custkey FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)""")
def _(t):
    return filters.in_latest_year(t.orders, "o_orderdate").select("o_orderkey", "o_custkey")


@query("f09_rows_at_extremes", """
SELECT o_orderkey, year(o_orderdate)::INTEGER AS year FROM orders
WHERE year(o_orderdate) IN ((SELECT min(year(o_orderdate)) FROM orders), (SELECT max(year(o_orderdate)) FROM orders))""")
def _(t):
    return filters.in_extreme_years(t.orders, "o_orderdate").select("o_orderkey", F.year("o_orderdate").alias("year"))


@query("f10_boolean_predicate", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 100000")
def _(t):
    flagged = t.orders.withColumn("current", (F.col("o_orderstatus") == "O").cast("int"))
    return flagged.where(F.col("current").cast("boolean") & (F.col("o_totalprice") > 100000)).select("o_orderkey")


@query("f11_trailing_years", """
WITH m AS (SELECT max(o_orderdate) AS d FROM orders),
     y AS (SELECT year(d) - CASE WHEN month(d) = 12 AND day(d) = 31 THEN 0 ELSE 1 END AS last_year FROM m)
SELECT o_orderkey, year(o_orderdate)::INTEGER AS year FROM orders, y
WHERE year(o_orderdate) BETWEEN last_year - 3 AND last_year""")
def _(t):
    return filters.trailing_years(t.orders, "o_orderdate", 3).select("o_orderkey", F.year("o_orderdate").alias("year"))


# --- scalar functions ------------------------------------------------------------------------


@query("x01_regex_replace_all", "SELECT c_custkey, regexp_replace(c_name, '[A-Za-z#]', '', 'g') AS rest FROM customer")
def _(t):
    return t.customer.select("c_custkey", F.regexp_replace("c_name", "[A-Za-z#]", "").alias("rest"))


@query("x02_regex_extract_first", """
SELECT c_custkey, nullif(regexp_extract(c_name, '[0-9]+'), '') AS digits,
       nullif(regexp_extract(c_name, 'x[0-9]+'), '') AS none FROM customer""")
def _(t):
    return t.customer.select(
        "c_custkey", text.extract_first("c_name", "[0-9]+").alias("digits"),
        text.extract_first("c_name", "x[0-9]+").alias("none"),
    )


@query("x03_regex_extract_all", """
SELECT p_partkey, array_to_string(regexp_extract_all(p_brand, '[0-9]'), '') AS digits FROM part""")
def _(t):
    return t.part.select("p_partkey", text.extract_all_joined("p_brand", "([0-9])").alias("digits"))


@query("x04_regex_groups", """
SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month,
       strftime(o_orderdate, '%d') AS day FROM orders""")
def _(t):
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    parts = text.extract_groups(iso, r"(\d{4})-(\d{2})-(\d{2})", ["year", "month", "day"])
    return t.orders.select("o_orderkey", parts.alias("parts")).select("o_orderkey", "parts.*")


@query("x05_split_part", """
SELECT c_custkey, split_part(c_name, '#', 1) AS head, split_part(c_name, '#', 2) AS tail,
       split_part(c_name, '#', 3) AS beyond FROM customer""")
def _(t):
    parts = [F.split_part("c_name", F.lit("#"), F.lit(i)).alias(n) for i, n in ((1, "head"), (2, "tail"), (3, "beyond"))]
    return t.customer.select("c_custkey", *parts)


@query("x06_substring", "SELECT o_orderkey, substring(strftime(o_orderdate, '%Y-%m-%d'), 6, 2) AS month FROM orders")
def _(t):
    return t.orders.select("o_orderkey", F.substring(F.date_format("o_orderdate", "yyyy-MM-dd"), 6, 2).alias("month"))


@query("x07_concat_template", """
SELECT c_custkey, 'customer-' || c_custkey || '/' || nullif(c_mktsegment, 'BUILDING') || '.csv' AS path FROM customer""")
def _(t):
    segment = F.nullif("c_mktsegment", F.lit("BUILDING"))
    path = F.concat(F.lit("customer-"), F.col("c_custkey").cast("string"), F.lit("/"), segment, F.lit(".csv"))
    return t.customer.select("c_custkey", path.alias("path"))


@query("x08_case_conversion", """
SELECT c_custkey, lower(c_mktsegment) AS lo, upper(lower(c_mktsegment)) AS up,
       upper(substring(c_mktsegment, 1, 1)) || lower(substring(c_mktsegment, 2)) AS title FROM customer""")
def _(t):
    segment = F.col("c_mktsegment")
    return t.customer.select(
        "c_custkey", F.lower(segment).alias("lo"), F.upper(F.lower(segment)).alias("up"), F.initcap(segment).alias("title")
    )


@query("x09_strip_digits", "SELECT p_partkey, regexp_replace(lower(p_brand), '[0-9]', '', 'g') AS brand FROM part")
def _(t):
    return t.part.select("p_partkey", text.strip_digits("p_brand").alias("brand"))


@query("x10_char_length", "SELECT p_partkey, length(p_name)::INTEGER AS n FROM part")
def _(t):
    return t.part.select("p_partkey", F.char_length("p_name").alias("n"))


@query("x11_parse_timestamp", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS VARCHAR) END AS parsed FROM orders""")
def _(t):
    broken = F.when(F.col("o_orderstatus") == "P", "not a date").otherwise(
        F.date_format("o_orderdate", "dd/MM/yyyy HH:mm:ss")
    )
    parsed = dates.parse_timestamp(broken, "dd/MM/yyyy HH:mm:ss")
    return t.orders.select("o_orderkey", parsed.cast("string").alias("parsed"))


@query("x12_date_parts", """
SELECT o_orderkey, day(o_orderdate)::INTEGER AS day, month(o_orderdate)::INTEGER AS month,
       year(o_orderdate)::INTEGER AS year, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date FROM orders""")
def _(t):
    return t.orders.select(
        "o_orderkey", *dates.date_parts("o_orderdate"), F.to_date("o_orderdate").cast("string").alias("date")
    )


@query("x13_iso_text_parts", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, year(ts)::INTEGER AS year, month(ts)::INTEGER AS month,
       day(ts)::INTEGER AS day_of_month, hour(ts)::INTEGER AS hour FROM events""")
def _(t):
    iso = t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"))
    return iso.select("event_id", *dates.iso_text_parts("iso"))


@query("x14_month_from_label", """
SELECT o_orderkey, strftime(date_trunc('month', o_orderdate) +
       CASE WHEN year(o_orderdate) < 2000 THEN INTERVAL 100 YEAR ELSE INTERVAL 0 YEAR END, '%Y-%m-%d') AS month
FROM orders""")
def _(t):
    label = F.concat(F.lower(F.date_format("o_orderdate", "MMM_yy")), F.lit("_total_charging_devices"))
    return t.orders.select("o_orderkey", dates.month_from_label(label).cast("string").alias("month"))


@query("x15_quarter_start", """
SELECT o_orderkey, strftime(date_trunc('quarter', o_orderdate), '%Y-%m-%d') AS quarter FROM orders""")
def _(t):
    label = F.concat(F.year("o_orderdate").cast("string"), F.lit(" Q"), F.quarter("o_orderdate").cast("string"))
    return t.orders.select("o_orderkey", dates.quarter_start(label).cast("string").alias("quarter"))


@query("x16_months_around", """
SELECT o_custkey, strftime(date_trunc('month', max(o_orderdate)) + INTERVAL 1 MONTH, '%Y-%m-%d') AS from_month,
       strftime(date_trunc('month', max(o_orderdate)) - INTERVAL 1 MONTH, '%Y-%m-%d') AS to_month
FROM orders GROUP BY 1""")
def _(t):
    newest = F.max(F.to_date("o_orderdate"))
    return t.orders.groupBy("o_custkey").agg(
        dates.month_after(newest).cast("string").alias("from_month"),
        dates.month_before(newest).cast("string").alias("to_month"),
    )


@query("x17_last_year_complete", """
SELECT o_orderpriority, CAST(month(max(o_orderdate)) = 12 AND day(max(o_orderdate)) = 31 AS INTEGER) AS complete,
       (year(max(o_orderdate)) - CASE WHEN month(max(o_orderdate)) = 12 AND day(max(o_orderdate)) = 31 THEN 0 ELSE 1 END
       )::INTEGER AS last_year FROM orders GROUP BY 1""")
def _(t):
    newest = F.max("o_orderdate")
    return t.orders.groupBy("o_orderpriority").agg(
        dates.is_year_end(newest).cast("int").alias("complete"), dates.last_complete_year(newest).alias("last_year")
    )


@query("x18_rounding", """
SELECT l_orderkey, l_linenumber, l_quantity, round(l_quantity / 2, 0) AS half_up,
       round_even(l_quantity / 2, 0) AS half_even FROM lineitem""")
def _(t):
    half = F.col("l_quantity") / 2
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", F.round(half, 0).alias("half_up"), F.bround(half, 0).alias("half_even")
    )


@query("x19_floor_midpoint", """
SELECT l_orderkey, l_linenumber,
       CAST(floor((l_suppkey - l_partkey) / 2) + l_partkey AS INTEGER) AS middle FROM lineitem""")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", numbers.floor_midpoint("l_partkey", "l_suppkey").alias("middle"))


@query("x20_row_mean", """
SELECT l_orderkey, l_linenumber, round(CASE WHEN l_returnflag = 'N' THEN (l_discount + l_tax) / 2
       ELSE l_tax END, 6) AS mean FROM lineitem""")
def _(t):
    discount = F.when(F.col("l_returnflag") == "N", F.col("l_discount"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.round(numbers.row_mean(discount, "l_tax"), 6).alias("mean")
    )


@query("x21_percent_ratio", """
SELECT l_orderkey, l_linenumber, round(l_tax * 100 / nullif(l_discount, 0), 4) AS pct FROM lineitem""")
def _(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.round(numbers.percent_ratio("l_tax", "l_discount"), 4).alias("pct")
    )


@query("x22_unit_scaling", """
SELECT o_orderkey, o_totalprice / 1000000 AS km2, o_totalprice / 1000 AS gwh, round(o_totalprice * 1000, 2) AS tonnes
FROM orders""")
def _(t):
    return t.orders.select(
        "o_orderkey",
        numbers.square_metres_to_km2("o_totalprice").alias("km2"),
        numbers.mwh_to_gwh("o_totalprice").alias("gwh"),
        F.round(numbers.kilotonnes_to_tonnes("o_totalprice"), 2).alias("tonnes"),
    )


@query("x23_struct_and_list_access", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_type AS first_item FROM events""")
def _(t):
    nested = t.events.select(
        "event_id", F.from_json("props", "k int").alias("p"), F.array("event_type", "props").alias("items")
    )
    return nested.select("event_id", F.col("p").getField("k").alias("k"), F.col("items").getItem(0).alias("first_item"))


@query("x24_ordinal_text", """
SELECT o_orderkey, o_orderkey || CASE WHEN o_orderkey % 100 BETWEEN 11 AND 13 THEN 'th' WHEN o_orderkey % 10 = 1 THEN 'st'
       WHEN o_orderkey % 10 = 2 THEN 'nd' WHEN o_orderkey % 10 = 3 THEN 'rd' ELSE 'th' END AS place FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", numbers.ordinal("o_orderkey").alias("place"))


# --- derived columns -------------------------------------------------------------------------

_PART_BAND = f"(SELECT p_partkey, {band_sql('p_size')} AS band FROM part) b"


def _part_band(t: Tables):
    return t.part.select("p_partkey", band_text("p_size").alias("band"))


@query("d01_year_by_range", f"""
SELECT p_partkey, band, {range_year_sql('band')} AS year,
       CAST(CASE WHEN band LIKE '%1900-1929%' THEN 1914.5 WHEN band LIKE '%1930-1949%' THEN 1939.5
            ELSE {range_year_sql('band')} END AS DOUBLE) AS year_exact FROM {_PART_BAND}""")
def _(t):
    return _part_band(t).select(
        "p_partkey", "band", bands.year_by_range("band").alias("year"), bands.year_by_range_exact("band").alias("year_exact")
    )


@query("d02_year_by_digits", f"""
WITH d AS (SELECT p_partkey, band, regexp_replace(band, '[^0-9]', '', 'g') AS s FROM {_PART_BAND})
SELECT p_partkey, band, CAST(CASE WHEN s = '' THEN NULL WHEN s = '1900' THEN 1899
    WHEN length(s) > 4 THEN floor((CAST(substring(s, 5, 4) AS INTEGER) - CAST(substring(s, 1, 4) AS INTEGER)) / 2)
         + CAST(substring(s, 1, 4) AS INTEGER)
    ELSE CAST(substring(s, 1, 4) AS INTEGER) END AS INTEGER) AS year FROM d""")
def _(t):
    return _part_band(t).select("p_partkey", "band", bands.year_by_digits("band").alias("year"))


@query("d03_band_struct", f"""
WITH g AS (SELECT p_partkey, band,
    CAST(nullif(regexp_extract(band, '([0-9]{{4}})-([0-9]{{4}})', 1), '') AS INTEGER) AS "start",
    CAST(nullif(regexp_extract(band, '([0-9]{{4}})-([0-9]{{4}})', 2), '') AS INTEGER) AS "end",
    CAST(nullif(regexp_extract(band, '([0-9]{{4}})', 1), '') AS INTEGER) AS y FROM {_PART_BAND}),
h AS (SELECT *, CASE WHEN "start" IS NULL THEN y END AS only_year FROM g)
SELECT p_partkey, "start", "end", only_year,
    CAST(CASE WHEN "start" IS NULL THEN y ELSE round(("start" + "end") / 2.0, 0) END AS INTEGER) AS mean_year,
    CASE WHEN only_year = 1900 THEN 'Before 1900' WHEN only_year > 1900 THEN 'After ' || only_year
         ELSE 'Between ' || "start" || ' and ' || "end" END AS label FROM h""")
def _(t):
    return _part_band(t).select("p_partkey", bands.band_struct("band").alias("b")).select("p_partkey", "b.*")


@query("d04_mean_of_years", f"""
SELECT p_partkey, CASE WHEN band LIKE '%1900-1929%' THEN 1914.5::DOUBLE WHEN band LIKE '%1930-1949%' THEN 1939.5::DOUBLE
       ELSE TRY_CAST(nullif(regexp_extract(band, '[0-9]{{4}}'), '') AS DOUBLE) END AS year FROM {_PART_BAND}""")
def _(t):
    return _part_band(t).select("p_partkey", bands.mean_of_years("band").alias("year"))


@query("d05_epoch", f"""
SELECT p_partkey, {epoch_sql('year')} AS epoch FROM (SELECT p_partkey, {range_year_sql('band')} AS year FROM {_PART_BAND}) y""")
def _(t):
    return _part_band(t).select("p_partkey", bands.epoch(bands.year_by_range("band")).alias("epoch"))


_TENURES = {
    "BUILDING": "owner-occupied",
    "AUTOMOBILE": "Rented (private)",
    "MACHINERY": "rental (social)",
    "HOUSEHOLD": "Owner-occupied",
}


@query("d06_tenure", f"""
SELECT c_custkey, CASE WHEN tenure ILIKE '%owner%' THEN 'Owner occupied' WHEN tenure LIKE '%private%' THEN 'Private rented'
       WHEN tenure LIKE '%social%' THEN 'Social rented' ELSE 'Unknown' END AS lenient,
       CASE WHEN tenure ILIKE '%owner-occupied%' THEN 'Owner occupied' WHEN tenure LIKE '%social%' THEN 'Social rented'
       WHEN tenure LIKE '%private%' THEN 'Private rented' ELSE 'Unknown' END AS strict
FROM (SELECT c_custkey, {words_sql(_TENURES, 'c_mktsegment')} AS tenure FROM customer) c""")
def _(t):
    tenure = t.customer.select("c_custkey", words(_TENURES, "c_mktsegment").alias("tenure"))
    return tenure.select(
        "c_custkey", domain.tenure("tenure").alias("lenient"), domain.tenure_strict("tenure").alias("strict")
    )


@query("d07_text_flags", """
SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN NULL ELSE CAST(contains(p_name, '1') AS INTEGER) END AS has_one,
       CASE WHEN p_type = 'PROMO' THEN NULL ELSE CAST(contains(p_name, '2') AS INTEGER) END AS has_two FROM part""")
def _(t):
    name = F.when(F.col("p_type") != "PROMO", F.col("p_name"))
    return t.part.select(
        "p_partkey", domain.text_flag(name, "1").alias("has_one"), domain.text_flag(name, "2").alias("has_two")
    )


@query("d08_one_hot", """
SELECT o_orderkey, CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS priority_urgent,
       CAST(o_orderpriority = '2-HIGH' AS INTEGER) AS priority_high FROM orders""")
def _(t):
    flags = {"priority_urgent": "1-URGENT", "priority_high": "2-HIGH"}
    return t.orders.select("o_orderkey", *domain.one_hot("o_orderpriority", flags))


@query("d08_one_hot_found", "SELECT o_orderkey, " + ", ".join(
    f"CAST(o_orderpriority = '{p}' AS INTEGER) AS priority_{c}" for p, c in (
        ("1-URGENT", "1_urgent"), ("2-HIGH", "2_high"), ("3-MEDIUM", "3_medium"), ("4-NOT SPECIFIED", "4_not_specified"), ("5-LOW", "5_low"))
) + " FROM orders")
def _(t):
    return t.orders.select("o_orderkey", *domain.one_hot("o_orderpriority", names.value_names(t.orders, "o_orderpriority", "priority_")))


@query("d09_cost_range_pence", """
SELECT p_partkey, p_size * 1000 AS low, p_size * 1000 + 1500 AS high, p_size * 1000 + 750.0::DOUBLE AS mean FROM part""")
def _(t):
    low = F.concat(F.lit("£"), F.format_number(F.col("p_size") * 1000, 0), F.lit(".50"))
    cost = F.concat(low, F.lit(" - £"), F.format_number(F.col("p_size") * 1000 + 1500, 0), F.lit(".99"))
    return t.part.select("p_partkey", domain.cost_bounds(cost).alias("c")).select("p_partkey", "c.*")


@query("d09_cost_range", """
SELECT p_partkey, p_size * 1000 AS low, CASE WHEN p_type <> 'PROMO' THEN p_size * 1000 + 1500 END AS high,
       CASE WHEN p_type <> 'PROMO' THEN p_size * 1000 + 750.0::DOUBLE END AS mean FROM part""")
def _(t):
    low = F.concat(F.lit("£"), F.format_number(F.col("p_size") * 1000, 0))
    high = F.concat(F.lit(" - £"), F.format_number(F.col("p_size") * 1000 + 1500, 0))
    cost = F.concat(low, F.when(F.col("p_type") != "PROMO", high).otherwise(""))
    return t.part.select("p_partkey", domain.cost_bounds(cost).alias("c")).select("p_partkey", "c.*")


@query("d10_resource_name", """
SELECT c_custkey, 'domestic-' || c_custkey || '-' || c_mktsegment || '-City-of-St-' || c_nationkey || '.zip' AS resource
FROM customer""")
def _(t):
    place = F.concat("c_mktsegment", F.lit(", City of St. "), F.col("c_nationkey").cast("string"))
    code = F.col("c_custkey").cast("string")
    return t.customer.select("c_custkey", text.resource_name("domestic", code, place).alias("resource"))


@query("d11_lat_lon", """
SELECT c_custkey, CAST(c_nationkey AS DOUBLE) AS latitude, c_acctbal AS longitude,
       'photos/' || c_custkey || '.jpg' AS photo FROM customer""")
def _(t):
    point = F.concat_ws(", ", F.col("c_nationkey").cast("string"), F.col("c_acctbal").cast("string"))
    photo = F.concat(F.lit("photos/"), F.col("c_custkey").cast("string"), F.lit(".jpg"))
    return t.customer.select("c_custkey", text.lat_lon(point).alias("p"), photo.alias("photo")).select("c_custkey", "p.*", "photo")


@query("d12_rating_category", """
SELECT o_orderkey, CASE WHEN contains(nullif(o_orderpriority, '5-LOW'), 'A') THEN 'A'
       WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 'B_G' END AS category
FROM (SELECT o_orderkey, replace(o_orderpriority, 'URGENT', 'A+') AS o_orderpriority FROM orders) o""")
def _(t):
    band = F.nullif(F.replace("o_orderpriority", F.lit("URGENT"), F.lit("A+")), F.lit("5-LOW"))
    return t.orders.select("o_orderkey", domain.rating_category(band).alias("category"))


@query("d13_code_prefix", "SELECT c_custkey, substring(c_name, 1, 9) AS code FROM customer")
def _(t):
    return t.customer.select("c_custkey", text.code_prefix("c_name").alias("code"))


# --- points ----------------------------------------------------------------------------------


@query("g01_point_text", "SELECT c_custkey, 'POINT (' || c_nationkey || ' ' || c_custkey || ')' AS geom FROM customer")
def _(t):
    return t.customer.select("c_custkey", geo.point_text("c_nationkey", "c_custkey").alias("geom"))


@query("g02_point_coords", "SELECT c_custkey, CAST(c_nationkey AS DOUBLE) AS x, c_acctbal AS y FROM customer")
def _(t):
    points = t.customer.select("c_custkey", geo.point_text("c_nationkey", "c_acctbal").alias("geom"))
    return points.select("c_custkey", geo.point_coords("geom").alias("p")).select("c_custkey", "p.*")


@query("g03_reproject_round_trip", """
SELECT c_custkey, round(50 + c_nationkey / 10.0, 5) AS lat, round(-3 + (c_custkey % 100) / 50.0, 5) AS long FROM customer""")
def _(t):
    # Only the there-and-back result has a plain SQL counterpart; the grid values are tested
    # against published worked examples.
    points = t.customer.select(
        "c_custkey",
        (F.lit(50) + F.col("c_nationkey") / 10.0).alias("lat0"),
        (F.lit(-3) + (F.col("c_custkey") % 100) / 50.0).alias("long0"),
    )
    back = geo.grid_to_wgs84(geo.wgs84_to_grid(points, "lat0", "long0"), "easting", "northing")
    return back.select("c_custkey", F.round("lat", 5).alias("lat"), F.round("long", 5).alias("long"))


def _squares(t: Tables) -> DataFrame:
    """A polygon with a hole per customer, of two parts for every third, in degrees; null and broken texts for some."""
    lat, long = F.lit(50) + F.col("c_nationkey") / 10.0, F.lit(-3) + (F.col("c_custkey") % 100) / 50.0
    ring = lambda a, b: F.concat(F.lit("("), F.array_join(F.array(*[
        F.concat_ws(" ", F.round(long + dx, 5).cast("string"), F.round(lat + dy, 5).cast("string")) for dx, dy in ((a, a), (b, a), (b, b), (a, b), (a, a))
    ]), ", "), F.lit(")"))
    with_hole = F.concat(F.lit("("), ring(0, 0.5), F.lit(", "), ring(0.125, 0.25), F.lit(")"))
    two = F.concat(F.lit("MULTIPOLYGON ("), with_hole, F.lit(", ("), ring(0.625, 0.75), F.lit("))"))
    text = F.when(F.col("c_custkey") % 3 == 0, two).otherwise(F.concat(F.lit("POLYGON "), with_hole))
    text = F.when(F.col("c_custkey") % 10 == 1, None).when(F.col("c_custkey") % 10 == 2, F.lit("POLYGON ((0 0, 1 1, 0 0))")).otherwise(text)
    return t.customer.select("c_custkey", text.alias("wkt"))


@query("g03_polygon_round_trip", """
WITH rings(part, ring, a, b) AS (VALUES (0, 0, 0.0, 0.5), (0, 1, 0.125, 0.25), (1, 0, 0.625, 0.75))
SELECT c_custkey, part, ring, CASE WHEN part IS NULL THEN NULL ELSE 5 END::BIGINT AS n_vertices,
    round(-3 + (c_custkey % 100) / 50.0 + a, 5)::DOUBLE AS west, round(50 + c_nationkey / 10.0 + a, 5)::DOUBLE AS south,
    round(-3 + (c_custkey % 100) / 50.0 + b, 5)::DOUBLE AS east, round(50 + c_nationkey / 10.0 + b, 5)::DOUBLE AS north
FROM customer LEFT JOIN rings ON c_custkey % 10 NOT IN (1, 2) AND (part = 0 OR c_custkey % 3 = 0)""")
def _(t):
    shapes = _squares(t).select("c_custkey", polygons.polygon_parts("wkt").alias("shape"))
    moved = polygons.reprojected(shapes, "c_custkey", "shape", lambda df, x, y: geo.wgs84_to_grid(df, y, x), "easting", "northing")
    through_text = moved.select("c_custkey", polygons.polygon_parts(polygons.polygon_text("shape")).alias("shape"))
    back = polygons.reprojected(through_text, "c_custkey", "shape", geo.grid_to_wgs84, "long", "lat")
    rings = polygons.vertices(back, "shape").groupBy("c_custkey", "part", "ring").agg(
        F.count("*").alias("n_vertices"), F.round(F.min("x"), 5).alias("west"), F.round(F.min("y"), 5).alias("south"),
        F.round(F.max("x"), 5).alias("east"), F.round(F.max("y"), 5).alias("north"),
    )
    return t.customer.select("c_custkey").join(rings, "c_custkey", "left")


@query("g03_grid_shift", """
SELECT c_custkey, true AS shift_is_known, round(50 + c_nationkey / 10.0, 5) AS lat, round(-3 + (c_custkey % 100) / 50.0, 5) AS long FROM customer""")
def _(t):
    # Nodes every 25 km with a shift that is linear in the place, so that its value is known everywhere.
    nodes = t.spark.range(40 * 60).selectExpr("(id % 40) * 25000D AS east", "(id DIV 40) * 25000D AS north")
    grid = nodes.select("*", (F.col("east") * 1e-5 + 90).alias("shift_east"), (F.col("north") * -2e-5 - 75).alias("shift_north"))
    points = t.customer.select("c_custkey", (F.lit(50) + F.col("c_nationkey") / 10.0).alias("lat0"), (F.lit(-3) + (F.col("c_custkey") % 100) / 50.0).alias("long0"))
    plain = stage(grid_shift.wgs84_to_grid(points, "lat0", "long0", east="plain_e", north="plain_n"), "g03")
    there = grid_shift.wgs84_to_grid(plain, "lat0", "long0", grid, 25_000.0)
    known = (F.abs(F.col("easting") - F.col("plain_e") * (1 + 1e-5) - 90) < 1e-6) & (F.abs(F.col("northing") - F.col("plain_n") * (1 - 2e-5) + 75) < 1e-6)
    back = grid_shift.grid_to_wgs84(there, "easting", "northing", grid, 25_000.0)
    return back.select("c_custkey", known.alias("shift_is_known"), F.round("lat", 5).alias("lat"), F.round("long", 5).alias("long"))


@query("g04_features_by_code", """
SELECT c_custkey, 'POLYGON-' || c_custkey AS geometry, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'""")
def _(t):
    shapes = t.customer.select(
        "c_custkey", "c_nationkey", F.concat(F.lit("POLYGON-"), F.col("c_custkey").cast("string")).alias("geometry")
    )
    asia = joins.keep_listed(t.nation, t.region.where(F.col("r_name") == "ASIA"), {"n_regionkey": "r_regionkey"})
    kept = joins.keep_listed(shapes, asia, {"c_nationkey": "n_nationkey"})
    named = joins.enrich(kept, joins.Lookup(asia, {"c_nationkey": "n_nationkey"}, ["n_name"], "inner"))
    return named.select("c_custkey", "geometry", "n_name")
