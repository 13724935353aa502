"""A (aggregations and reshaping) and the reporting part of the quality operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cadastra.catalog.registry import Tables, query
from cadastra.catalog.standins import UNTIED
from cadastra.functions import domain
from cadastra.functions.numbers import percent_ratio
from cadastra.operators import aggs, joins, quality, sets, sketches
from cadastra.operators.joins import Lookup
from cadastra.sources.staging import fresh_dir

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
PRIORITY_SQL = ", ".join(f"'{p}'" for p in PRIORITIES)


@query("a01_group_count", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def _(t: Tables):
    return t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("a02_group_means", """
SELECT l_returnflag, l_linestatus, year(l_shipdate)::INTEGER AS year, round(avg(l_quantity), 6) AS quantity,
       round(avg(l_extendedprice), 4) AS price, count(*) AS n FROM lineitem GROUP BY 1, 2, 3""")
def _(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus", F.year("l_shipdate").alias("year")).agg(
        F.round(F.avg("l_quantity"), 6).alias("quantity"),
        F.round(F.avg("l_extendedprice"), 4).alias("price"),
        F.count("*").alias("n"),
    )


@query("a03_group_sum", """
SELECT year(l_shipdate)::INTEGER AS year, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
FROM lineitem GROUP BY 1""")
def _(t):
    revenue = F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return t.lineitem.groupBy(F.year("l_shipdate").alias("year")).agg(F.round(revenue, 2).alias("revenue"))


@query("a04_global_aggregate", """
SELECT CAST(max(o_orderdate) AS VARCHAR) AS newest, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders""")
def _(t):
    return t.orders.agg(
        F.max("o_orderdate").cast("string").alias("newest"),
        F.count("*").alias("n"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
    )


@query("a05_distinct", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def _(t):
    return t.customer.select("c_nationkey", "c_mktsegment").distinct()


@query("a06_count_distinct", """
SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1""")
def _(t):
    return t.lineitem.groupBy("l_returnflag").agg(aggs.distinct_count("l_suppkey").alias("suppliers"))


# The sketch has a relative standard deviation of 5 percent; three of them are allowed.
@query("a06_count_distinct_sketch", """
SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers, true AS sketch_is_near FROM lineitem GROUP BY 1""")
def _(t):
    exact, sketch = aggs.distinct_count("l_suppkey"), aggs.distinct_count("l_suppkey", exact=False)
    counts = t.lineitem.groupBy("l_returnflag").agg(exact.alias("suppliers"), sketch.alias("sketch"))
    near = F.abs(F.col("sketch") - F.col("suppliers")) <= 0.15 * F.col("suppliers")
    return counts.select("l_returnflag", "suppliers", near.alias("sketch_is_near"))


@query("a07_first_value", """
SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS first_priority, arg_min(o_orderstatus, o_orderkey) AS first_status
FROM orders GROUP BY 1""")
def _(t):
    return t.orders.groupBy("o_custkey").agg(
        aggs.first_value("o_orderpriority", "o_orderkey").alias("first_priority"),
        aggs.first_value("o_orderstatus", "o_orderkey").alias("first_status"),
    )


@query("a08_inverse_weighted_mean", """
SELECT l_returnflag, round(sum(l_extendedprice / l_quantity) / sum(1 / l_quantity), 4) AS weighted FROM lineitem GROUP BY 1""")
def _(t):
    weighted = aggs.inverse_weighted_mean("l_extendedprice", "l_quantity")
    return t.lineitem.groupBy("l_returnflag").agg(F.round(weighted, 4).alias("weighted"))


def _line_flags(t: Tables):
    return t.lineitem.select(
        F.year("l_shipdate").alias("year"),
        domain.equals_flag("l_returnflag", "R").alias("d_returned"),
        domain.equals_flag("l_linestatus", "O").alias("d_open"),
        F.when(F.col("l_tax") > 0, (F.col("l_discount") > 0.05).cast("int")).alias("d_discounted"),
        F.col("l_quantity").alias("n_quantity"),
    )


_FLAGS_SQL = """
WITH f AS (SELECT year(l_shipdate)::INTEGER AS year, CAST(l_returnflag = 'R' AS INTEGER) AS returned,
    CAST(l_linestatus = 'O' AS INTEGER) AS open, CASE WHEN l_tax > 0 THEN CAST(l_discount > 0.05 AS INTEGER) END AS discounted,
    l_quantity FROM lineitem)"""


@query("a09_flag_percent", _FLAGS_SQL + """
SELECT year, round_even(sum(returned) * 100.0::DOUBLE / count(*), 1) AS returned_percent,
       round_even(sum(open) * 100.0::DOUBLE / count(*), 1) AS open_percent,
       round_even(sum(discounted) * 100.0::DOUBLE / count(*), 1) AS discounted_percent FROM f GROUP BY 1""")
def _(t):
    flags = ["d_returned", "d_open", "d_discounted"]
    percents = [aggs.flag_percent(f).alias(f"{f.removeprefix('d_')}_percent") for f in flags]
    return _line_flags(t).groupBy("year").agg(*percents)


@query("a10_flag_profile", _FLAGS_SQL + """
SELECT year, round_even(sum(returned) * 100.0::DOUBLE / count(*), 1) AS returned_percent,
       round_even(sum(open) * 100.0::DOUBLE / count(*), 1) AS open_percent,
       round_even(sum(discounted) * 100.0::DOUBLE / count(*), 1) AS discounted_percent,
       round_even(avg(l_quantity), 0) AS quantity, CAST(sum(returned) AS BIGINT) AS returned_sum,
       CAST(sum(open) AS BIGINT) AS open_sum, CAST(sum(discounted) AS BIGINT) AS discounted_sum, count(*) AS n_rows
FROM f GROUP BY 1""")
def _(t):
    return aggs.flag_profile(_line_flags(t), "year", ["d_returned", "d_open", "d_discounted"], ["n_quantity"])


@query("a11_per_capita", """
WITH o AS (SELECT o_custkey, year(o_orderdate)::INTEGER AS year, sum(o_totalprice) AS amount FROM orders GROUP BY ALL),
     c AS (SELECT c_nationkey, year, c_mktsegment, avg(c_acctbal) AS pop, sum(amount) AS amount
           FROM o JOIN customer ON c_custkey = o_custkey GROUP BY ALL)
SELECT c_nationkey, year, round(sum(pop * 1000), 2) AS population, round(sum(amount), 2) AS amount,
       round(sum(amount) * 1000 / sum(pop * 1000), 6) AS per_capita FROM c GROUP BY ALL""")
def _(t):
    yearly = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(F.sum("o_totalprice").alias("amount"))
    joined = joins.enrich(
        yearly, Lookup(t.customer, {"o_custkey": "c_custkey"}, ["c_nationkey", "c_mktsegment", "c_acctbal"], "inner")
    )
    result = aggs.per_capita(joined, "c_nationkey", "year", "c_mktsegment", "amount", "c_acctbal")
    rounded = {"population": F.round("population", 2), "amount": F.round("amount", 2), "per_capita": F.round("per_capita", 6)}
    return result.withColumns(rounded)


@query("a12_mean_of_row_means", """
SELECT p_type, round(avg(CASE WHEN p_brand <> 'Brand#1' THEN (p_size * 100 + p_size * 250) / 2 END), 6) AS mean_cost,
       count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC""")
def _(t):
    high = F.when(F.col("p_brand") != "Brand#1", F.concat(F.lit(" - £"), (F.col("p_size") * 250).cast("string"))).otherwise("")
    cost = F.concat(F.lit("£"), (F.col("p_size") * 100).cast("string"), high)
    grouped = t.part.groupBy("p_type").agg(
        F.round(F.avg(domain.cost_bounds(cost)["mean"]), 6).alias("mean_cost"), F.count("*").alias("n")
    )
    return grouped.orderBy(F.desc("n"))


@query("a13_pivot_wider", """
SELECT year(o_orderdate)::INTEGER AS year, """ + ", ".join(
    f"CAST(sum(CASE WHEN o_orderpriority = '{p}' THEN 1 END) AS BIGINT) AS \"{p}\"" for p in PRIORITIES
) + " FROM orders GROUP BY 1")
def _(t):
    counts = t.orders.groupBy(F.year("o_orderdate").alias("year"), "o_orderpriority").agg(F.count("*").alias("n"))
    return aggs.pivot_wider(counts, "year", "o_orderpriority", "n", PRIORITIES)


@query("a14_unpivot_longer", """
SELECT l_orderkey, l_linenumber, 'l_extendedprice' AS name, l_extendedprice AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem""")
def _(t):
    return aggs.unpivot_longer(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_extendedprice", "l_tax", "l_discount"])


@query("a15_cross_table", "SELECT o_orderstatus, " + ", ".join(
    f"count(*) FILTER (WHERE o_orderpriority = '{p}') AS \"{p}\"" for p in PRIORITIES
) + " FROM orders GROUP BY 1")
def _(t):
    return aggs.cross_table(t.orders, "o_orderstatus", "o_orderpriority", PRIORITIES)


@query("a16_histogram", """
SELECT CASE WHEN l_extendedprice < 0 THEN 0 WHEN l_extendedprice >= 100000 THEN 11
       ELSE CAST(floor(l_extendedprice / 10000) AS INTEGER) + 1 END AS bin, count(*) AS n FROM lineitem GROUP BY 1""")
def _(t):
    return aggs.histogram(t.lineitem, "l_extendedprice", 0.0, 100000.0, 10)


_PROFILED = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
    "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}
_NUMBERS = [c for c, kind in _PROFILED.items() if kind not in ("string", "timestamp_ntz")]


@query("a17_table_profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, '{kind}' AS column_type, CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max,
    {f'round(avg({c}), 6)' if c in _NUMBERS else 'NULL::DOUBLE'} AS avg,
    {f'round(stddev({c}), 6)' if c in _NUMBERS else 'NULL::DOUBLE'} AS std, count(*) AS count,
    avg(CAST({c} IS NULL AS INTEGER)) * 100 AS null_percentage FROM lineitem""" for c, kind in _PROFILED.items()))
def _(t):
    # The next query looks at the sketches (quartiles, distinct counts).
    report = quality.profile(t.lineitem, list(_PROFILED), sketches=False)
    return report.withColumns({"avg": F.round("avg", 6), "std": F.round("std", 6)})


_NEAR_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_unique, true AS unique_is_near,
    {'true' if c in _NUMBERS else 'NULL::BOOLEAN'} AS quartiles_are_near FROM lineitem""" for c in _PROFILED)


def _near_exact(t: Tables, report: DataFrame, unique: float) -> DataFrame:
    """Whether estimates lie within their stated errors: a share of the distinct values, a percent of rank for quartiles."""
    report = report.select("column_name", "approx_unique", "q25", "q50", "q75")
    exact = t.lineitem.agg(*[F.countDistinct(c).alias(c) for c in _PROFILED]).unpivot([], list(_PROFILED), "column_name", "n_unique")
    # Share of values under and up to each quartile: the quartile's own share must lie between, give or take the error.
    quartiles = {r["column_name"]: r for r in report.where(F.col("column_name").isin(*_NUMBERS)).collect()}  # one row per column
    shares = [
        F.struct(
            F.lit(c).alias("column_name"),
            *[((F.avg((F.col(c) < r[q]).cast("int")) <= p + 0.02) & (F.avg((F.col(c) <= r[q]).cast("int")) >= p - 0.02)).alias(q)
              for q, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))],
        ) for c, r in quartiles.items()
    ]
    near = t.lineitem.agg(F.array(*shares).alias("s")).select(F.inline("s"))
    near = near.select("column_name", (F.col("q25") & F.col("q50") & F.col("q75")).alias("quartiles_are_near"))
    joined = report.join(exact, "column_name").join(near, "column_name", "left")
    unique_is_near = F.abs(F.col("approx_unique") - F.col("n_unique")) <= unique * F.col("n_unique")
    return joined.select("column_name", "n_unique", unique_is_near.alias("unique_is_near"), "quartiles_are_near")


@query("a17_table_profile_sketches", _NEAR_SQL)
def _(t):
    return _near_exact(t, quality.profile(t.lineitem), 0.15)


def _stored_profile(t: Tables, label: str, columns: list[str], by=()) -> DataFrame:
    """Sketches of ``lineitem`` that arrives in four batches; only batches are read."""
    table, kept = fresh_dir(t.spark, f"{label}-table"), fresh_dir(t.spark, f"{label}-sketches")
    for number in range(4):
        batch = t.lineitem.select(*by, *columns).where(F.col("l_orderkey") % 4 == number)
        sketches.append_profiled(batch, table, kept, number, columns, by)
    return sketches.stored_sketches(t.spark, kept, t.lineitem.schema, by)


@query("a17_stored_sketches", _NEAR_SQL)
def _(t):
    # 12 bits: 1.6 % standard error, so 6.4 % is four of them.
    return _near_exact(t, sketches.profile_of(_stored_profile(t, "a17", list(_PROFILED))), 0.064)


@query("a17_stored_moments", """
SELECT l_returnflag, 'l_quantity' AS column_name, min(l_quantity) AS low, max(l_quantity) AS high, round(avg(l_quantity), 6) AS avg,
    round(stddev(l_quantity), 6) AS std, count(*) AS count, 0.0::DOUBLE AS null_percentage FROM lineitem GROUP BY 1""")
def _(t):
    stored = _stored_profile(t, "a17m", ["l_quantity", "l_orderkey"], ["l_returnflag"])
    report = sketches.profile_of(stored.where("column_name = 'l_quantity'"), ["l_returnflag"])
    return report.select(
        "l_returnflag", "column_name", F.col("min").cast("double").alias("low"), F.col("max").cast("double").alias("high"),
        F.round("avg", 6).alias("avg"), F.round("std", 6).alias("std"), "count", "null_percentage",
    )


@query("a06_stored_distinct", """
SELECT l_returnflag, count(DISTINCT l_suppkey) AS n_suppliers, true AS is_near FROM lineitem GROUP BY 1""")
def _(t):
    stored = _stored_profile(t, "a06", ["l_suppkey", "l_orderkey"], ["l_returnflag"]).where("column_name = 'l_suppkey'")
    near = sketches.profile_of(stored, ["l_returnflag"]).select("l_returnflag", "approx_unique")
    exact = t.lineitem.groupBy("l_returnflag").agg(aggs.distinct_count("l_suppkey").alias("n_suppliers"))
    is_near = F.abs(F.col("approx_unique") - F.col("n_suppliers")) <= 0.064 * F.col("n_suppliers")
    return exact.join(near, "l_returnflag").select("l_returnflag", "n_suppliers", is_near.alias("is_near"))


@query("a18_missing_percent", """
SELECT o_orderpriority, round(avg(CASE WHEN o_orderstatus = 'P' THEN 100.0 ELSE 0.0 END), 6) AS missing_pct
FROM orders GROUP BY 1""")
def _(t):
    holes = t.orders.select("o_orderpriority", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return holes.groupBy("o_orderpriority").agg(F.round(quality.missing_percent("status"), 6).alias("missing_pct"))


@query("a18_unmatched_count", """
SELECT count(*) AS n_unmatched FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def _(t):
    positive = t.customer.where(F.col("c_acctbal") > 0)
    return joins.drop_listed(t.orders, positive, {"o_custkey": "c_custkey"}).agg(F.count("*").alias("n_unmatched"))


@query("a19_ratio_of_counts", """
SELECT year(o_orderdate)::INTEGER AS year, round_even(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') * 100.0::DOUBLE
       / count(*) FILTER (WHERE o_orderpriority <> '1-URGENT'), 1) AS urgent_to_rest_pct FROM orders GROUP BY 1""")
def _(t):
    urgent = F.col("o_orderpriority") == "1-URGENT"
    ratio = percent_ratio(F.count_if(urgent), F.count_if(~urgent))
    return t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.bround(ratio, 1).alias("urgent_to_rest_pct"))


@query("a20_percent_drop", """
WITH y AS (SELECT year(l_shipdate) AS year, sum(l_extendedprice) AS total FROM lineitem GROUP BY 1),
     e AS (SELECT arg_min(total, year) AS f, arg_max(total, year) AS l FROM y)
SELECT round(f, 2) AS first_total, round(l, 2) AS last_total, round_even((f - l) * 100 / f, 1) AS percent_drop FROM e""")
def _(t):
    line = t.lineitem.select(F.year("l_shipdate").alias("year"), "l_extendedprice")
    drop = aggs.percent_drop(line, "year", "l_extendedprice")
    return drop.withColumns({c: F.round(c, 2) for c in ("first_total", "last_total")})


@query("a21_lump_other", """
SELECT CASE WHEN p_type IN ('PROMO', 'LARGE') THEN p_type ELSE 'Other' END AS "group", round(sum(p_retailprice), 2) AS total
FROM part WHERE p_brand NOT IN ('Brand#1') GROUP BY 1""")
def _(t):
    group = aggs.lump_other("p_type", ["PROMO", "LARGE"]).alias("group")
    kept = t.part.where(~F.col("p_brand").isin("Brand#1"))
    return kept.groupBy(group).agg(F.round(F.sum("p_retailprice"), 2).alias("total"))


@query("a22_rounded_means", """
SELECT user_id, month(ts)::INTEGER AS month, round(avg(value * 0.70710678), 1) AS mean_value FROM events GROUP BY 1, 2
ORDER BY month, user_id""")
def _(t):
    means = t.events.groupBy("user_id", F.month("ts").alias("month")).agg(F.round(F.avg(F.col("value") * UNTIED), 1).alias("mean_value"))
    return means.orderBy("month", "user_id")


@query("a23_mean_as_int", """
SELECT l_returnflag, CAST(avg(l_extendedprice) AS INTEGER) AS mean_price FROM lineitem GROUP BY 1""")
def _(t):
    return t.lineitem.groupBy("l_returnflag").agg(aggs.mean_as_int("l_extendedprice").alias("mean_price"))


@query("a24_null_propagation", """
WITH n AS (SELECT l_suppkey, CASE WHEN l_discount > 0.09 AND l_quantity > 48 THEN NULL ELSE l_quantity END AS q FROM lineitem)
SELECT l_suppkey, CASE WHEN count(q) = count(*) THEN sum(q) END AS strict_sum,
       CASE WHEN count(q) = count(*) THEN round(avg(q), 6) END AS strict_mean, sum(q) AS skipping_sum FROM n GROUP BY 1""")
def _(t):
    hole = (F.col("l_discount") > 0.09) & (F.col("l_quantity") > 48)
    holes = t.lineitem.select("l_suppkey", F.when(~hole, F.col("l_quantity")).alias("q"))
    return holes.groupBy("l_suppkey").agg(
        aggs.strict_sum("q").alias("strict_sum"),
        F.round(aggs.strict_mean("q"), 6).alias("strict_mean"),
        F.sum("q").alias("skipping_sum"),
    )


@query("a25_score_report", """
SELECT l_suppkey, round(avg(l_discount), 8) AS mean_score, count(*) AS n, CAST(avg(l_discount) < 0.045 AS INTEGER) AS is_red,
       CAST(avg(l_discount) < 0.05 AS INTEGER) AS is_below FROM lineitem GROUP BY 1""")
def _(t):
    report = quality.score_report(t.lineitem, "l_suppkey", "l_discount", red=0.045, below=0.05)
    return report.withColumn("mean_score", F.round("mean_score", 8))


@query("a25_entities_missing", """
SELECT o_custkey, count(*) AS n_missing FROM orders WHERE o_orderstatus = 'P' GROUP BY 1""")
def _(t):
    holes = t.orders.select("o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("licence"))
    return quality.entities_missing(holes, "o_custkey", "licence")


@query("a25_split_valid", """
SELECT 'valid' AS part, count(*) AS n FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'invalid', count(*) FROM orders WHERE o_orderstatus <> 'F'""")
def _(t):
    valid, invalid = quality.split_valid(t.orders, F.nullif("o_orderstatus", F.lit("P")) == "F")
    counts = {name: df.agg(F.count("*").alias("n")) for name, df in (("valid", valid), ("invalid", invalid))}
    return sets.unite_tagged(counts, "part")


@query("a25_conforming_share", """
SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS n_valid, count(*) FILTER (WHERE o_orderstatus <> 'F') AS n_invalid,
       round(avg(CASE WHEN o_orderstatus = 'F' THEN 100.0 ELSE 0.0 END), 6) AS valid_pct FROM orders""")
def _(t):
    share = quality.conforming_share(t.orders, F.nullif("o_orderstatus", F.lit("P")) == "F")
    return share.withColumn("valid_pct", F.round("valid_pct", 6))
